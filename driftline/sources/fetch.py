"""Fetching state files and diffs over HTTP: what is there already is used again, and a file appears whole or not at all."""

from __future__ import annotations

import http.cookiejar
import os
import shutil
import urllib.request

from driftline.sources import files


def fetch(url: str, path: str, cookies: str | None = None, timeout: float = 60) -> str:
    """Downloads ``url`` to ``path`` unless it's there. ``cookies``: a Netscape cookie file for servers that ask for a session."""
    if os.path.exists(path):
        return path
    jar = http.cookiejar.MozillaCookieJar()
    if cookies:
        jar.load(cookies, ignore_discard=True, ignore_expires=True)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.part"
    try:
        with urllib.request.build_opener(urllib.request.HTTPCookieProcessor(jar)).open(url, timeout=timeout) as got, open(part, "wb") as out:
            shutil.copyfileobj(got, out)
        os.replace(part, path)
    except BaseException:
        if os.path.exists(part):
            os.remove(part)
        raise
    return path


def current_state(base: str, folder: str, cookies: str | None = None) -> dict[str, str]:
    """The server's newest state, always fetched anew."""
    path = os.path.join(folder, "state.txt")
    if os.path.exists(path):
        os.remove(path)
    with open(fetch(f"{base.rstrip('/')}/state.txt", path, cookies), encoding="utf-8") as f:
        return files.parse_state(f.read())


def diffs(base: str, folder: str, sequences: list[int], cookies: str | None = None) -> list[int]:
    """Fetches diffs into ``folder`` in order and gives those that are there; the first failure ends it (what came before can be applied)."""
    have = []
    for seq in sequences:
        try:
            fetch(f"{base.rstrip('/')}/{files.diff_path(seq)}", os.path.join(folder, f"{seq}.osc.gz"), cookies)
        except OSError:
            break
        have.append(seq)
    return have
