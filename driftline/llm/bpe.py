"""Byte-level BPE: exact encoding and decoding with the ids of a ``tokenizers`` JSON file.

The merge loop of ``tiktoken`` runs over the vocabulary taken from that file. Both libraries agree on every code point
and on long runs (tests/llm/test_bpe.py); added tokens are split off first, as the ``tokenizers`` default does.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

#: A text can be cut here without changing its ids: no pre-token reaches over the start of a run of white space.
SAFE = re.compile(r"(?<=[^\s])(?=[ \n])")
#: The pattern that a ByteLevel pre-tokenizer with use_regex applies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bytes_of_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    printable = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    shown = {chr(b): b for b in printable}
    rest = (b for b in range(256) if b not in set(printable))
    return shown | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """``encode`` and ``decode`` equal Tokenizer.encode(add_special_tokens=False) and decode(skip_special_tokens=False)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError("added tokens that take in what stands around them are not supported")
        as_byte = _bytes_of_chars()
        ranks = {bytes(as_byte[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in self.added}
        coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._encode, self._batch = coder.encode_ordinary, coder.encode_ordinary_batch
        size = max([*ranks.values(), *self.added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for k, v in ranks.items():
            self.bytes[v] = k
        for k, v in self.added.items():
            self.bytes[v] = k.encode()
        self.names = [str(i) for i in range(size)]
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """``text`` cut at added tokens: (part, id), the id only of an added token."""
        if self._split is None or not any(a in text for a in self.added):
            return [(text, None)]
        return [(p, self.added.get(p)) for p in self._split.split(text) if p]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part, own in self.parts(text):
            out += [own] if own is not None else self._encode(part)
        return out

    def lengths(self, texts: list[str]) -> list[int]:
        """How many ids each text has, by one call for all parts of the batch."""
        cut = [(k, part, own) for k, t in enumerate(texts) for part, own in self.parts(t)]
        out = [0] * len(texts)
        for (k, _, own), ids in zip(cut, self._batch([part for _, part, _ in cut], num_threads=1), strict=True):
            out[k] += len(ids) if own is None else 1
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become U+FFFD, as the library has it."""
        raw = b"".join([self.bytes[i] for i in ids])
        return raw.decode("utf-8", "replace").encode()


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def pieces(text: str, most: int) -> list[str]:
    """``text`` cut at safe boundaries into parts of about ``most`` characters; a run without one stays whole."""
    if len(text) <= most:
        return [text]
    out, at = [], 0
    while len(text) - at > most:
        cut = SAFE.search(text, at + most)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out
