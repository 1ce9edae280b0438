"""Word and shingle hashes of whole batches of texts in a few numpy passes over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

BLOCK = 1 << 20
SLICE = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """A 64-bit number for each byte after lower-casing A-Z; white space has 0."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = mix(x)
    x[65:91] = x[97:123]
    return x


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LETTERS = _letters()
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: For bags of words: everything in ASCII that's no letter or digit separates.
NO_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: The base's inverse modulo 2^64.
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, ``n`` of them at least."""
    if n > len(_POW[0]):
        for k, b in enumerate((_BASE, _BACK)):
            _POW[k] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n + n // 2, b, np.uint64)]))
    return _POW


def word_hashes(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()) -> tuple:
    """Of texts raw[offsets[i]:offsets[i+1]]: hash, start and end of each word, and the number of the first word of each text.

    With ``prefixes`` also a list with the hashes of so many leading bytes of each word. More than SLICE bytes are worked through in slices
    that end at a gap, so memory stays bounded by the slice (or its longest word) and 8 bytes a word, however long a text is.
    """
    if len(raw) > SLICE:
        parts, at = [], 0
        while at < len(raw):
            to = min(len(raw), at + SLICE)
            if to < len(raw) and not (space[raw[to - 1]] or space[raw[to]]):
                back = np.flatnonzero(space[raw[at:to]])
                ahead = back[-1:] + at + 1 if len(back) else np.array([_next_gap(raw, to, space)])
                to = int(ahead[0])
            inner = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to, "right")] - at
            got = word_hashes_of(raw[at:to], inner, space, prefixes)
            parts.append((got[0], got[1] + at, got[2] + at, *(got[4:] and [got[4]])))
            at = to
        hashes, starts, ends = (np.concatenate([p[k] for p in parts]) for k in range(3))
        out = (hashes, starts, ends, np.searchsorted(starts, offsets))
        return out + ([np.concatenate([p[3][k] for p in parts]) for k in range(len(prefixes))],) if prefixes else out
    return word_hashes_of(raw, offsets, space, prefixes)


def _next_gap(raw: np.ndarray, at: int, space: np.ndarray) -> int:
    while at < len(raw):
        gaps = np.flatnonzero(space[raw[at : at + SLICE]])
        if len(gaps):
            return at + int(gaps[0])
        at += SLICE
    return len(raw)


def word_hashes_of(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray, prefixes: tuple[int, ...]) -> tuple:
    """``word_hashes`` in one go."""
    n = len(raw)
    gap = space[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    word = ~gap
    before = np.concatenate([[False], word[:-1]]) if n else word
    starts = np.flatnonzero(word & (~before | edge[:n]))
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return (none, starts, starts, np.zeros(len(offsets), np.int64)) + (([none] * len(prefixes),) if prefixes else ())
    after = np.concatenate([word[1:], [False]])
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    # a word's polynomial is a difference of running sums, moved back to power 0
    power, back = _powers(n)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(LETTERS[raw] * power[:n], out=run[1:])
    value = lambda to: (run[to] - run[starts]) * back[starts]
    out = (mix(value(ends) + (ends - starts).astype(np.uint64)), starts, ends, np.searchsorted(starts, offsets))
    if prefixes:
        out += ([mix(value(np.minimum(ends, starts + k)) + np.uint64(1000 + k)) for k in prefixes],)
    return out


def blocks(col: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of slices of a string column of about ``most`` bytes; nulls are empty."""
    col = pa.compute.fill_null(col, "") if col.null_count else col
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        to = min(to, len(col))
        yield at, to, data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


#: One odd multiplier for each place of a shingle.
PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of each run of ``k`` words; of fewer words the whole sequence as one; none of none."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        return mix(np.array([np.add.reduce(words * PLACES[8 : 8 + n]) + np.uint64(n)], np.uint64))
    out = words[: n - k + 1] * PLACES[0]
    for j in range(1, k):
        out += words[j : n - k + 1 + j] * PLACES[j]
    return mix(out)


def runs(h: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of all texts of a block at once, given its word hashes and the first word of each text: hashes, and where each text's begin."""
    sizes = np.diff(first)
    n = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(begin[-1], np.uint64)
    long = np.flatnonzero(sizes >= k)
    if len(long):
        every = shingles(h, k)
        at = np.arange(n[long].sum()) + np.repeat(first[long] - np.concatenate([[0], np.cumsum(n[long])[:-1]]), n[long])
        to = np.arange(len(at)) + np.repeat(begin[long] - np.concatenate([[0], np.cumsum(n[long])[:-1]]), n[long])
        out[to] = every[at]
    for i in np.flatnonzero((sizes > 0) & (sizes < k)).tolist():
        out[begin[i]] = shingles(h[first[i] : first[i + 1]], k)[0]
    return out, begin


def shingles_of(col: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """Shingle hashes of each text, with repeats."""
    for a, b, raw, off in blocks(col):
        h, _, _, first = word_hashes(raw, off)
        s, begin = runs(h, first, k)
        for i in range(b - a):
            yield s[begin[i] : begin[i + 1]]


def of_texts(col: pa.Array, space: np.ndarray = SPACE) -> Iterator[np.ndarray]:
    """Word hashes of each text."""
    for a, b, raw, off in blocks(col):
        h, _, _, first = word_hashes(raw, off, space)
        for i in range(b - a):
            yield h[first[i] : first[i + 1]]
