"""Hashed word shingles of texts, cut for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Text bytes, at least, that are cut at once; a longer text is cut alone.
GROUP_BYTES = 1 << 20
#: Words of so many bytes and more are hashed one by one.
LONG = 48
_RANDOM = np.random.default_rng(0x5348494E)
#: A word's hash is the sum over its bytes of byte value times place.
_BYTE, _PLACE = (_RANDOM.integers(0, 1 << 64, n, np.uint64) | np.uint64(1) for n in (256, LONG))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    r"""Where each word ``[^\x20\x09-\x0D]+`` of a lower-cased text starts, and its hash."""
    a = np.frombuffer(text, np.uint8)
    space = np.concatenate([[True], _SPACE[a], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[::2], edge[1::2]
    size = end - start
    out = np.zeros(len(start), np.uint64)
    short = np.flatnonzero(size < LONG)
    # as many short words at once as GROUP_BYTES bytes have
    total = np.cumsum(size[short])
    cuts = np.searchsorted(total, np.arange(GROUP_BYTES, total[-1], GROUP_BYTES)) if len(short) else np.zeros(0, np.int64)
    for w in np.split(short, np.unique(cuts[cuts > 0])):
        n = size[w]
        if len(w):
            first = np.cumsum(n) - n
            place = np.arange(n.sum()) - np.repeat(first, n)
            out[w] = np.add.reduceat(_BYTE[a[np.repeat(start[w], n) + place]] * _PLACE[place], first)
    for w in np.flatnonzero(size >= LONG).tolist():
        out[w] = xxhash.xxh3_64_intdigest(text[start[w]:end[w]])
    return start, mix(out + size.astype(np.uint64) * _MULTIPLIERS[0])


def _combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` words in a row."""
    m = len(hashes) - n + 1
    h = np.full(max(m, 0), n, np.uint64)
    for j in range(n if m > 0 else 0):
        h += hashes[j:j + m] * (_MULTIPLIERS[j % 5] + np.uint64(2 * (j // 5)))
    return mix(h)


def _cut(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    start, hashes = word_hashes(b"\n".join(texts).lower())
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    word = np.searchsorted(start, begin).tolist()
    whole = _combine(hashes, size)
    for at, end in zip(word, word[1:], strict=False):
        n = end - at
        h = np.sort(whole[at:end - size + 1] if n >= size else _combine(hashes[at:end], n) if n else hashes[:0])
        yield h[np.concatenate([[True], h[1:] != h[:-1]])] if n else h


def shingle_sets(texts: Iterator[bytes], size: int = 5) -> Iterator[np.ndarray]:
    """Of each text, the sorted distinct 64-bit hashes of its ``size``-word
    shingles (A-Z lowered); of fewer words, the whole sequence is one; without
    words, none. Texts are cut in groups of about ``GROUP_BYTES``."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= GROUP_BYTES:
            yield from _cut(held, size)
            held, n = [], 0
    if held:
        yield from _cut(held, size)


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    return next(shingle_sets(iter([text]), size))


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name a set."""
    with np.errstate(over="ignore"):
        one = int(mix(hashes).sum(dtype=np.uint64))
        two = int(mix(hashes ^ _MULTIPLIERS[0]).sum(dtype=np.uint64))
    return one - (1 << 63), two - (1 << 63)
