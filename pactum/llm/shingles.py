"""Hashed word n-grams of many texts at once, with array operations over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at a time; a longer text is handled alone.
BLOCK = 1 << 20
_RNG = np.random.default_rng(20240229)
_LETTER = _RNG.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
#: 3 modulo 8, so that powers of it differ as early as odd numbers can.
_BASE = int(_RNG.integers(0, 1 << 61)) * 8 + 3
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(max(size, BLOCK * 2), base % (1 << 64), np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words between white space, A-Z as a-z, and where each begins."""
    codes = np.frombuffer(raw.lower(), np.uint8)
    inside = np.zeros(len(codes) + 2, bool)
    np.logical_not(_SPACE[codes], out=inside[1:-1])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turns[::2], turns[1::2]
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_LETTER[codes] * up[:len(codes)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin


def blocks(texts: list[str | None]) -> Iterator[tuple[list[int], bytes, np.ndarray]]:
    """Texts joined by line feeds: their numbers, the bytes and where each text begins."""
    held: list[bytes] = []
    first = size = 0
    for i, text in enumerate(texts):
        raw = text.encode() if text else b""
        if held and size + len(raw) > BLOCK:
            yield list(range(first, i)), b"\n".join(held), np.cumsum([0] + [len(x) + 1 for x in held[:-1]])
            held, first, size = [], i, 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield list(range(first, len(texts))), b"\n".join(held), np.cumsum([0] + [len(x) + 1 for x in held[:-1]])


def shingle_sets(texts: list[str | None], size: int, levels: tuple[np.ndarray, np.ndarray] | None = None,
                 words: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """For each text its sorted distinct shingles, their ranks, and its word hashes.

    `levels` are sorted word hashes and how common each is; a shingle's rank is the sum over its words.
    A text of fewer words than `size` is one shingle; without words it has none.
    """
    for numbers, raw, starts in blocks(texts):
        hashes, begin = word_hashes(raw)
        level = np.zeros(len(hashes), np.int64)
        if levels is not None and len(levels[0]):
            at = np.minimum(np.searchsorted(levels[0], hashes), len(levels[0]) - 1)
            level = np.where(levels[0][at] == hashes, levels[1][at], 0)
        bounds = np.append(np.searchsorted(begin, starts), len(hashes))
        total, rank = combine(hashes, size), None
        if levels is not None:
            rank = np.convolve(level, np.ones(size, np.int64), "valid") if len(level) >= size else np.zeros(0, np.int64)
        for k in range(len(numbers)):
            low, high = bounds[k], bounds[k + 1]
            own = hashes[low:high] if words else None
            if high - low >= size:
                part = total[low:high - size + 1]
                order = np.argsort(part)
                part = part[order]
                fresh = np.ones(len(part), bool)
                fresh[1:] = part[1:] != part[:-1]
                yield part[fresh], None if rank is None else rank[low:high - size + 1][order][fresh], own
            elif high > low:
                yield combine(hashes[low:high], high - low), None if rank is None else level[low:high].sum(keepdims=True), own
            else:
                yield np.zeros(0, np.uint64), None if rank is None else np.zeros(0, np.int64), own


def combine(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words."""
    count = len(hashes) - size + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + count])
    return total
