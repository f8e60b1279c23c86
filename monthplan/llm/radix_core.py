"""Digits of the windows of byte texts, for whole chunks of documents at once.

A window of ``size`` bytes is read starting at its anchor: of its grams of ``gram`` bytes the one that a fixed hash
ranks lowest, the leftmost of equals. Equal windows have equal anchors at equal offsets, so windows are equal exactly
if these digits are, most significant first: the anchor gram, then what stands around it. Consecutive windows share an
anchor, so one row stands for a whole run of suffixes until a later digit has to tell them apart.
"""

from __future__ import annotations

import numpy as np

from .shingles import mix64

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _cache.get(base)
    if known is None or len(known[0]) < n:
        size, out = -(-n // 500_000) * 500_000, []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, np.uint64(b))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        known = _cache[base] = (out[0], out[1])
    return known[0][:n], known[1][:n]


def forget() -> None:
    """Give the tables of powers back: workers outlive tasks and stages."""
    _cache.clear()


class Rolling:
    """Hash of any byte range of one buffer in constant time; ``which`` selects one of two independent bases."""

    def __init__(self, data: np.ndarray, which: int):
        up, self._down = _powers(_BASES[which], len(data) + 1)
        self._total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self._total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self._total[ends] - self._total[starts]) * self._down[starts])

    def every(self, length: int) -> np.ndarray:
        """Of all ranges of one length, by start."""
        n = len(self._total) - length
        return mix64((self._total[length:] - self._total[:n]) * self._down[:n])


def anchors(data: np.ndarray, bounds: np.ndarray, size: int, gram: int) -> dict[str, np.ndarray]:
    """One row for each run of windows with the same anchor: doc (index), lo and end (bytes of the run, in ``data``),
    at (the anchor), first and second (the gram's hash, and that of all the run's bytes and shape).

    ``bounds`` holds where each document starts in ``data``, and the end of the last. ``data`` has under 2^32 bytes.
    """
    names = ("doc", "lo", "end", "at", "first", "second")
    width = size - gram + 1
    if len(data) < size:
        return {n: np.zeros(0, np.uint64 if n in ("first", "second") else np.int64) for n in names}
    rolling = Rolling(data, 0)
    grams = rolling.every(gram)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[:len(key) - (width - span)], key[width - span:])
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)  # by window start
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(at)]
    inside = np.arange(len(at)) + size <= bounds[doc + 1]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new & inside)
    shut = np.ones(len(at), bool)
    shut[:-1] = new[1:] | ~inside[1:]
    ends = np.flatnonzero(shut & inside) + size
    at = at[starts]
    second = Rolling(data, 1).of(starts, ends)
    second = mix64(second + (at - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + (ends - starts).astype(np.uint64))
    return dict(zip(names, (doc[starts], starts, ends, at, grams[at], second), strict=True))
