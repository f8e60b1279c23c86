"""Word-shingle sets of texts as sorted 64-bit hashes, computed over many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += np.uint64(0x20)
_LOWER += np.uint64(1)  # no byte counts as nothing
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2^64."""
    if len(_powers["up"]) < n:
        size = -(-n // 500_000) * 500_000
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def forget() -> None:
    """Give the tables of powers back: workers outlive tasks and stages."""
    _powers["up"] = _powers["down"] = np.ones(1, np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, number of words of each text).

    A-Z are lower-cased; words are the longest runs without space, tab, line feed, vertical tab, form feed, return.
    """
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]  # a space closes the data, so starts and ends pair up
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * up[:-1], out=total[1:])
    words = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    begins = np.cumsum([0, *(len(r) + 1 for r in raws)])
    return words, np.diff(np.searchsorted(starts, begins))


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles of ``width`` words as sorted hashes; with fewer words, the one of them all."""
    words, counts = word_hashes(texts)
    n = len(words)
    roll = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width if len(roll) else 0):
        roll += mix64(words[k:n - width + 1 + k] + np.uint64(k + 1))
    roll = mix64(roll)
    out, at = [], 0
    for count in counts.tolist():
        if count >= width:
            out.append(np.unique(roll[at:at + count - width + 1]))
        elif count:
            whole = sum(int(h) * (2 * k + 3) for k, h in enumerate(mix64(words[at:at + count] + np.uint64(77)))) + count
            out.append(mix64(np.array([whole & (1 << 64) - 1], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out
