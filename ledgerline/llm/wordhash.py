"""Words of a text and their 64-bit hashes, whole arrays at a time. Words are ``[^\\x20\\x09-\\x0D]+``."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_FACTOR = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        more = np.full(max(1024, 2 * n), _FACTOR, np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers[:n]


def encode(text: str | None, lower: bool = False) -> np.ndarray:
    """UTF-8 bytes; with ``lower``, A-Z lower-cased."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return _LOWER[data] if lower else data


def word_hashes(data: np.ndarray) -> np.ndarray:
    """One hash per word, in order. Equal words have equal hashes wherever they stand."""
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edges = np.concatenate([[0], edges])
    starts = edges[::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = edges[1::2] if len(edges) % 2 == 0 else np.append(edges[1::2], len(data))
    first = starts[0]
    gaps = np.diff(np.append(starts, len(data)))
    place = np.arange(first, len(data)) - np.repeat(starts, gaps)
    value = data[first:].astype(np.uint64) + np.uint64(1)
    value[space[first:]] = 0
    sums = np.add.reduceat(value * powers(int(gaps.max()))[place], starts - first)
    return mix(sums ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of n consecutive words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(_FACTOR) + mix(hashes[k : k + len(out)] + np.uint64(k + 1))
    return mix(out)


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per range [start, end) of words; ranges may overlap. Equal word sequences have equal hashes."""
    weights = powers(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * weights[: len(hashes)], dtype=np.uint64)])
    inverse = _inverse_powers(len(hashes) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


_inverses = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        more = np.full(max(1024, 2 * n), pow(_FACTOR, -1, 2**64), np.uint64)
        more[0] = 1
        _inverses = np.multiply.accumulate(more)
    return _inverses[:n]
