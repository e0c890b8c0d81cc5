"""Vectorised rolling hashes and window minimisers over arrays.

Symbols are mapped to random 64-bit numbers and summed with the powers of an odd
number, modulo 2**64, so that the hash of any stretch is the difference of two
prefix sums, times an inverse power that makes it independent of its place.
"""

from functools import lru_cache

import numpy as np

#: Symbols handled at once; bounds the memory of a task.
BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit number over all its bits (in place where it can be)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(4)
def _powers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    base = (0x5851F42D4C957F2D + 2 * seed * 0x2545F4914F6CDD1D) & ((1 << 64) - 1) | 1
    inverse = pow(base, -1, 1 << 64)
    out = []
    for number in (base, inverse):
        powers = np.full(BLOCK + 1, number, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


@lru_cache(4)
def byte_codes(seed: int) -> np.ndarray:
    """A random number for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed * 977))


def prefix_sums(codes: np.ndarray, seed: int) -> np.ndarray:
    """Prefix sums of codes[i] * base**i for at most BLOCK codes, with a leading 0."""
    powers, _ = _powers(seed)
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers[: len(codes)], out=out[1:])
    return out


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each stretch [start, end); equal stretches have equal hashes wherever they are."""
    _, inverse = _powers(seed)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def window_hashes(sums: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of every window of *length* codes, by its start."""
    n = len(sums) - length
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, inverse = _powers(seed)
    return mix((sums[length:] - sums[:n]) * inverse[:n])


def window_minimisers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of each *width* hashes in a row, the leftmost of equal ones.

    Only the 44 upper bits of the (at most BLOCK) hashes decide; which of the
    windows are wanted is up to the caller.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = np.uint64(BLOCK - 1)
    blocks = -(-len(hashes) // width)
    padded = np.full(blocks * width, np.uint64((1 << 64) - 1))
    padded[: len(hashes)] = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def pieces(lengths: np.ndarray, overlap: int, limit: int = BLOCK) -> list[list[tuple[int, int, int]]]:
    """Batches of (row, start, end) that cover rows of the given lengths, *limit* symbols to a batch.

    A row longer than a batch is cut with *overlap* symbols in common, so that
    every window of overlap + 1 symbols starts in exactly one piece that holds
    all of it.
    """
    batches: list[list[tuple[int, int, int]]] = [[]]
    room = limit
    for row, n in enumerate(lengths.tolist()):
        start = 0
        while True:
            end = min(n, start + limit)
            if end - start > room and batches[-1]:
                batches.append([])
                room = limit
            batches[-1].append((row, start, end))
            room -= end - start
            if end == n:
                break
            start = end - overlap
    return [b for b in batches if b]


def runs(values: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values; a true break also starts a run."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.empty(len(values), bool)
    new[0] = True
    np.not_equal(values[1:], values[:-1], out=new[1:])
    if breaks is not None:
        new |= breaks
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(values))
