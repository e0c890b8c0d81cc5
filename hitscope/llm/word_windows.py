"""Words of whole texts as arrays of hashes, for the operators that compare runs of words."""

from dataclasses import dataclass

import numpy as np

from hitscope.llm import rolling
from hitscope.llm.common import row_slices

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


@dataclass
class Words:
    """Words of some rows, one after another; word i is bytes [starts[i], ends[i])."""

    starts: np.ndarray
    ends: np.ndarray
    row_ends: np.ndarray  # number of words up to the end of each row
    hashes: list[np.ndarray]  # one array for each seed

    @property
    def row_starts(self) -> np.ndarray:
        return np.concatenate([[0], self.row_ends[:-1]])

    @property
    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.row_ends)), self.row_ends - self.row_starts)


def words_of(data: np.ndarray, offsets: np.ndarray, seeds: tuple[int, ...] = (1,)) -> Words:
    """Words, that is runs of other bytes than space, tab, LF, VT, FF and CR, of rows of bytes.

    Rows are worked on in slices of a megabyte; of a longer word the hash is
    the sum of those of its parts.
    """
    starts, ends, rows = [], [], []
    hashes: list[list[np.ndarray]] = [[] for _ in seeds]
    for low, high in row_slices(offsets, rolling.BLOCK):
        part = data[offsets[low] : offsets[high]]
        word = ~_BLANK[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[1:-1] = word[1:] != word[:-1]
        inner = offsets[low : high + 1] - offsets[low]
        edge[inner] = True
        cuts = np.flatnonzero(edge[: len(part)])
        first = cuts[word[cuts]] if len(cuts) else cuts
        stop = np.append(cuts, len(part))[1:][word[cuts]] if len(cuts) else cuts
        starts.append(first + offsets[low])
        ends.append(stop + offsets[low])
        rows.append(np.searchsorted(first, inner[1:], "left"))
        for seed, out in zip(seeds, hashes):
            if len(part) <= rolling.BLOCK:
                sums = rolling.prefix_sums(rolling.byte_codes(seed)[part], seed)
                out.append(rolling.stretch_hashes(sums, first, stop, seed))
            else:
                out.append(_long_row_hashes(part, first, stop, seed))
    counts = np.concatenate([np.diff(r, prepend=0) for r in rows]) if rows else np.zeros(0, np.int64)
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return Words(join(starts, np.int64), join(ends, np.int64), np.cumsum(counts), [join(h, np.uint64) for h in hashes])


def _long_row_hashes(part: np.ndarray, first: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """The same hashes for a row beyond the block size: words are hashed in groups that fit one."""
    out = np.zeros(len(first), np.uint64)
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(stop, first[at] + rolling.BLOCK, "right")))
        low, high = int(first[at]), int(stop[to - 1])
        if high - low <= rolling.BLOCK:
            sums = rolling.prefix_sums(rolling.byte_codes(seed)[part[low:high]], seed)
            out[at:to] = rolling.stretch_hashes(sums, first[at:to] - low, stop[at:to] - low, seed)
        else:
            total = 0
            for cut in range(low, high, rolling.BLOCK):
                piece = part[cut : min(cut + rolling.BLOCK, high)]
                sums = rolling.prefix_sums(rolling.byte_codes(seed)[piece], seed)
                total = (total * 0x9E3779B97F4A7C15 + int(sums[-1]) + 1) & ((1 << 64) - 1)
            out[at] = total
        at = to
    return out


def runs_of_words(words: Words, length: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash (by the first seed) of every run of *length* words within a row."""
    return _runs(words, length, words.hashes[0], seed)


def _runs(words: Words, length: int, hashes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    found, values = [], []
    lengths = words.row_ends - words.row_starts
    for batch in rolling.pieces(lengths, length - 1):
        first = np.array([words.row_starts[r] + a for r, a, _ in batch])
        last = np.array([words.row_starts[r] + b for r, _, b in batch])
        low, high = int(first[0]), int(last[-1])
        sums = rolling.prefix_sums(hashes[low:high], seed)
        own = rolling.window_hashes(sums, length, seed)
        valid = np.zeros(len(own), bool)
        for a, b in zip((first - low).tolist(), (last - low).tolist()):
            valid[a : max(a, b - length + 1)] = True
        at = np.flatnonzero(valid)
        found.append(at + low)
        values.append(own[at])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(found), np.concatenate(values)
