"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Each match of the split pattern is merged on its own: a segment tree over its
byte positions holds at every node the smallest pair rank below it, the left one
of equals. The root is the next merge; it changes the pair of the merged token
and that of its left neighbour, which are two point updates along the path to
the root. All distinct matches of a batch that are not known yet are merged in
lockstep, one numpy row each, by tree size.
"""

import base64
import hashlib
import itertools
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hitscope.llm.common import id_and_text, row_slices, utf8

_NONE = np.int32(np.iinfo(np.int32).max)
#: Longest tree that is worked on in lockstep.
_LOCKSTEP = 256
#: Bytes of text in work at once, matches in work at once, matches (and chunks) remembered by a worker.
_BYTES, _MATCHES, _KNOWN = 1 << 21, 1 << 18, 250_000


class Vocabulary:
    """Ranks of a tiktoken file and what follows from them."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], np.array(merged, np.int32)[order]
        self.known: dict[str, bytes] = {}
        self.chunks: dict[str, bytes | None] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, _NONE if it makes none (or an id is -1)."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.merged[at], _NONE)

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ids of byte strings of at most data.shape[1] bytes, one a row, -1 where there is none.

        A row's live tokens form a list linked in both directions, as a merge
        leaves gaps between them.
        """
        n, width = data.shape
        rows = np.arange(n)
        ids = np.where(np.arange(width) < lengths[:, None], self.single[data], -1)
        after = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        leaves = np.full((n, width), _NONE, np.int32)
        leaves[:, :-1] = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        # Level by level from the leaves: the smallest rank of a node and the position of its leftmost holder.
        ranks, places = [leaves], [np.broadcast_to(np.arange(width), (n, width)).copy()]
        while ranks[-1].shape[1] > 1:
            low, at = ranks[-1], places[-1]
            right = low[:, 1::2] < low[:, 0::2]
            ranks.append(np.where(right, low[:, 1::2], low[:, 0::2]))
            places.append(np.where(right, at[:, 1::2], at[:, 0::2]))

        def put(rows: np.ndarray, node: np.ndarray, rank: np.ndarray) -> None:
            ranks[0][rows, node] = rank
            for level in range(len(ranks) - 1):
                node = node >> 1
                low, at = ranks[level], places[level]
                a, b = low[rows, 2 * node], low[rows, 2 * node + 1]
                right = b < a
                ranks[level + 1][rows, node] = np.where(right, b, a)
                places[level + 1][rows, node] = np.where(right, at[rows, 2 * node + 1], at[rows, 2 * node])

        while True:
            rows = rows[ranks[-1][rows, 0] != _NONE]
            if not len(rows):
                return ids
            here = places[-1][rows, 0]
            gone = after[rows, here]
            ids[rows, here] = ranks[-1][rows, 0]
            ids[rows, gone] = -1
            following = after[rows, gone]
            after[rows, here] = following
            inner = following < width
            before[rows[inner], following[inner]] = here[inner]
            put(rows, gone, np.full(len(rows), _NONE, np.int32))
            right_id = np.where(inner, ids[rows, np.minimum(following, width - 1)], -1)
            put(rows, here, self.pair_ranks(ids[rows, here], right_id))
            has_left = before[rows, here] >= 0
            some, left = rows[has_left], before[rows, here][has_left]
            put(some, left, self.pair_ranks(ids[some, left], ids[some, here[has_left]]))

    def merge_long(self, data: bytes) -> list[int]:
        """The same for one long string, with the tree in plain lists, as there is nothing to do in lockstep."""
        n = len(data)
        ids = self.single[np.frombuffer(data, np.uint8)]
        pairs = self.pair_ranks(ids[:-1], ids[1:])
        size = 1 << max(1, (n - 1).bit_length())
        none = int(_NONE)
        # Leaf i holds rank << 32 | i, so that the least of two nodes is also the leftmost of equal ranks.
        top = none << 32
        leaves = np.full(size, top, np.int64)
        leaves[: n - 1] = (pairs.astype(np.int64) << 32) | np.arange(n - 1)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][0::2], levels[-1][1::2]))
        tree = np.concatenate([np.array([top]), *levels[::-1]]).tolist()
        ids = ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = self.rank_of

        def put(at: int, rank: int) -> None:
            node = size + at
            tree[node] = rank << 32 | at
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a <= b else b
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1

        while tree[1] >> 32 != none:
            here = tree[1] & 0xFFFFFFFF
            gone = after[here]
            ids[here], ids[gone] = tree[1] >> 32, -1
            following = after[here] = after[gone]
            put(gone, none)
            if following < n:
                before[following] = here
                put(here, rank_of(ids[here], ids[following]))
            else:
                put(here, none)
            left = before[here]
            if left >= 0:
                put(left, rank_of(ids[left], ids[here]))
        return [i for i in ids if i >= 0]

    def rank_of(self, left: int, right: int) -> int:
        merged = self.tokens[left] + self.tokens[right]
        return self.ranks.get(merged, int(_NONE))

    def forget(self) -> None:
        """Let go of all that was learnt."""
        self.known.clear()
        self.chunks.clear()

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        sizes = np.maximum(1, 2 ** np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for width in np.unique(sizes).tolist():
            members = np.flatnonzero(sizes == width)
            if width > _LOCKSTEP:
                for i in members.tolist():
                    self.known[words[i]] = np.array(self.merge_long(raw[i]), "<u4").tobytes()
                continue
            step = max(1, (1 << 19) // width)
            for start in range(0, len(members), step):
                chosen = members[start : start + step]
                data = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in chosen.tolist()), np.uint8)
                ids = self.merge(data.reshape(len(chosen), width), lengths[chosen])
                counts = (ids >= 0).sum(axis=1)
                flat = ids[ids >= 0].astype("<u4").tobytes()
                end = 0
                for i, count in zip(chosen.tolist(), counts.tolist()):
                    self.known[words[i]] = flat[end : end + 4 * count]
                    end += 4 * count

    def encode_matches(self, matches: list[str]) -> bytes:
        """Ids of matches of the pattern as little-endian 32-bit numbers."""
        self.learn([w for w in set(matches) if w not in self.known])
        return b"".join(map(self.known.__getitem__, matches))

    def learn_chunks(self, chunks: set[str]) -> None:
        """Remember the ids of a space and each chunk. None: its ids depend on its neighbours."""
        plain = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        matched = [self.pattern.findall(" " + c) for c in plain]
        self.learn([w for w in set(itertools.chain.from_iterable(matched)) if w not in self.known])
        get = self.known.__getitem__
        self.chunks.update(dict.fromkeys(chunks))
        self.chunks.update((c, b"".join(map(get, m))) for c, m in zip(plain, matched))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers.

        A space between two characters that are none always begins a match, so
        what lies between such spaces is looked up as a whole. Texts with other
        blanks beside a space are matched as they are, long ones bit by bit.
        """
        if len(self.known) > _KNOWN:
            self.known.clear()
        split = [text.split(" ") for text in texts]
        unknown = {c for c in set().union(*(x[1:] for x in split)) if c not in self.chunks}
        if unknown:
            if len(self.chunks) + len(unknown) > _KNOWN:
                self.chunks.clear()
                unknown = set().union(*(x[1:] for x in split))
            self.learn_chunks(unknown)
        firsts = [self.pattern.findall(x[0]) for x in split]
        self.learn([w for w in set(itertools.chain.from_iterable(firsts)) if w not in self.known])
        get, out = self.chunks.__getitem__, []
        for text, chunks, matches in zip(texts, split, firsts):
            first = chunks[0]
            ids = None
            if len(chunks) == 1 or first and not first[-1].isspace():
                rest = list(map(get, chunks[1:]))
                if None not in rest:
                    ids = b"".join([*map(self.known.__getitem__, matches), *rest])
            if ids is None:
                found = (m.group() for m in self.pattern.finditer(text))
                parts = []
                while part := list(itertools.islice(found, _MATCHES)):
                    parts.append(self.encode_matches(part))
                ids = b"".join(parts)
            out.append(ids)
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the text that ids (as encode gives them) stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Loaded once a worker."""
    return Vocabulary(path, pattern)


@contextmanager
def learning(path: str, pattern: str) -> Iterator[Vocabulary]:
    """The vocabulary for one task; a worker that waits, or does other work, keeps none of the words, nor Arrow's freed memory."""
    vocab = vocabulary(path, pattern)
    try:
        yield vocab
    finally:
        vocab.forget()
        pa.default_memory_pool().release_unused()


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, list]]:
    column = batch.column(name)
    for start, stop in row_slices(utf8(column)[1], _BYTES):
        yield start, column.slice(start, stop - start).to_pylist()


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: each whole text as ids, little-endian unsigned 32-bit in a binary.

    *ranks_path* is a tiktoken file that every executor can open. NULL texts are
    empty and have no ids; repeated rows give repeated rows, a NULL id stays.
    """

    def run(batches):
        with learning(ranks_path, pattern) as vocab:
            for batch in batches:
                for start, texts in _texts(batch, "text"):
                    ids = vocab.encode(texts)
                    yield pa.record_batch([batch.column("doc_id").slice(start, len(ids)), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids binary")


def decode_ids(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded``: the bytes that ``ids`` (as encode_texts gives them) stand for; NULL ids are none."""

    def run(batches):
        vocab = vocabulary(ranks_path, pattern)
        for batch in batches:
            for start, ids in _texts(batch, "ids"):
                decoded = [vocab.decode(x or b"") for x in ids]
                yield pa.record_batch(
                    [batch.column("doc_id").slice(start, len(ids)), pa.array(decoded, pa.binary())], ["doc_id", "decoded"]
                )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the round trip of each whole text, in one pass."""

    def run(batches):
        with learning(ranks_path, pattern) as vocab:
            for batch in batches:
                for start, texts in _texts(batch, "text"):
                    ids = vocab.encode(texts)
                    yield pa.record_batch(
                        [
                            batch.column("doc_id").slice(start, len(ids)),
                            pa.array([len(x) // 4 for x in ids], pa.int64()),
                            pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                            pa.array([hashlib.sha256(vocab.decode(x)).hexdigest() for x in ids]),
                        ],
                        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                    )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs).mapInArrow(run, schema)
