"""Substring deduplication by relative Lempel-Ziv parsing over words.

The reference of a document is what comes earlier in the corpus (smaller ``doc_id``,
or the same document further ahead), each run of *window* words at one place only. It is
indexed in blocks, by hashed runs: the documents that a task gathers are one
block, in which a run's place is the first there; the hash partitions of the shuffle
that follows are the others, which hold the runs that were first in a task, with their first
places in the corpus. So a match of *window* words or more has one candidate place
in the block that answers, and is the longest there when it has been followed for as long as the
document's next runs lie next to it.

``parse`` takes that match wherever the previous factor ends, and goes on behind
it. Runs that cross the border of two factors are in neither; those that were found are
spans too, marked as such. What is removed, the union of all, does not depend on how
the documents are dealt to tasks. Where factors end does, if a run has several
earlier places: a longer match at a later copy in another task is not sought.

To keep the index small, only runs whose minimiser (the least hash of the word
8-grams in them) occurs at least twice in the corpus are looked up at all: a
repeated run has a repeated minimiser. Tasks aggregate before each shuffle, so
that a passage of every document sends one row per task to its block.
"""

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hitscope.llm import rolling
from hitscope.llm.common import id_and_text, sliced, utf8
from hitscope.llm.word_windows import Words, _runs, words_of

#: Words of a seed; a window of n words has n - SEED_WORDS + 1 of them.
SEED_WORDS = 8
#: Rows that a task gathers before it aggregates them.
_GATHER = 1 << 20


def _seeded_windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every window, first word of its minimiser, and the hash of that."""
    starts, minimisers, hashes = [], [], []
    lengths = words.row_ends - words.row_starts
    for batch in rolling.pieces(lengths, window - 1):
        first = [int(words.row_starts[r]) + a for r, a, _ in batch]
        last = [int(words.row_starts[r]) + b for r, _, b in batch]
        low, high = first[0], last[-1]
        sums = rolling.prefix_sums(words.hashes[0][low:high], 5)
        grams = rolling.window_hashes(sums, min(SEED_WORDS, window), 5)
        least = rolling.window_minimisers(grams, window - min(SEED_WORDS, window) + 1)
        valid = np.zeros(len(least), bool)
        for a, b in zip(first, last):
            valid[a - low : max(a, b - window + 1) - low] = True
        at = np.flatnonzero(valid)
        starts.append(at + low)
        minimisers.append(least[at] + low)
        hashes.append(grams[least[at]])
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(starts, np.int64), join(minimisers, np.int64), join(hashes, np.uint64)


def _place_key(doc: np.ndarray, position: np.ndarray) -> np.ndarray:
    """A negative key that spreads rows that need no company; those of seeds are not negative."""
    spread = rolling.mix(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + position.astype(np.uint64))
    return (spread | np.uint64(1 << 63)).view(np.int64)


def _seed_keys(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(1)).view(np.int64)


def _seed_rows(key: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """Seeds of a task: those it has once; a witness of those it has more often; and these by themselves, once a document."""
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    often = counts[inverse] > 1
    witness = np.unique(key[often])
    pairs = np.unique(np.stack([doc[often], key[often]]), axis=1)
    none = np.zeros(len(witness), np.int64)
    bare = np.concatenate([np.zeros(np.count_nonzero(~often) + pairs.shape[1], bool), none == 0])
    return pa.record_batch(
        [
            pa.array(np.concatenate([key[~often], _place_key(pairs[0], pairs[1]), witness])),
            pa.array(np.concatenate([doc[~often], pairs[0], none]), mask=bare),
            pa.array(
                np.concatenate([np.zeros(np.count_nonzero(~often), np.int64), pairs[1], none]),
                mask=np.concatenate([np.ones(np.count_nonzero(~often), bool), np.zeros(pairs.shape[1], bool), none == 0]),
            ),
        ],
        ["key", "doc_id", "seed"],
    )


def repeated_seeds(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, seeds``: the keys of a document's minimisers that occur twice or more in the corpus."""

    def run(batches):
        parts, size = [], 0
        for batch in sliced(batches, "text"):
            words = words_of(*utf8(batch.column("text")))
            _, minimiser, value = _seeded_windows(words, window)
            minimiser, pick = np.unique(minimiser, return_index=True)
            row = np.searchsorted(words.row_ends, minimiser, "right")
            parts.append((_seed_keys(value[pick]), batch.column("doc_id").to_numpy()[row]))
            size += len(minimiser)
            if size > _GATHER:
                yield _seed_rows(*map(np.concatenate, zip(*parts)))
                parts, size = [], 0
        if size:
            yield _seed_rows(*map(np.concatenate, zip(*parts)))

    rows = docs.mapInArrow(run, "key long, doc_id long, seed long")
    counted = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    return (
        counted.filter("doc_id IS NOT NULL AND (key < 0 OR n > 1)")
        .groupBy("doc_id")
        .agg(F.collect_set(F.coalesce("seed", "key")).alias("seeds"))
    )


#: h1 and h2 are 95 bits of hash; a factor within a task has h2 = -1 and its length and source.
_MATCH = "h1 long, h2 int, doc_id long, start int, factor struct<words:int,ref_doc:long,ref_start:int>"


def _match_rows(h1, h2, doc, start, window: int) -> pa.RecordBatch:
    """Windows of a task: the earliest of equal ones to look up, the rest as factors that refer to it."""
    order = np.lexsort((start, doc, h2, h1))
    h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[first]) | (start != start[first])
    f_doc, f_start, *factor = matches(
        doc[later], start[later], np.full(np.count_nonzero(later), window), doc[first][later], start[first][later], window
    )
    kinds = [("words", np.int32), ("ref_doc", np.int64), ("ref_start", np.int32)]
    n, m = np.count_nonzero(new), len(f_doc)
    columns = [pa.array(np.concatenate([np.zeros(n, np.int64), x]).astype(k)) for x, (_, k) in zip(factor, kinds)]
    both = lambda a, b, kind: pa.array(np.concatenate([a, b]).astype(kind))
    return pa.record_batch(
        [
            both(h1[new].view(np.int64), _place_key(f_doc, f_start), np.int64),
            both((h2[new] >> np.uint64(33)).view(np.int64), np.full(m, -1), np.int32),
            both(doc[new], f_doc, np.int64),
            both(start[new], f_start, np.int32),
            pa.StructArray.from_arrays(columns, [k for k, _ in kinds], mask=pa.array(np.arange(n + m) < n)),
        ],
        ["h1", "h2", "doc_id", "start", "factor"],
    )


def matches(doc, start, words, ref_doc, ref_start, window: int):
    """Runs with their sources in order, followed for as long as text and source go on without a gap."""
    order = np.lexsort((ref_start, ref_doc, start, doc))
    doc, start, words, ref_doc, ref_start = (x[order] for x in (doc, start, words, ref_doc, ref_start))
    if not len(doc):
        return doc, start, words, ref_doc, ref_start
    new = np.ones(len(doc), bool)
    windows = words - window + 1
    new[1:] = (
        (doc[1:] != doc[:-1])
        | (start[1:] != start[:-1] + windows[:-1])
        | (ref_doc[1:] != ref_doc[:-1])
        | (ref_start[1:] != ref_start[:-1] + windows[:-1])
    )
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], start[last] + words[last] - start[first], ref_doc[first], ref_start[first]


def parse(start, words, ref_doc, ref_start, window: int) -> list[tuple[int, int, int, int, bool]]:
    """Greedy parse of one document: ``(start, words, ref_doc, ref_start, border)``.

    The arguments are its ``matches``. Factors of *window* words or more are given, in order
    and apart; words between them match less. Spans with *border* cross the end of a factor.
    """
    _, *found = matches(np.zeros(len(start), np.int64), start, words, ref_doc, ref_start, window)
    found = list(zip(*(x.tolist() for x in found)))
    out, open_, at, here = [], [], 0, 0
    while at < len(found) or open_:
        while at < len(found) and found[at][0] <= here:
            a, n, doc, source = found[at]
            # The longest of those that hold a run from here on comes first.
            heappush(open_, (window - a - n, a, n, doc, source))
            at += 1
        if open_ and -open_[0][0] >= here:
            _, a, n, doc, source = heappop(open_)
            out.append((here, a + n - here, doc, source + here - a, False))
            here = a + n
        else:
            out += [(a, n, doc, source, True) for _, a, n, doc, source in open_ if a + n > here]
            open_ = []
            here = max(here, found[at][0]) if at < len(found) else here
    return sorted(out)


def found_matches(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id, found``: array of (start, words, ref_doc, ref_start), the matches of documents that have any, words counted from 0.

    *docs* has ``doc_id`` (not NULL) and ``text``.
    """

    def run(batches):
        parts, size = [], 0
        for batch in sliced(batches, "text"):
            words = words_of(*utf8(batch.column("text")), seeds=(1, 2))
            at, _, value = _seeded_windows(words, window)
            seeds = batch.column("seeds")
            seed_row = np.repeat(np.arange(batch.num_rows), seeds.value_lengths().to_numpy())
            own_row = np.searchsorted(words.row_ends, at, "right")
            in_row = lambda key, row: rolling.mix(key.view(np.uint64) ^ rolling.mix(row.astype(np.uint64)))
            pick = np.isin(in_row(_seed_keys(value), own_row), in_row(seeds.flatten().to_numpy(), seed_row))
            at = at[pick]
            values = []
            for hashes, seed in zip(words.hashes, (3, 4)):
                starts, own = _runs(words, window, hashes, seed)
                values.append(own[np.searchsorted(starts, at)])
            row = np.searchsorted(words.row_ends, at, "right")
            parts.append((*values, batch.column("doc_id").to_numpy()[row], at - words.row_starts[row]))
            size += len(at)
            if size > _GATHER:
                yield _match_rows(*map(np.concatenate, zip(*parts)), window)
                parts, size = [], 0
        if size:
            yield _match_rows(*map(np.concatenate, zip(*parts)), window)

    windows = docs.join(repeated_seeds(docs, window), "doc_id").mapInArrow(run, _MATCH)
    in_order = Window.partitionBy("h1", "h2").orderBy("doc_id", "start")
    firsts = {"first_doc": F.first("doc_id").over(in_order), "first_start": F.first("start").over(in_order)}
    earlier = windows.withColumns(firsts).filter("h2 = -1 OR doc_id != first_doc OR start != first_start")
    source = F.struct(F.lit(window).alias("words"), F.col("first_doc").alias("ref_doc"), F.col("first_start").alias("ref_start"))
    match = earlier.select("doc_id", "start", F.coalesce("factor", source).alias("f"))
    return match.groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "f.words", "f.ref_doc", "f.ref_start")).alias("found")
    )


def substring_dedup(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, factors, kept``: every document without the words that its factors cover.

    Words are runs of other bytes than ASCII blanks, unchanged; kept ones are joined by one space. A
    word goes if a run of *window* words that covers it also starts earlier in the corpus, as given. NULL and
    empty texts have no words. ``doc_id`` names a document: rows that repeat an id with the same text are
    one document and keep what it keeps (with another text, a position lost by
    one is lost by all); rows without an id lose nothing and take nothing from others.
    """
    read = id_and_text(docs)
    named = read.filter("doc_id IS NOT NULL")
    found = named.join(found_matches(named, window), "doc_id", "left")
    schema = (
        "doc_id long, n_words long, n_removed long, "
        "factors array<struct<start:int,words:int,ref_doc:long,ref_start:int,border:boolean>>, kept string"
    )

    def run(batches):
        names = ["start", "words", "ref_doc", "ref_start", "border"]
        kind = pa.list_(pa.struct(list(zip(names, [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]))))
        for batch in sliced(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            words = words_of(data, offsets, seeds=())
            raw = data.tobytes()
            lists = batch.column("found")
            n_words, removed, spans, kept = [], [], [], []
            for i in range(batch.num_rows):
                low, high = int(words.row_starts[i]), int(words.row_ends[i])
                n = high - low
                n_words.append(n)
                if not lists[i].is_valid:
                    gone, own = np.zeros(n, bool), []
                else:
                    match = lists[i].values
                    columns = [match.field(f).to_numpy() for f in ("start", "words", "ref_doc", "ref_start")]
                    own = parse(*columns, window)
                    start, stop = np.array([(a, a + m) for a, m, *_ in own]).T
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, np.minimum(start, n), 1)
                    np.add.at(change, np.minimum(stop, n), -1)
                    gone = np.cumsum(change[:n]) > 0
                left = np.flatnonzero(~gone) + low
                removed.append(n - len(left))
                spans.append([dict(zip(names, x)) for x in own])
                kept.append(b" ".join([raw[a:b] for a, b in zip(words.starts[left].tolist(), words.ends[left].tolist())]))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, kind),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "factors", "kept"],
            )

    unnamed = read.filter("doc_id IS NULL").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    return found.mapInArrow(run, schema).union(unnamed.mapInArrow(run, schema))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM words WHERE len(w) >= 20),
windows AS (SELECT doc_id, s, md5(array_to_string(w[s : s + 19], ' ')) AS h FROM starts),
firsts AS (SELECT h, min((doc_id, s)) AS f FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT w.doc_id, unnest(range(w.s, w.s + 20)) AS p
  FROM windows w JOIN firsts f ON w.h = f.h WHERE (w.doc_id, w.s) <> f.f),
positions AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
judged AS (
  SELECT p.doc_id, p.p, p.word, g.p IS NOT NULL AS lost
  FROM positions p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.p = g.p),
counted AS (
  SELECT doc_id, count(*) AS n_words, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT lost), '') AS kept
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(c.n_removed, 0) AS n_removed,
       sha256(coalesce(c.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id
"""
