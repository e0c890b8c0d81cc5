"""Maximal repeats of a corpus, each with all of its places.

A maximal repeat is a byte string of *length* or more that starts at two places or more, such
that neither all of its places have the same byte on the left nor all the same one on the right
(the ends of a text count as different from everything). Its first *length* bytes, a
window, are a class of places. Two steps find the repeats:

1. The segments of one minimiser meet in one task (``suffix_dedup``), where the suffix array of
   their bytes holds every window as a run; runs whose left bytes all agree start no maximal
   repeat and go no further. Windows of hot minimisers meet by their hash, as counts.
2. Each place of the classes left is continued to the end of the repeated stretch that it lies
   in; no repeat goes beyond it. Equal continuations with the same byte on the left are one row. The
   rows of a class, sorted, are a suffix array with common prefixes, and a scan with a
   stack visits its intervals: those of more than one left byte are the maximal repeats.

A class whose rows hold more than *limit* bytes is not gathered. Its least and greatest
row give the common prefix of all, aggregates give the left bytes, and the byte behind the prefix
deals its rows out to smaller classes, until all fit.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hitscope.llm import rolling
from hitscope.llm.common import id_and_text, save, sliced, utf8
from hitscope.llm.suffix_dedup import (
    _ARRAY,
    _segments,
    maximal_repeats,
    merged,
    repeated_seeds,
    repeated_spans,
    windows_array,
)

#: Bytes of the rows of one class that a task gathers.
LIMIT = 1 << 25
#: The left "byte" of a place at the start of a text, which equals no other.
START = -1

_PLACE = "class binary, doc_id long, start long, before int"


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _segment_places(docs: DataFrame, marked: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Segments of repeated minimisers, ``key, doc_id, start, before, bytes``, and the windows of hot ones by their hash."""

    def cut(batches):
        for batch in sliced(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            row, start, windows, position, value = _segments(data, offsets, length)
            ids = batch.column("doc_id").to_numpy()
            known = [{m["position"]: m["hot"] for m in marks.as_py()} for marks in batch.column("seeds")]
            out = []
            for r, a, n, p, key in zip(row.tolist(), start.tolist(), windows.tolist(), position.tolist(), value.view(np.int64).tolist()):
                if (hot := known[r].get(p)) is None:
                    continue
                low = int(offsets[r]) + a
                out.append((key, hot, int(ids[r]), a, raw[low - 1] if a else START, raw[low : low + n + length - 1]))
            if out:
                names = ["key", "hot", "doc_id", "start", "before", "bytes"]
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    rows = docs.join(marked, "doc_id").mapInArrow(cut, "key long, hot boolean, doc_id long, start long, before int, bytes binary")
    rows = save(rows, "segments")

    def windows(batches):
        for batch in batches:
            for doc, start, before, segment in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "before", "bytes"))):
                data = np.frombuffer(segment, np.uint8)
                both = [rolling.window_hashes(rolling.prefix_sums(rolling.byte_codes(s)[data], s), length, s) for s in (2, 3)]
                names = np.stack(both, axis=1).tobytes()
                n = len(both[0])
                yield pa.record_batch(
                    [
                        pa.array([names[16 * i : 16 * i + 16] for i in range(n)], pa.binary()),
                        pa.array(np.full(n, doc)),
                        pa.array(start + np.arange(n)),
                        pa.array(np.concatenate([[before], data[: n - 1]]).astype(np.int32)),
                    ],
                    ["class", "doc_id", "start", "before"],
                )

    return rows.filter("NOT hot").drop("hot"), rows.filter("hot").mapInArrow(windows, _PLACE)


def _diverse_runs(groups: list[tuple], length: int) -> list[tuple]:
    """Rows of _PLACE for the windows of some segments (document, start, left byte, bytes) that occur behind different bytes."""
    array = windows_array([g[3] for g in groups], length)
    first = [g[2] + 1 if g[2] != START else -1 - i for i, g in enumerate(groups)]
    left = np.concatenate([[0], array.data[:-1]])
    left[array.starts] = first
    symbols = left[array.order]
    inside = array.shared >= length
    begin = np.flatnonzero(~inside)
    out = []
    for low, high in zip(begin.tolist(), [*begin[1:].tolist(), len(inside)]):
        if high - low < 2 or (symbols[low:high] == symbols[low]).all():
            continue
        at = array.order[low:high]
        name = _digest(array.data[at[0] : at[0] + length].astype(np.uint8) - np.uint8(1))
        for p, segment, symbol in zip(at.tolist(), array.owner[at].tolist(), symbols[low:high].tolist()):
            doc, start = groups[segment][:2]
            out.append((name, doc, start + p - int(array.starts[segment]), symbol - 1 if symbol > 0 else START))
    return out


def _starts(docs: DataFrame, marked: DataFrame, length: int) -> DataFrame:
    """Places of all windows that occur behind different bytes."""
    segments, windows = _segment_places(docs, marked, length)

    def judge(batches):
        waiting, key, size = {}, None, 0  # by place: rows that repeat an id are one document
        names = ["class", "doc_id", "start", "before"]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32()]

        def finish():
            rows = _diverse_runs([(*place, *row) for (_, *place), row in waiting.items()], length) if waiting else []
            waiting.clear()
            for low in range(0, len(rows), 1 << 16):
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[low : low + (1 << 16)]), kinds)], names)

        for batch in batches:
            for k, doc, start, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "start", "before", "bytes"))):
                if k != key and size > _ARRAY:
                    yield from finish()
                    size = 0
                key = k
                if (k, doc, start) not in waiting:
                    waiting[k, doc, start] = row
                    size += len(row[1])
        yield from finish()

    met = segments.repartition("key").sortWithinPartitions("key").mapInArrow(judge, _PLACE)
    hot = save(windows.distinct(), "windows")
    classes = hot.groupBy("class").agg(
        F.min("before").alias("least"), F.max("before").alias("most"), F.sum((F.col("before") == START).cast("long")).alias("starts")
    )
    diverse = classes.filter("least <> most OR starts > 1").select("class")
    return met.union(hot.join(diverse, "class", "leftsemi"))


def _continued(docs: DataFrame, spans: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """*places* with ``stop`` (the end of the repeated stretch) and ``rest``, the digest of the bytes up to there."""
    lists = places.groupBy("doc_id").agg(F.collect_list(F.struct("class", "start", "before")).alias("places"))

    def run(batches):
        for batch in sliced(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            out = []
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = merged([(s["start"], s["stop"]) for s in batch.column("spans")[i].as_py()])
                lows, highs = (np.array(x) for x in zip(*own))
                for p in batch.column("places")[i].as_py():
                    stop = int(highs[np.searchsorted(lows, p["start"], "right") - 1])
                    low = int(offsets[i])
                    out.append((p["class"], doc, p["start"], p["before"], stop, _digest(raw[low + p["start"] : low + stop])))
            if out:
                names = ["class", "doc_id", "start", "before", "stop", "rest"]
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    found = docs.join(spans, "doc_id").join(lists, "doc_id")
    # Rows that repeat an id give the same places.
    return save(found.mapInArrow(run, f"{_PLACE}, stop long, rest binary").distinct(), "places")


def _witnesses(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``class, node, before, rest, n, bytes``: the different continuations of each class, with their bytes."""
    one = places.groupBy("class", "before", "rest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "start", "stop")).alias("at"))
    lists = one.groupBy(F.col("at.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("class", "before", "rest", "n", "at.start", "at.stop")).alias("wanted")
    )
    # Positions count bytes, so the text is cut as binary.
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(lists, "doc_id")
    rows = texts.select("text", F.explode("wanted").alias("w")).select(
        "w.class", F.col("w.class").alias("node"), "w.before", "w.rest", "w.n",
        F.substring("text", (F.col("w.start") + 1).cast("int"), (F.col("w.stop") - F.col("w.start")).cast("int")).alias("bytes"),
    )
    return save(rows.dropDuplicates(["class", "before", "rest"]), "continuations")


_FOUND = "class binary, length long, group_id string, before int, rest binary"


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0]) if len(differ) else n


def class_repeats(rows: list[tuple], length: int) -> list[tuple[int, list[int]]]:
    """``(size, rows)`` of the maximal repeats at the places of one class, for its rows (left byte, number of places, bytes)."""
    # A row of several places at starts of texts stands for different left bytes.
    entries = sorted((text, i) for i, (before, n, text) in enumerate(rows) for _ in range(min(n, 2) if before == START else 1))
    shared = np.array([0, *(common_prefix(a[0], b[0]) for a, b in zip(entries, entries[1:]))])
    left = np.array([rows[i][0] if rows[i][0] != START else -1 - e for e, (_, i) in enumerate(entries)])
    return [(size, sorted({entries[p][1] for p in at.tolist()})) for size, at in maximal_repeats(np.arange(len(entries)), shared, left, length)]


def _small(classes: DataFrame, length: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("before", "n", "bytes", "class", "rest"))))
        out = []
        for size, members in class_repeats([r[:3] for r in rows], length):
            name = _digest(rows[members[0]][2][:size]).hex()
            out += [(rows[i][3], size, name, rows[i][0], rows[i][4]) for i in members]
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["class", "length", "group_id", "before", "rest"])

    return classes.groupBy("node").applyInArrow(run, _FOUND)


def _large(work: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The outermost interval of each large class, and the rows below it, dealt out by the byte behind it."""
    ends = work.join(large, "node", "leftsemi").groupBy("node").agg(
        F.min("bytes").alias("least"), F.max("bytes").alias("most"), F.min("before").alias("left"), F.max("before").alias("right"),
        F.sum(F.when(F.col("before") == START, F.col("n")).otherwise(0)).alias("starts"),
    )

    def run(batches):
        for batch in batches:
            for node, least, most, diverse in zip(*(c.to_pylist() for c in batch.columns)):
                size = common_prefix(least, most)
                names = ["node", "length", "group_id", "diverse"]
                yield pa.record_batch([pa.array([node], pa.binary()), pa.array([size]), pa.array([_digest(least[:size]).hex()]), pa.array([diverse])], names)

    diverse = F.expr("left <> right OR starts > 1").alias("diverse")
    outer = save(ends.select("node", "least", "most", diverse).mapInArrow(run, "node binary, length long, group_id string, diverse boolean"), "intervals")
    rows = work.join(outer, "node")
    found = rows.filter("diverse").select("class", "length", "group_id", "before", "rest")
    following = F.expr("substring(bytes, CAST(length + 1 AS INT), 1)")
    below = rows.filter(F.length("bytes") > F.col("length")).withColumn("node", F.unhex(F.md5(F.concat("node", following))))
    return found, below.select(*work.columns)


def repeat_groups(docs: DataFrame, length: int = 400, hot: int = 2048, limit: int = LIMIT) -> DataFrame:
    """``group_id, length, doc_id, start``: every place of every maximal repeat of *length* bytes or more.

    Whole texts count as UTF-8 bytes, starts from 0; repeats do not cross documents. ``group_id`` is a digest of
    the repeated bytes. Rows without id take no part, a NULL text is empty; rows that repeat an id
    with the same text are one document, with another text they are an error of the caller (places
    of one may be read from the other). Places that overlap are places of their own, so a run of one byte
    has about half the square of its length of them. *hot* and *limit* decide only how rows are dealt out.
    """
    named = id_and_text(docs).filter("doc_id IS NOT NULL")
    marked = save(repeated_seeds(named, length, hot), "marks")
    spans = save(repeated_spans(named, marked, length), "spans")
    places = _continued(named, spans, _starts(named, marked, length), length)
    work = _witnesses(named, places)
    found = []
    while True:
        sizes = work.groupBy("node").agg(F.sum(F.length("bytes")).alias("size"))
        large = save(sizes.filter(F.col("size") > limit).select("node"), "large")
        if large.isEmpty():
            break
        small = work.join(large, "node", "leftanti")
        found.append(_small(small, length))
        outer, below = _large(work, large)
        found.append(outer)
        work = save(below, "continuations")
    groups = _small(work, length)
    for more in found:
        groups = groups.union(more)
    members = save(groups, "groups")
    return members.join(places, ["class", "before", "rest"]).select("group_id", "length", "doc_id", "start")
