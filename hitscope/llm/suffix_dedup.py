"""Removal of long repeated byte strings by the interval tree of an enhanced suffix array.

A string of *length* bytes that starts twice holds the same minimiser (least hash
of its byte 64-grams) twice. So the windows of every document are dealt out by
their minimiser: a segment is the bytes of the consecutive windows of one
document that share one. Only segments with a minimiser that the corpus holds
twice or more are moved. Segments of one minimiser meet in one task, equal ones
as one with a count. There a suffix array with common-prefix lengths is built
over many such groups at once, and a scan with a stack visits its intervals of
*length* or more: those whose occurrences differ in the byte on the left are the
maximal repeats, and each gives all of its occurrences.

A minimiser with more than *hot* occurrences (a passage of very many documents
next to ever different neighbours) would gather them in one task. Its windows
are instead dealt out one by one, by a 128-bit hash, of which every task sends
each once.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hitscope.llm import rolling
from hitscope.llm.common import concatenated_ranges, id_and_text, perhaps_among, save, sliced, utf8

#: Bytes of a seed, segments bytes of a suffix array, bytes a task gathers before it aggregates.
SEED_BYTES, _ARRAY, _GATHER = 64, 1 << 19, 1 << 24
#: Minimisers a task gathers before it counts them.
_SEEDS = 1 << 20


def _segments(data: np.ndarray, offsets: np.ndarray, length: int):
    """Row, first window, number of windows (from the row's start), minimiser and its hash, per segment."""
    seed = min(SEED_BYTES, length)
    parts = []
    for batch in rolling.pieces(np.diff(offsets), length - 1):
        row = np.array([r for r, _, _ in batch])
        first = np.array([offsets[r] + a for r, a, _ in batch])
        last = np.array([offsets[r] + b for r, _, b in batch])
        low, high = int(first[0]), int(last[-1])
        if high - low < length:
            continue
        sums = rolling.prefix_sums(rolling.byte_codes(1)[data[low:high]], 1)
        grams = rolling.window_hashes(sums, seed, 1)
        least = rolling.window_minimisers(grams, length - seed + 1)
        wide = last - first >= length
        starts, counts = first[wide] - low, (last - first - length + 1)[wide]
        at = concatenated_ranges(starts, counts)
        owner = np.repeat(np.flatnonzero(wide), counts)
        begin, end = rolling.runs(least[at], np.concatenate([[False], owner[1:] != owner[:-1]]) if len(at) else None)
        if not len(begin):
            continue
        piece = owner[begin]
        base = offsets[row[piece]] - low
        parts.append((row[piece], at[begin] - base, end - begin, least[at[begin]] - base, grams[least[at[begin]]]))
    if not parts:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _seed_rows(parts: list[tuple]) -> pa.RecordBatch:
    """Minimisers (seed, document, position) of a task: those it has once, count 1; the others' places, count 0, and one row each with the count."""
    seed, doc, position = (np.concatenate(x) for x in zip(*parts))
    distinct, inverse, counts = np.unique(seed, return_inverse=True, return_counts=True)
    often = counts > 1
    none = np.zeros(np.count_nonzero(often), np.int64)
    bare = np.concatenate([np.zeros(len(seed), bool), none == 0])
    return pa.record_batch(
        [
            pa.array(np.concatenate([seed, distinct[often]])),
            pa.array(np.concatenate([doc, none]), mask=bare),
            pa.array(np.concatenate([position, none]), mask=bare),
            pa.array(np.concatenate([(~often)[inverse].astype(np.int64), counts[often]])),
        ],
        ["seed", "doc_id", "position", "n"],
    )


def repeated_seeds(docs: DataFrame, length: int, hot: int) -> DataFrame:
    """``doc_id, seeds``: position of every minimiser of a document that the corpus holds twice or more, and whether it is hot.

    Hot are those with more than *hot* occurrences, and a few others. A minimiser that a task holds
    more than once is known to repeat there, so by seed each task sends one row of it, not every place.
    """

    def run(batches):
        parts, size = [], 0
        for batch in sliced(batches, "text"):
            row, _, _, position, value = _segments(*utf8(batch.column("text")), length)
            # Segments of a long text that is read in pieces may share one minimiser.
            place = np.unique(np.stack([row, position]), axis=1, return_index=True)[1]
            parts.append((value.view(np.int64)[place], batch.column("doc_id").to_numpy()[row[place]], position[place]))
            size += len(place)
            if size > _SEEDS:
                yield _seed_rows(parts)
                parts, size = [], 0
        if size:
            yield _seed_rows(parts)

    every = save(docs.mapInArrow(run, "seed long, doc_id long, position long, n long"), "seeds")
    often = every.filter("n > 0").groupBy("seed").agg(F.sum("n").alias("total")).filter("total > 1")
    single = every.filter("n = 1").join(often.select("seed"), "seed", "leftsemi")
    places = single.union(every.filter("n = 0"))
    marked = perhaps_among(places, often.filter(F.col("total") > hot).select("seed"), "hot")
    return marked.groupBy("doc_id").agg(F.collect_list(F.struct("position", "hot")).alias("seeds"))


_ROWS = "key long, other long, doc_id long, start long, windows int, copies int, bytes binary"


def _segment_rows(batch, length: int, found: dict, spread: list) -> list[tuple]:
    """Adds a batch's segments to *found* and *spread*; rows of the segments that repeat earlier ones."""
    data, offsets = utf8(batch.column("text"))
    raw = data.tobytes()
    row, start, windows, position, value = _segments(data, offsets, length)
    ids = batch.column("doc_id").to_numpy()
    marks = batch.column("seeds")
    place = np.repeat(np.arange(batch.num_rows), marks.value_lengths().to_numpy())
    flags = marks.flatten()
    known = dict(zip(zip(place.tolist(), flags.field("position").to_numpy().tolist()), flags.field("hot").to_numpy(zero_copy_only=False).tolist()))
    rows = []
    for r, a, n, p, key in zip(row.tolist(), start.tolist(), windows.tolist(), position.tolist(), value.view(np.int64).tolist()):
        hot = known.get((r, p))
        if hot is None:
            continue
        doc, low = int(ids[r]), int(offsets[r]) + a
        if hot:
            spread.append((doc, a, raw[low : low + n + length - 1]))
            continue
        segment = raw[low : low + n + length - 1]
        earlier = found.get((key, segment))
        if earlier is None:
            found[key, segment] = [doc, a, n, 1]
        elif (doc, a) != (earlier[0], earlier[1]):
            earlier[3] += 1
            rows.append((doc * 0x9E3779B1 + a & 0x7FFFFFFFFFFFFFFF, 0, doc, a, n, 2, None))
    return rows


def _window_rows(spread: list, length: int) -> list[tuple]:
    """Single windows of hot segments by hash: each once, with the number of its places; the other places as known repeats."""
    parts = []
    for low in range(0, len(spread), 512):
        group = spread[low : low + 512]
        data = np.frombuffer(b"".join(s for _, _, s in group), np.uint8)
        ends = np.cumsum([len(s) for _, _, s in group])
        for cut in range(0, len(group)):
            begin, end = int(ends[cut]) - len(group[cut][2]), int(ends[cut])
            hashes = []
            for seed in (2, 3):
                sums = rolling.prefix_sums(rolling.byte_codes(seed)[data[begin:end]], seed)
                hashes.append(rolling.window_hashes(sums, length, seed))
            n = len(hashes[0])
            parts.append((*hashes, np.full(n, group[cut][0]), group[cut][1] + np.arange(n)))
    if not parts:
        return []
    h1, h2, doc, start = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((start, doc, h2, h1))
    h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    same_place = ~new
    same_place[1:] &= (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])
    h1, h2, doc, start, new = h1[~same_place], h2[~same_place], doc[~same_place], start[~same_place], new[~same_place]
    first = np.flatnonzero(new)
    copies = np.diff(np.append(first, len(new)))
    rows = [
        (a, b, d, s, 1, c, b"")
        for a, b, d, s, c in zip(*(x.tolist() for x in (h1[first].view(np.int64), h2[first].view(np.int64), doc[first], start[first], copies)))
    ]
    rest = np.flatnonzero(~new)
    rows += [(d * 0x9E3779B1 + s & 0x7FFFFFFFFFFFFFFF, 0, d, s, 1, 2, None) for d, s in zip(doc[rest].tolist(), start[rest].tolist())]
    return rows


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["key", "other", "doc_id", "start", "windows", "copies", "bytes"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def prefix_ranks(data: np.ndarray, length: int, pad: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols (0 to 511), up to the largest power of two within *length*.

    Prefix doubling; equal starts have equal ranks, and the last ranks are in order. A suffix that
    already differs from all others is not sorted again; where all do, the longer steps are left
    out. Behind the end there are *pad* (*length* or more) zeros.
    """
    n = len(data)
    symbols = np.concatenate([data, np.zeros(pad + 2, np.int64)])
    levels, step = [symbols[: n + pad]], 1
    if length < 2:
        return levels
    pairs = symbols[:-1] * 512 + symbols[1:]
    levels.append(pairs[: n + pad])
    if length < 4:
        return levels
    key = pairs[:n] * (1 << 18) + pairs[2 : n + 2]
    # Suffixes in a run of equal ones, and their places in the whole order; a rank is the place of the run's first, from 1.
    unsure, slots, step = np.arange(n), np.arange(n), 4
    rank = np.zeros(n + pad, np.int64)
    while True:
        by = np.argsort(key)
        unsure, key = unsure[by], key[by]
        begin, end = rolling.runs(key)
        rank[unsure] = np.repeat(slots[begin] + 1, end - begin)
        levels.append(rank)
        tied = np.repeat(end - begin > 1, end - begin)
        unsure, slots = unsure[tied], slots[tied]
        if 2 * step > length or not len(unsure):
            return levels
        key = rank[unsure] * (n + 1) + rank[unsure + step]
        rank, step = rank.copy(), 2 * step


def maximal_repeats(order: np.ndarray, shared: np.ndarray, left: np.ndarray, min_length: int) -> list[tuple[int, np.ndarray]]:
    """``(length, positions)`` of every repeat of *min_length* or more that its occurrences' left symbols end.

    *left* is the symbol before each position (a number of its own at a start).
    Runs of suffixes that share *min_length* are the subtrees of the interval tree
    looked at; one whose suffixes all have the same left symbol has none
    below that differs. In the others a stack holds the open intervals.
    """
    n = len(order)
    if n < 2:
        return []
    inside = shared >= min_length
    begin = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) - 1
    stop = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
    if not len(begin):
        return []
    symbols = left[order]
    changes = np.concatenate([[0], np.cumsum(symbols[1:] != symbols[:-1])])
    out = []
    diverse = changes[stop - 1] != changes[begin]
    for low, high in zip(begin[diverse].tolist(), stop[diverse].tolist()):
        depth, starts = [0], [low]
        for i in range(low + 1, high + 1):
            common = int(shared[i]) if i < high else 0
            start = i - 1
            while depth[-1] > common:
                size, start = depth.pop(), starts.pop()
                if changes[i - 1] != changes[start]:
                    out.append((size, order[start:i]))
            if depth[-1] < common:
                depth.append(common)
                starts.append(start)
    return out


class WindowsArray(NamedTuple):
    """Suffix array of segments of bytes + 1, each behind its own start and ended by 0: only suffixes whose first window occurs twice."""

    data: np.ndarray
    starts: np.ndarray
    owner: np.ndarray
    order: np.ndarray
    shared: np.ndarray


def windows_array(segments: list[bytes], length: int) -> WindowsArray:
    """Suffixes in order to the end of the longest segment, and the length each shares with the one before, within its segment."""
    sizes = np.array([len(s) for s in segments])
    starts = np.cumsum(sizes + 1) - sizes - 1
    data = np.zeros(int((sizes + 1).sum()), np.int64)
    data[concatenated_ranges(starts, sizes)] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + 1
    longest = int(sizes.max())
    levels = prefix_ranks(data, length, longest + length)
    top, step = levels[-1], 1 << (len(levels) - 1)
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    room = (starts + sizes)[owner] - np.arange(len(data))
    # Two stretches of ranks cover a window; where all suffixes already differ, no window has an equal.
    windows = np.flatnonzero(room >= length)
    name = top[windows] * (int(top.max()) + 1) + top[windows + max(0, length - step)]
    by = np.argsort(name)
    begin, end = rolling.runs(name[by])
    twice = windows[by[np.repeat(end - begin > 1, end - begin)]]
    # Equal windows may go on alike in some of several segments only, so the order goes on to the end of the longest.
    order = twice[np.lexsort([top[twice + at] for at in range(0, longest, step)][::-1])]
    a, b = order[:-1], order[1:]
    most = np.minimum(room[a], room[b])
    common = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        size = 1 << level
        for _ in range(longest // step if size == step else 1):
            # What reaches beyond a segment's end does not count as shared.
            common += size * ((common + size <= most) & (levels[level][a + common] == levels[level][b + common]))
    return WindowsArray(data, starts, owner, order, np.concatenate([np.zeros(min(1, len(order)), np.int64), common]))


def _group_repeats(groups: list[list[tuple]], length: int) -> list[list[tuple[int, int]]]:
    """For segments of some groups (bytes, windows, copies), the repeated stretches of each, as (from, to)."""
    segments = [s for group in groups for s in group]
    data, starts, owner, order, shared = windows_array([s[0] for s in segments], length)
    left = np.empty(len(data), np.int64)
    left[1:] = data[:-1]
    left[starts] = -1 - np.arange(len(starts))
    spans: list[list[tuple[int, int]]] = [[] for _ in segments]
    for size, positions in maximal_repeats(order, shared, left, length):
        own = owner[positions]
        for segment, at in zip(own.tolist(), (positions - starts[own]).tolist()):
            spans[segment].append((at, at + size))
    for segment, (_, windows, copies) in enumerate(segments):
        if copies > 1:
            spans[segment].append((0, windows + length - 1))
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(x) for x in out]


def _judge(batches, length: int):
    """Rows of the same key one after another: the spans of each document that repeat."""
    out: list[tuple[int, int, int]] = []
    waiting: list[tuple[list[tuple], list[list[tuple[int, int]]]]] = []
    size = 0

    def flush():
        nonlocal size
        groups = [group for group, _ in waiting]
        places = [p for _, places in waiting for p in places]
        for own, spans in zip(places, _group_repeats(groups, length) if groups else []):
            for low, high in merged(spans):
                out.extend((doc, start + low, start + high) for doc, start in own)
        waiting.clear()
        size = 0

    def close(rows):
        nonlocal size
        if not rows:
            return
        distinct: dict[bytes, list] = {}
        for doc, start, windows, copies, segment in rows:
            entry = distinct.setdefault(segment, [windows, 0, []])
            if (doc, start) not in entry[2]:
                entry[1] += copies
                entry[2].append((doc, start))
        if len(distinct) == 1:
            segment, (windows, copies, own) = next(iter(distinct.items()))
            if copies > 1:
                out.extend((doc, start, start + len(segment)) for doc, start in own)
            return
        waiting.append(([(s, w, c) for s, (w, c, _) in distinct.items()], [own for _, _, own in distinct.values()]))
        size += sum(map(len, distinct))
        if size > _ARRAY:
            flush()

    key, rows = None, []
    for batch in batches:
        for k, other, doc, start, windows, copies, segment in zip(*(c.to_pylist() for c in batch.columns)):
            if segment is None:
                out.append((doc, start, start + windows + length - 1))
                continue
            if (k, other) != key:
                close_hash_or_group(key, rows, out, close, length)
                key, rows = (k, other), []
            rows.append((doc, start, windows, copies, segment))
        if len(out) > 1 << 16:
            yield _spans(out)
            out.clear()
    close_hash_or_group(key, rows, out, close, length)
    flush()
    yield _spans(out)


def close_hash_or_group(key, rows, out, close, length: int) -> None:
    """Single windows of one hash (no bytes) all repeat if they are two or more; segments go to their array."""
    if rows and rows[0][4] == b"":
        if sum(r[3] for r in rows) > 1 and (len({r[:2] for r in rows}) > 1 or rows[0][3] > 1):
            out.extend((doc, start, start + length) for doc, start, *_ in rows)
    else:
        close(rows)


def _spans(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [[], [], []]
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "stop"])


def repeated_spans(docs: DataFrame, marked: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, spans``: stretches [start, stop) of bytes that repeated strings of *length* cover.

    *docs* has ``doc_id`` (not NULL) and ``text``, *marked* their ``repeated_seeds``.
    """
    def cut(batches):
        found: dict = {}
        spread: list = []
        size = 0
        for batch in sliced(batches, "text"):
            rows = _segment_rows(batch, length, found, spread)
            if rows:
                yield _record(rows)
            size += utf8(batch.column("text"))[1][-1]
            if size > _GATHER:
                yield from finish(found, spread)
                size = 0
        yield from finish(found, spread)

    def finish(found, spread):
        rows = [(key, 0, doc, a, n, copies, segment) for (key, segment), (doc, a, n, copies) in found.items()]
        found.clear()
        for low in range(0, len(rows), 4096):
            yield _record(rows[low : low + 4096])
        rows = _window_rows(spread, length)
        spread.clear()
        for low in range(0, len(rows), 1 << 16):
            yield _record(rows[low : low + (1 << 16)])

    segments = docs.join(marked, "doc_id").mapInArrow(cut, _ROWS)
    met = segments.repartition("key", "other").sortWithinPartitions("key", "other")
    spans = met.mapInArrow(lambda batches: _judge(batches, length), "doc_id long, start long, stop long")
    return spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def suffix_dedup(docs: DataFrame, length: int = 400, hot: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept``: whole texts (UTF-8) without repeated strings.

    Each byte goes that a string of *length* bytes covers which also starts
    anywhere else in the corpus as given, the same document included; matches do not
    cross documents. *hot* decides only how occurrences are dealt out. ``kept`` is binary, as a cut may fall inside a character. A NULL text is empty. ``doc_id`` names a
    document: rows that repeat an id with the same text are one document and do not make
    each other a repeat (with another text, a span of one is cut from all); rows
    without an id lose nothing and take nothing from others.
    """
    read = id_and_text(docs)
    named = read.filter("doc_id IS NOT NULL")
    found = named.join(repeated_spans(named, repeated_seeds(named, length, hot), length), "doc_id", "left")
    unnamed = read.filter("doc_id IS NULL").withColumn("spans", F.lit(None).cast(found.schema["spans"].dataType))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept binary"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in sliced(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            lists = batch.column("spans")
            sizes, removed, spans, kept = [], [], [], []
            for i in range(batch.num_rows):
                text = raw[int(offsets[i]) : int(offsets[i + 1])]
                own = []
                if lists[i].is_valid:
                    values = lists[i].values
                    own = merged(list(zip(values.field("start").to_pylist(), values.field("stop").to_pylist())))
                    own = [(a, min(b, len(text))) for a, b in own if a < len(text)]
                cuts = [0, *(x for span in own for x in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(cuts[0::2], cuts[1::2])))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                spans.append([{"start": a, "stop": b} for a, b in own])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(list(map(len, spans)), pa.int64()),
                    pa.array(spans, kind),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    return found.mapInArrow(run, schema).union(unnamed.mapInArrow(run, schema))


ORACLE_SQL = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
starts AS (
  SELECT doc_id, unnest(range(0, length(x) // 2 - 399)) AS s, x FROM texts WHERE length(x) >= 800),
windows AS (SELECT doc_id, s, md5(substr(x, 2 * s + 1, 800)) AS h FROM starts),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, s FROM windows SEMI JOIN twice ON windows.h = twice.h),
ordered AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM hit),
numbered AS (
  SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 400 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY s) AS run
  FROM ordered),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (
  SELECT s.doc_id, s.a, s.b, coalesce(lag(s.b) OVER (PARTITION BY s.doc_id ORDER BY s.a), 0) AS low
  FROM spans s),
kept AS (
  SELECT g.doc_id, string_agg(substr(t.x, 2 * g.low + 1, 2 * (g.a - g.low)), '' ORDER BY g.a) AS part,
         max(g.b) AS stop, count(*) AS n, sum(g.b - g.a) AS removed
  FROM gaps g JOIN texts t ON g.doc_id = t.doc_id GROUP BY g.doc_id)
SELECT t.doc_id, CAST(length(t.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN k.doc_id IS NULL THEN t.x ELSE coalesce(k.part, '') || substr(t.x, 2 * k.stop + 1) END))
         AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
