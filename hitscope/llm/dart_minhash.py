"""Near-duplicates by DartMinHash signatures, banded joins and exact verification.

Darts are thrown at the plane of (weight, rank): every element owns a strip, and
where its darts lie depends on the element alone. An element of weight w keeps the
darts below w; each dart carries a rank and one of the k coordinates, and a
coordinate keeps the dart with the least rank. Two weighted sets agree in a
coordinate with the probability of their weighted Jaccard similarity. Only the darts up to
a rank that leaves about k log k of them are thrown, so a signature costs
the number of elements plus k log k, not their product.

Equal sets are one class from the start. In every band bucket the members are
linked to the smallest one; pairs of a bucket that are still in different classes
after that are compared themselves, unless their parity bitmaps prove that they are
not similar. All links are verified on whole sets.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitscope.llm import rolling
from hitscope.llm.common import concatenated_ranges, id_and_text, save, sliced, utf8, with_ids
from hitscope.llm.word_windows import runs_of_words, words_of

#: Rows of a band and number of bands: a pair of similarity 0.8 shares no bucket with a probability of 5e-6.
ROWS, BANDS = 6, 40
#: 64-bit words of a parity bitmap. More of them rule out more pairs of long texts; none is ruled out wrongly.
PARITY_WORDS = 16
#: Edges of the rank axis that darts are thrown up to, step by step.
_FIRST_EDGE = 1 / 16


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct runs of *width* words of each row; a shorter text is one run."""
    words = words_of(data, offsets)
    at, value = runs_of_words(words, width)
    row = np.searchsorted(words.row_ends, at, "right")
    counts = words.row_ends - words.row_starts
    short = np.flatnonzero((counts > 0) & (counts < width))
    whole = np.zeros(len(short), np.uint64)
    for i, r in enumerate(short.tolist()):
        own = words.hashes[0][words.row_starts[r] : words.row_ends[r]]
        total = len(own)
        for h in own.tolist():
            total = (total * 0x9E3779B97F4A7C15 + h) & ((1 << 64) - 1)
        whole[i] = total
    row, value = np.concatenate([row, short]), np.concatenate([value, rolling.mix(whole)])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return row[first], value[first], np.diff(np.append(first, len(row)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Numbers of darts from uniform numbers."""
    out = np.zeros(len(u), np.int64)
    term = total = np.exp(-mean)
    k = 0
    rest = u >= total
    while rest.any() and k < 60:
        k += 1
        out[rest] += 1
        term *= mean / k
        total += term
        rest = u >= total
    return out


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, k: int) -> np.ndarray:
    """(rows, k) dart numbers; a row without weight has the largest number everywhere.

    *row* is sorted. The strip of an element is cut into cells of weight 1, and the
    rank axis at powers of two; the darts of a cell come from its own hash.
    """
    empty = np.uint64((1 << 64) - 1)
    best = np.full(rows * k, empty)
    totals = np.bincount(row, weight, rows)
    cells = np.ceil(weight).astype(np.int64)
    cell = concatenated_ranges(np.zeros(len(cells), np.int64), cells)
    owner = np.repeat(np.arange(len(row)), cells)
    salt = rolling.mix(element[owner] + rolling.mix(cell.astype(np.uint64) + np.uint64(77)))
    cell_row, room = row[owner], weight[owner] - cell
    wanted = k * (np.log(k) + 2.0) / np.maximum(totals, 1e-9)  # rank up to which darts are thrown at first
    low, high, band = 0.0, _FIRST_EDGE, 0
    active = totals > 0
    while active.any():
        here = np.flatnonzero(active[cell_row])
        own = salt[here]
        mean = high - low
        seed = rolling.mix(own + np.uint64(0x51ED270B * (band + 1)))
        count = _poisson(_uniform(seed), mean)
        for dart in range(int(count.max(initial=0))):
            some = count > dart
            h = rolling.mix(seed[some] + np.uint64(0x2545F491 * (dart + 1)))
            inside = _uniform(h) < room[here[some]]
            h = rolling.mix(h[inside] + np.uint64(1))
            rank = (low + mean * _uniform(h)).astype(np.float32).view(np.uint32).astype(np.uint64)
            g = rolling.mix(h + np.uint64(2))
            place = cell_row[here[some][inside]] * k + (g >> np.uint64(33)).astype(np.int64) % k
            np.minimum.at(best, place, (rank << np.uint64(32)) | (rolling.mix(g) >> np.uint64(32)))
        active &= (high < wanted) | (best.reshape(rows, k) == empty).any(axis=1)
        low, high, band = high, high * 2, band + 1
    return best.reshape(rows, k)


def parities(row: np.ndarray, element: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
    """(rows, PARITY_WORDS) bitmaps; each element flips the bit of its hash as often as it occurs.

    Two bitmaps differ in no more bits than there are elements, counted with repeats, in one set only.
    """
    bit = rolling.mix(element ^ np.uint64(0x6A09E667F3BCC909)) % np.uint64(64 * PARITY_WORDS)
    words = np.zeros(rows * PARITY_WORDS, np.uint64)
    flip = (count.astype(np.uint64) & np.uint64(1)) << (bit & np.uint64(63))
    np.bitwise_xor.at(words, row * PARITY_WORDS + (bit >> np.uint64(6)).astype(np.int64), flip)
    return words.reshape(rows, PARITY_WORDS)


def possibly_similar(a: str, b: str, threshold: float) -> Column:
    """False only for sets that cannot be similar; of each the columns ``size_`` and ``parity_`` with suffix *a* or *b*.

    With s elements in both sets together, repeats included, similarity t needs at least s t / (1 + t)
    common ones, so at most s (1 - t) / (1 + t) that are in one set only.
    """
    word = lambda side, i: F.get(f"parity_{side}", F.lit(i))
    differ = sum((F.bit_count(word(a, i).bitwiseXOR(word(b, i))) for i in range(PARITY_WORDS)), F.lit(0))
    # The small addend covers the rounding of the similarity that is measured afterwards.
    return differ <= (F.col(f"size_{a}") + F.col(f"size_{b}")) * ((1 - threshold) / (1 + threshold) + 1e-6)


def sketches(docs: DataFrame, width: int, weights: str) -> DataFrame:
    """``doc_id, set1, set2, size, parity, bands``, one row for each document.

    Two hashes of the whole set, its number of elements and parity bitmap, and a key for each band (none for an empty set).
    """

    def run(batches):
        for batch in sliced(batches, "text"):
            n = batch.num_rows
            row, value, count = shingle_sets(*utf8(batch.column("text")), width)
            count = count if weights == "counts" else np.ones_like(count)
            weight = count.astype(np.float64)
            size = np.bincount(row, weight, n).astype(np.int64)
            parity = parities(row, value, count, n)
            steps = np.arange(n + 1, dtype=np.int32) * PARITY_WORDS
            sums = []
            for seed in (5, 6):
                per = rolling.mix(value * np.uint64(2 * seed + 1) + weight.astype(np.uint64))
                total = np.zeros(n, np.uint64)
                np.add.at(total, row, per)
                sums.append(pa.array(total.view(np.int64)))
            best = signatures(row, value, weight, n, ROWS * BANDS).reshape(n, BANDS, ROWS)
            key = np.zeros((n, BANDS), np.uint64)
            for i in range(ROWS):
                key = rolling.mix(key * np.uint64(0x9E3779B97F4A7C15) + best[:, :, i])
            full = np.bincount(row, minlength=n) > 0
            ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(key[full].ravel().view(np.int64)))
            bitmap = pa.ListArray.from_arrays(pa.array(steps), pa.array(parity.ravel().view(np.int64)))
            columns = [batch.column("doc_id"), *sums, pa.array(size), bitmap, bands]
            yield pa.record_batch(columns, ["doc_id", "set1", "set2", "size", "parity", "bands"])

    return docs.mapInArrow(run, "doc_id long, set1 long, set2 long, size long, parity array<long>, bands array<long>")


def similar_pairs(docs: DataFrame, pairs: DataFrame, width: int, weights: str, threshold: float) -> DataFrame:
    """Those of the pairs ``a, b`` of documents whose sets are similar, measured on the whole texts; with ``similarity``."""

    def sets(batches):
        for batch in sliced(batches, "text"):
            row, value, count = shingle_sets(*utf8(batch.column("text")), width)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32))
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(value.view(np.int64)))]
            columns.append(pa.ListArray.from_arrays(ends, pa.array((count if weights == "counts" else count * 0 + 1).astype(np.int32))))
            yield pa.record_batch(columns, ["doc_id", "items", "counts"])

    def compare(batches):
        for batch in batches:
            found = []
            columns = [batch.column(c) for c in ("items_a", "counts_a", "items_b", "counts_b")]
            for i in range(batch.num_rows):
                x, n, y, m = (c[i].values.to_numpy() for c in columns)
                _, in_x, in_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                both = np.minimum(n[in_x], m[in_y]).sum()
                found.append(both / max(1, n.sum() + m.sum() - both))
            out = pa.record_batch([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"])
            yield out.filter(pa.array(np.array(found) >= threshold, pa.bool_()))

    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    chosen = with_ids(docs, ends).dropDuplicates(["doc_id"])
    whole = save(chosen.mapInArrow(sets, "doc_id long, items array<long>, counts array<int>"), "sets")
    side = lambda s: whole.select(F.col("doc_id").alias(s), F.col("items").alias(f"items_{s}"), F.col("counts").alias(f"counts_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "a long, b long, similarity double")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label``: the smallest node of its connected component for every node of *links*.

    Every round a node takes the least label of itself and its neighbours, then
    the label of its label; rounds are saved, and end when none has changed.
    """
    edges = save(links.select(F.col(a).alias("u"), F.col(b).alias("v")).union(links.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = save(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges.v == labels.node).groupBy("u").agg(F.min("label").alias("near"))
        stepped = labels.join(near, labels.node == near.u).select("node", F.least("label", "near").alias("next"), "label")
        heads = stepped.select(F.col("node").alias("head"), F.col("next").alias("beyond"))
        jumped = save(
            stepped.join(heads, F.col("next") == F.col("head")).select("node", F.least("next", "beyond").alias("new"), "label"),
            "labels",
        )
        labels = jumped.select("node", F.col("new").alias("label"))
        if jumped.filter("new != label").limit(1).count() == 0:
            return labels


def near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5, weights: str = "ones") -> DataFrame:
    """``doc_id, class_id``, one row for each row of *docs*.

    Documents are linked if the Jaccard similarity of their runs of *width* lower-case words (the
    whole text where it has fewer) is at least *threshold*; *weights* "ones" compares
    sets, "counts" weights runs by their number. A class is a connected
    component and named by its smallest ``doc_id``. Texts without words (NULL,
    empty) are equal to each other. Rows that repeat an id are one document; rows without an id
    have a class of their own, NULL.
    """
    named = id_and_text(docs).filter("doc_id IS NOT NULL").withColumn("text", F.lower("text"))
    every = save(sketches(named, width, weights), "sketches")
    firsts = every.groupBy("set1", "set2").agg(F.min("doc_id").alias("first"))
    members = save(every.select("doc_id", "set1", "set2").join(firsts, ["set1", "set2"]).select("doc_id", "first"), "members")
    distinct = every.join(members.filter("doc_id = first").select("doc_id"), "doc_id", "leftsemi").dropDuplicates(["doc_id"])
    banded = save(distinct.select("doc_id", F.posexplode("bands").alias("band", "key")), "bands")

    buckets = banded.groupBy("band", "key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).filter("a < last")
    shared = save(banded.join(buckets.drop("last"), ["band", "key"]), "buckets")
    star = save(shared.filter("a < doc_id").select("a", F.col("doc_id").alias("b")).distinct(), "pairs")
    links = save(similar_pairs(named, star, width, weights, threshold), "links")

    classes = components(links)
    classed = shared.join(classes, shared.doc_id == classes.node, "left").select(
        "band", "key", "doc_id", F.coalesce("label", "doc_id").alias("label")
    )
    classed = save(classed, "classed")
    mixed = classed.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    rest = classed.join(mixed.select("band", "key"), ["band", "key"])
    rest = save(rest.join(every.select("doc_id", "size", "parity").dropDuplicates(["doc_id"]), "doc_id"), "mixed")
    side = lambda s: rest.select("band", "key", F.col("doc_id").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("label", "size", "parity")))
    differ = (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))
    meet = side("a").join(side("b"), ["band", "key"]).filter(differ & possibly_similar("a", "b", threshold))
    across = save(meet.select("a", "b").distinct().join(star, ["a", "b"], "leftanti"), "pairs")
    more = save(similar_pairs(named, across, width, weights, threshold), "links")
    final = components(links.union(more))
    found = members.join(final, F.col("first") == final.node, "left").select("doc_id", F.coalesce("label", "first").alias("class_id"))
    unnamed = docs.filter("doc_id IS NULL").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"))
    return found.union(unnamed)


def keep_one(docs: DataFrame) -> DataFrame:
    """*docs* without the near-duplicates of a document with a smaller id; of a repeated id any one row stays."""
    kept = near_duplicates(docs).filter("doc_id = class_id").select("doc_id").distinct().alias("kept")
    named = docs.filter("doc_id IS NOT NULL").alias("documents")
    one = named.join(kept, F.col("documents.doc_id") == F.col("kept.doc_id"), "leftsemi").dropDuplicates(["doc_id"])
    return one.union(docs.filter("doc_id IS NULL"))
