import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitscope.llm import hard_negatives as hn

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, size STRING, tile STRING, score INT"


def _brute(rows):
    """By the contract's rule; of rows that repeat an id the smallest (label, vector) counts."""
    kept = {}
    for i, v, label, *_ in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            row = (label, [float(np.float32(x)) for x in v])
            kept[i] = min(row, kept.get(i, row))
    kept = {i: ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    found = []
    for a in kept:
        if a % 100:
            continue
        label, v = kept[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own == label) for i, (own, w) in kept.items() if i != a and len(v) == len(w))
        for ps, p in [(-s, i) for s, i, same in scored if same][:5]:
            fits = [(-s, i) for s, i, same in scored if not same and 80 * ps <= -100 * s <= 100 * ps][:5]
            found += [(a, p, rank, n, ps, ns) for rank, (ns, n) in enumerate(fits, 1)]
    return sorted(found)


def _found(frame):
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.collect())


def _rows(n, size, rng, coarse=False):
    value = (lambda: rng.randrange(-2, 3) / 4) if coarse else (lambda: rng.gauss(0.1, 0.3))
    return [(i, [value() for _ in range(size)], rng.randrange(4), "own", None, 1) for i in range(n)]


@pytest.mark.parametrize("tile", [8192, 60])
@pytest.mark.parametrize("coarse", [False, True])
def test_equals_brute_force(spark, tile, coarse):
    """Coarse components give many ties at the ends of the lists and windows."""
    rows = _rows(500, 6, random.Random(1), coarse)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    expected = _brute(rows)
    assert expected
    assert _found(hn.hard_negatives(table, F.col("vec_id") % 100 == 0, tile=tile)) == expected


def test_rows_that_take_no_part_lengths_and_repeated_rows(spark):
    rng = random.Random(2)
    rows = _rows(220, 5, rng) + [(1000 + i, v, *rest) for i, v, *rest in _rows(150, 3, rng)]
    rows += [(300, None, 1), (301, [1.0, None, 0.0, 0.0, 0.0], 1), (302, [float("nan")] * 5, 1), (303, [float("inf")] * 5, 1)]
    rows += [(304, [9.0] * 5, None), (None, [9.0] * 5, 1), (400, [], 1), (401, [], 1), (402, [], 2), (500, [0.0] * 5, 1)]
    rows += [(100, [0.5] * 5, 0), (3, [9.0] * 5, 99)] + [rows[7]] * 3 + [(600, [1.0], 2)]
    rows += [(700 + i, [0.25, 0.5, 0.0, 0.0, 0.25], i % 3) for i in range(90)]
    rows = [(*r, "own", None, 1)[:6] for r in rows]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert _found(hn.hard_negatives(table, F.col("vec_id") % 100 == 0, tile=50)) == _brute(rows)


def test_empty_tables_and_large_components(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []
    lone = spark.createDataFrame([(5, [1.0], 1, None, None, None)], SCHEMA)
    assert hn.hard_negatives(lone, F.col("vec_id") % 100 == 0).collect() == []
    large = spark.createDataFrame([(0, [1e30], 1, None, None, None)], SCHEMA)
    with pytest.raises(OverflowError, match="beyond exact whole numbers"):
        hn.hard_negatives(large, F.col("vec_id") % 100 == 0)


def test_boxes_that_cannot_matter_are_not_opened():
    """Clustered vectors: a search opens a small part of the leaves, and finds what a scan finds."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 300
    points = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 16)) * 8)
    ids, labels = np.arange(4000), np.zeros(4000, np.int64)
    tree = hn.RTree(points, ids, labels)
    for anchor in range(0, 4000, 50):
        scores = points @ points[anchor]
        for low, high in ((-np.inf, np.inf), (np.ceil(0.8 * scores.max()), 0.9 * scores.max())):
            ((got, at),) = tree.search(points[anchor], lambda labels, ids: ids != anchor, np.array([[low, high]]), 5)
            fits = np.flatnonzero((scores >= low) & (scores <= high) & (ids != anchor))
            best = fits[np.lexsort((fits, -scores[fits]))][:5]
            assert at.tolist() == best.tolist() and got.tolist() == scores[best].tolist()
    assert tree.opened / 160 < 0.25 * len(tree.levels[0][0])
