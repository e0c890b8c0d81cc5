"""Maximal repeats with all of their places, against the plain rule."""

import random

import numpy as np
import pytest

from hitscope.llm import repeat_groups, suffix_dedup

LENGTH = 100


def texts() -> dict[int, str]:
    rng = random.Random(5)

    def noise(n):
        return "".join(rng.choices("abcdefgh ", k=n))

    passages = [noise(320) for _ in range(4)]
    out = {}
    for i in range(40):
        parts = []
        for _ in range(rng.randint(1, 3)):
            low = rng.choice([0, 0, 0, 37])
            parts += [noise(rng.choice([0, 1, 50])), rng.choice(passages)[low : low + rng.choice([99, 100, 180, 320])]]
        out[i] = "".join(parts)
    out[40], out[41] = out[3], out[3]  # whole copies
    out[42], out[43] = "", "x" * 104  # nothing, and overlapping places in one text
    out[44] = "é" * 30 + passages[0] + "漢" * 40
    out[45] = "ü" + passages[0] + "漢" * 40
    return out


def plain(named: dict[int, bytes], length: int) -> set[tuple[bytes, frozenset]]:
    """Repeated bytes and their places: windows at least twice, continued together, and split where they differ."""
    windows: dict[bytes, list] = {}
    for doc, text in named.items():
        for s in range(len(text) - length + 1):
            windows.setdefault(text[s : s + length], []).append((doc, s))
    out = set()
    todo = [(length, places) for places in windows.values() if len(places) > 1]
    while todo:
        size, places = todo.pop()
        following: dict[object, list] = {}
        for doc, s in places:
            text = named[doc]
            following.setdefault(text[s + size] if s + size < len(text) else ("end", doc, s), []).append((doc, s))
        if len(following) > 1:
            before = {named[doc][s - 1] if s else ("start", doc) for doc, s in places}
            if len(before) > 1:
                doc, s = places[0]
                out.add((named[doc][s : s + size], frozenset(places)))
        grown = size + 1
        todo += [(grown, below) for key, below in following.items() if len(below) > 1]
    return out


def groups_of(rows, named: dict[int, bytes]) -> set[tuple[bytes, frozenset]]:
    places: dict[tuple[str, int], list] = {}
    for r in rows:
        places.setdefault((r["group_id"], r["length"]), []).append((r["doc_id"], r["start"]))
    assert all(len(set(p)) == len(p) for p in places.values())
    return {(named[p[0][0]][p[0][1] : p[0][1] + size], frozenset(p)) for (_, size), p in places.items()}


@pytest.fixture(scope="module")
def expected():
    named = {i: t.encode() for i, t in texts().items()}
    return named, plain(named, LENGTH)


@pytest.mark.parametrize("hot, limit", [(2048, repeat_groups.LIMIT), (1, repeat_groups.LIMIT), (2048, 2000)])
def test_groups_equal_the_plain_rule(spark, expected, hot, limit):
    named, groups = expected
    rows = [(i, t, "x") for i, t in texts().items()] + [(None, texts()[3], "y"), (4, texts()[4], "z"), (99, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string").repartition(5)
    found = repeat_groups.repeat_groups(docs, LENGTH, hot, limit).collect()
    assert len(groups) > 20 and max(len(t) for t, _ in groups) > 320
    assert groups_of(found, named) == groups


def test_groups_cover_what_is_removed(spark, expected):
    named, groups = expected
    docs = spark.createDataFrame(list(texts().items()), "doc_id long, text string")
    gone = {i: np.zeros(len(t), bool) for i, t in named.items()}
    for text, places in groups:
        for doc, start in places:
            gone[doc][start : start + len(text)] = True
    removed = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.suffix_dedup(docs, LENGTH).collect()}
    assert removed == {i: int(g.sum()) for i, g in gone.items()}


def test_nothing_repeats(spark):
    docs = spark.createDataFrame([(1, "a" * 50), (2, None)], "doc_id long, text string")
    assert repeat_groups.repeat_groups(docs, LENGTH).count() == 0
    assert repeat_groups.repeat_groups(docs.limit(0), LENGTH).count() == 0


def test_rows_of_one_class():
    rows = [(97, 1, b"aab"), (98, 1, b"aab"), (97, 1, b"aac"), (repeat_groups.START, 2, b"aad")]
    found = repeat_groups.class_repeats(rows, 2)
    assert sorted(found) == [(2, [0, 1, 2, 3]), (3, [0, 1]), (3, [3])]
