"""The greedy parse against one that searches the reference, and texts beyond the block size."""

import numpy as np
import pytest

from hitscope.llm import rolling, substring_dedup, suffix_dedup

WINDOW = 20


def copies(seed: int, docs: int) -> dict[int, list[str]]:
    """Texts made of pieces of earlier ones, of any length from any place, and words of their own."""
    rng = np.random.default_rng(seed)
    texts: dict[int, list[str]] = {}
    for i in range(docs):
        words: list[str] = []
        for _ in range(int(rng.integers(1, 7))):
            source = texts.get(int(rng.integers(0, i + 1)), words)
            if rng.random() < 0.7 and source:
                low = int(rng.integers(0, len(source)))
                words += source[low : low + int(rng.integers(5, 90))]
            else:
                words += [f"v{rng.integers(0, 30 if rng.random() < 0.1 else 100_000)}" for _ in range(int(rng.integers(1, 60)))]
        texts[i] = words
    return texts


def first_places(texts):
    first: dict[tuple, tuple[int, int]] = {}
    for i in sorted(texts):
        for s in range(len(texts[i]) - WINDOW + 1):
            first.setdefault(tuple(texts[i][s : s + WINDOW]), (i, s))
    return first


def stretches(first):
    """The reference: (document, first word, words) of the text of neighbouring first places."""
    out: list[list[int]] = []
    for i, s in sorted(first.values()):
        if out and out[-1][0] == i and out[-1][1] + out[-1][2] - WINDOW + 1 == s:
            out[-1][2] += 1
        else:
            out.append([i, s, WINDOW])
    return out


def brute_parse(i, words, reference, texts):
    """At each place the longest match that starts earlier, in every stretch; behind it, or a word on, the next."""
    out, here = [], 0
    while here < len(words):
        best = (0, 0, 0)
        for doc, low, n in reference:
            for s in range(low, low + n):
                if (doc, s) >= (i, here):
                    break
                m = 0
                while here + m < len(words) and s + m < low + n and texts[doc][s + m] == words[here + m]:
                    m += 1
                best = max(best, (m, -doc, -s))
        if best[0] >= WINDOW:
            out.append((here, best[0], -best[1], -best[2]))
        here += best[0] if best[0] >= WINDOW else 1
    return out


def removed(i, words, first):
    gone = np.zeros(len(words), bool)
    for s in range(len(words) - WINDOW + 1):
        if first[tuple(words[s : s + WINDOW])] != (i, s):
            gone[s : s + WINDOW] = True
    return gone


@pytest.mark.parametrize("seed", [1, 2])
def test_factors_are_those_of_a_search_for_the_longest_match(spark, seed):
    texts = copies(seed, 14)
    first = first_places(texts)
    reference = stretches(first)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # one task, so one place for each run
    try:
        rows = substring_dedup.substring_dedup(docs.coalesce(1)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    borders = 0
    for r in rows:
        i, words = r["doc_id"], texts[r["doc_id"]]
        own = [(f["start"], f["words"], f["ref_doc"], f["ref_start"]) for f in r["factors"] if not f["border"]]
        assert own == brute_parse(i, words, reference, texts)
        ends = [a + n for a, n, *_ in own]
        for f in r["factors"]:
            assert words[f["start"] :][: f["words"]] == texts[f["ref_doc"]][f["ref_start"] :][: f["words"]]
            if f["border"]:
                borders += 1
                assert any(f["start"] < e < f["start"] + f["words"] for e in ends)
        gone = removed(i, words, first)
        assert r["kept"] == " ".join(w for w, g in zip(words, gone) if not g)
    assert borders


def test_spans_do_not_depend_on_tasks(spark):
    texts = copies(3, 60)
    first = first_places(texts)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    for r in substring_dedup.substring_dedup(docs.repartition(7)).collect():
        words = texts[r["doc_id"]]
        gone = removed(r["doc_id"], words, first)
        assert (r["n_removed"], r["kept"]) == (int(gone.sum()), " ".join(w for w, g in zip(words, gone) if not g))


def test_parse_of_several_sources():
    """At a place where two matches are open the longer one is taken; what crosses its end is a span."""
    found = [(0, 25, 1, 100), (3, 30, 2, 7), (6, 21, 3, 0), (40, 20, 1, 0)]
    got = substring_dedup.parse(*(np.array(x) for x in zip(*found)), WINDOW)
    assert got == [(0, 25, 1, 100, False), (3, 30, 2, 7, True), (6, 21, 3, 0, True), (40, 20, 1, 0, False)]
    longer = [(0, 25, 1, 100), (0, 60, 2, 7), (30, 35, 3, 0)]
    assert substring_dedup.parse(*(np.array(x) for x in zip(*longer)), WINDOW) == [(0, 60, 2, 7, False), (30, 35, 3, 0, True)]
    assert substring_dedup.parse(*[np.zeros(0, np.int64)] * 4, WINDOW) == []


def long_texts() -> dict[int, str]:
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 170_000)]
    assert len(" ".join(base)) > rolling.BLOCK
    shared = base[140_000:140_700]  # words around the end of the first block of bytes
    wide = "x" * (rolling.BLOCK + 50)
    return {1: " ".join(base), 2: " ".join([*shared, "own", *base[-100:]]), 3: " ".join(["a", wide, *base[:60]]), 4: f"b {wide}"}


def test_substring_dedup_of_long_texts(spark):
    texts = {i: t.split() for i, t in long_texts().items()}
    first = first_places(texts)
    docs = spark.createDataFrame(list(long_texts().items()), "doc_id long, text string")
    for r in substring_dedup.substring_dedup(docs).collect():
        words = texts[r["doc_id"]]
        gone = removed(r["doc_id"], words, first)
        assert (r["n_words"], r["n_removed"]) == (len(words), int(gone.sum()))
        assert r["kept"] == " ".join(w for w, g in zip(words, gone) if not g)


def test_suffix_dedup_of_long_texts(spark):
    texts = {i: t.encode() for i, t in long_texts().items() if i < 3}
    count: dict[int, int] = {}
    for t in texts.values():
        for s in range(len(t) - 399):
            h = hash(t[s : s + 400])
            count[h] = count.get(h, 0) + 1
    docs = spark.createDataFrame([(i, long_texts()[i]) for i in texts], "doc_id long, text string")
    for r in suffix_dedup.suffix_dedup(docs).collect():
        t = texts[r["doc_id"]]
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 399):
            if count[hash(t[s : s + 400])] > 1:
                gone[s : s + 400] = True
        assert r["n_removed"] == int(gone.sum())
        assert bytes(r["kept"]) == np.frombuffer(t, np.uint8)[~gone].tobytes()
