"""Repeats beyond a window's length among three and more segments, against every window of each."""

import random
from collections import Counter

import numpy as np
import pytest

from hitscope.llm import suffix_dedup

LENGTH = 400


def covered(texts: dict[int, bytes]) -> dict[int, np.ndarray]:
    count = Counter(t[s : s + LENGTH] for t in texts.values() for s in range(len(t) - LENGTH + 1))
    out = {}
    for i, t in texts.items():
        out[i] = np.zeros(len(t), bool)
        for s in range(len(t) - LENGTH + 1):
            if count[t[s : s + LENGTH]] > 1:
                out[i][s : s + LENGTH] = True
    return out


def parts_of_a_passage(seed: int) -> dict[int, bytes]:
    r = random.Random(seed)
    some = lambda n: bytes(r.choices(b"abcdefgh", k=n))
    passage = some(730)
    ends = [730, r.randint(520, 600), 730, r.randint(450, 729), r.randint(601, 729)]
    return {i: some(r.choice([0, 1, 3])) + passage[:end] + some(r.choice([1, 2])) for i, end in enumerate(ends)}


@pytest.mark.parametrize("seed", range(20))
def test_repeats_of_unequal_length(seed):
    texts = parts_of_a_passage(seed)
    gone = covered(texts)
    spans = suffix_dedup._group_repeats([[(t, len(t) - LENGTH + 1, 1) for t in texts.values()]], LENGTH)
    for (i, t), own in zip(texts.items(), spans):
        found = np.zeros(len(t), bool)
        for low, high in own:
            found[low:high] = True
        assert found.tolist() == gone[i].tolist()


def test_last_suffix_of_an_array():
    # A repeat that no other suffix follows but short ones: the suffix in the last place counts like the others.
    passage = b"z" + b"a" * (LENGTH - 1)
    spans = suffix_dedup._group_repeats([[(b"b" + passage, 2, 1), (b"c" + passage + b"zz", 4, 1)]], LENGTH)
    assert [suffix_dedup.merged(s) for s in spans] == [[(1, LENGTH + 1)], [(1, LENGTH + 1)]]


def test_passage_whose_length_differs_by_document(spark):
    texts = {10 * seed + i: t for seed in range(8) for i, t in parts_of_a_passage(seed).items()}
    docs = spark.createDataFrame([(i, t.decode()) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    gone = covered(texts)
    for r in suffix_dedup.suffix_dedup(docs).collect():
        kept = np.frombuffer(texts[r["doc_id"]], np.uint8)[~gone[r["doc_id"]]].tobytes()
        assert (bytes(r["kept"]), r["n_removed"]) == (kept, int(gone[r["doc_id"]].sum()))
