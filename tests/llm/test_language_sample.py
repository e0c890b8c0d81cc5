"""The training sample holds distinct texts, also of a language made up of copies."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitscope.llm import language_id


def test_sample_of_copies(spark):
    rows = [(i, f"text number {i % 5} of few", "aa") for i in range(4000)] + [(4000 + i, f"other {i}", "bb") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = [tuple(r) for r in language_id.training_sample(docs, per_language=4)]
    assert len(sample) == len(set(sample)) == 8
    assert [lang for lang, _ in sample] == ["aa"] * 4 + ["bb"] * 4


def test_every_language_is_learnt(spark, monkeypatch):
    """Forty languages, one of them of a single text."""
    rows = [(i, f"{chr(97 + i % 26) * 3}{chr(97 + i % 39 // 26) * 3} words {i}", f"l{i % 39:02d}") for i in range(2000)]
    docs = spark.createDataFrame([*rows, (5000 + next(i for i in range(9) if zlib.crc32(str(5000 + i).encode()) % 5), "the only one", "rare")], "doc_id long, text string, lang string")
    sample = language_id.training_sample(docs, per_language=3)
    assert {r["lang"] for r in sample} == {f"l{i:02d}" for i in range(39)} | {"rare"}
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 39)
    with pytest.raises(ValueError, match="40 languages"):
        language_id.training_sample(docs)


def test_keeping_the_identified(spark):
    words = {"xx": "aba cada baba", "yy": "eko meno pole", "zz": "uri tusi kulu"}
    rows = [(i, f"{words[k]} " * 9 + str(i), k, "own", i) for i in range(120) for k in [sorted(words)[i % 3]]]
    rows += [(1000, None, "xx", "none", 1), (1001, "", "xx", "empty", 2), (1002, "12 34 !", None, "no letter", 3), (None, words["xx"] * 5, None, "no id", 4), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, has_letter string, score int").repartition(3)
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r["doc_id"] not in (1000, 1001, 1002))
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.keep_identified(unlabelled).count() == docs.count() - 3
    assert language_id.keep_identified(docs.limit(0)).collect() == []


def test_a_text_longer_than_what_is_in_work_at_once():
    rng = np.random.default_rng(1)
    net = language_id.new_network(["a", "b", "c"], 4, rng)
    data = rng.integers(97, 123, 2_500_000).astype(np.uint8)
    texts = pa.array([data.tobytes().decode(), "short"])
    best, score = language_id._judge(net, texts, pa.array([True, True]))
    whole = language_id.document_probabilities(net, data, np.array([0, len(data)]))
    assert best[0] == whole[0].argmax() and abs(score[0] - whole[0].max()) < 1e-6
