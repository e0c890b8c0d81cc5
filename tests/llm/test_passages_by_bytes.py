"""A passage of 51 words that documents share goes by its bytes: 400 go, 399 stay."""

import random

import pytest

from hitscope.llm import suffix_dedup


def passage(size: int) -> str:
    """51 words, with a space at either end *size* bytes."""
    r = random.Random(size)
    letters = size - 52
    sizes = [letters // 51 + (i < letters % 51) for i in range(51)]
    return " " + " ".join("".join(r.choices("abcdefgh", k=n)) for n in sizes) + " "


@pytest.mark.parametrize("size", [399, 400])
def test_passage_of_words_goes_by_its_bytes(spark, size):
    shared = passage(size)
    assert len(shared) == size and len(shared.split()) == 51
    docs = spark.createDataFrame([(i, c * 30 + shared + c * 30) for i, c in enumerate("ABC")], "doc_id long, text string")
    for length in (400, 200):
        gone = size >= length
        for r in suffix_dedup.suffix_dedup(docs, length=length).collect():
            own = "ABC"[r["doc_id"]] * 30
            assert bytes(r["kept"]).decode() == (own + own if gone else own + shared + own)
            assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (size + 60, size * gone, int(gone))
