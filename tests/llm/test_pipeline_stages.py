"""Each stage of the pipeline on what its predecessor kept, against plain versions; and the run as a whole."""

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\r\x0b\x0c"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given tables, and documents for which a stage has something to do."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    longest = docs.orderBy(F.length("text").desc(), "doc_id").first()
    item = items.orderBy(F.length("text").desc(), "item_id").first()["text"]
    shared = "a line of some length that two of the documents hold"
    filler = "with and the other there then her that one more of them on an in the end"
    planted = [
        (9000, None), (9001, ""), (9002, "12 -- 34 !"),  # no language
        (9003, f"{shared}\n{longest['text'][:300]}"), (9004, f"  {shared.upper()}\t\n{longest['text'][300:600]}"),
        (9005, longest["text"] + " one more"), (9006, longest["text"]),  # near-duplicates
        (9007, f"{filler} {item} {filler}"),
    ]
    kinds = dict(docs.dtypes)
    extra = spark.createDataFrame(planted, "doc_id long, text string")
    extra = extra.select(*(F.col(c) if c == "text" else F.col(c).cast(kinds[c]) if c == "doc_id" else F.lit(None).cast(kinds[c]).alias(c) for c in docs.columns))
    docs.union(extra).repartition(3).write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def shingles(text: str) -> set[tuple]:
    words = re.findall(f"[^{SPACE}]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def without_lines(texts: dict[int, str]) -> dict[int, str]:
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))

    holders: dict[str, set] = {}
    for doc, text in texts.items():
        for line in text.split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    gone = lambda doc, k: len(k) >= 10 and min(holders[k]) != doc
    return {doc: "\n".join(line for line in text.split("\n") if not gone(doc, key(line))) for doc, text in texts.items()}


def one_of_each(texts: dict[int, str]) -> set[int]:
    sets = {doc: shingles(text) for doc, text in sorted(texts.items())}
    group = {doc: doc for doc in sets}

    def root(doc):
        while group[doc] != doc:
            doc = group[doc]
        return doc

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            # Texts without words are equal to each other.
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {doc for doc in ids if root(doc) == doc}


def test_stages_and_run(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    def after(name, before, columns=docs.columns):
        path = f"{folder}/after-{name}"
        found = stages[name](spark, before, folder)
        assert found.columns == columns
        found.write.parquet(path)
        return spark.read.parquet(path)

    def texts(frame):
        rows = frame.select("doc_id", "text").collect()
        assert len({r["doc_id"] for r in rows}) == len(rows)
        return {r["doc_id"]: r["text"] for r in rows}

    known = after("language_id", docs)
    assert set(texts(docs)) - set(texts(known)) == {9000, 9001, 9002}
    assert sorted(map(str, known.collect())) == sorted(str(r) for r in docs.collect() if r["doc_id"] in texts(known))

    lines = after("line_dedup", known)
    assert texts(lines) == without_lines(texts(known))
    assert texts(lines)[9004] != texts(known)[9004]
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    near = after("near_dedup", lines)
    assert set(texts(near)) == one_of_each(texts(lines))
    assert set(texts(near)) < set(texts(lines))

    clean = after("decontamination", near)
    items = [re.findall(r"\w+", r["text"].lower()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    grams = {tuple(words[i : i + 5]) for words in items for i in range(len(words) - 4)}
    kept = texts(clean)
    for doc, text in texts(near).items():
        words = re.findall(r"\w+", text.lower())
        if any(words[i : i + len(item)] == item for item in items for i in range(len(words) - len(item) + 1)):
            assert doc not in kept, "holds an item word for word"
        elif not any(tuple(words[i : i + 5]) in grams for i in range(len(words) - 4)):
            assert kept.get(doc) == text, "shares no five words with an item"
    assert 9007 in texts(near) and 9007 not in kept

    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for doc, text in kept.items():
        ids = plain.encode_ordinary(text)
        coded = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[doc] = (len(ids), hashlib.sha256(coded).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    encoded = after("byte_bpe", clean, names)
    assert {r[0]: tuple(r)[1:] for r in encoded.select(*names).collect()} == expected

    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, run.select(*names).collect())) == sorted((doc, *rest) for doc, rest in expected.items())
