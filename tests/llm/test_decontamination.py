"""Items of any length, with a word changed, dropped or put in, with other fillers, and dense in slots."""

import pytest

from hitscope.llm import decontamination

LONG = "the old miller carried every heavy sack up the narrow stairs because his tired donkey refused to move any further today"
WORDS = LONG.split()
TOWN = "the train to Boston was late so the driver told 1,000 angry people to wait for the next one"
ALICE = "a farmer met Alice near the wide river and then he left. Alice gave 3 red apples to him before she went home"
SUMS = "12 + 7 = 19, 4 + 9 = 13, 22 + 6 = 28 and 31 + 5 = 36"
TITLE = "Who Wrote The Famous Book About The White Whale And Captain Ahab"
PEOPLE = "Invited: Anna, Bruno, Carla, Dario, Elena, Fabio, Gina, Hugo, Irene and Jonas"
SPARSE = "please write down every single step of your " + " ".join(str(100 + 7 * i) for i in range(30))


def found(spark, items, texts):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontamination.contaminations(docs, benchmark).collect()}


def test_short_items_inside_longer_texts(spark):
    items = ["What is the capital of France?", "Name three primes."]
    around = "we were all asked this one at school: {} Nobody in the whole class had the slightest idea"
    texts = [around.format(items[0]), around.format("What is the capital of Spain?"), around.format("What is the length of France?"),
             around.format(items[1]), items[0]]
    rows = found(spark, items, texts)
    assert {k: r["kind"] for k, r in rows.items()} == {
        (0, 0): "verbatim", (1, 0): "template", (3, 1): "verbatim", (4, 0): "verbatim"
    }
    assert rows[0, 0]["start"] == 9


@pytest.mark.parametrize("n", [10, 15, 16, 20])
def test_one_word_changed_dropped_or_put_in(spark, n):
    item, texts = " ".join(WORDS[:n]), []
    for at in range(1, n - 1):
        texts += [WORDS[:at] + ["altered"] + WORDS[at + 1 : n], WORDS[:at] + ["extra"] + WORDS[at:n]]
        texts += [WORDS[:at] + WORDS[at + 1 : n]]
    rows = found(spark, [item], ["so it begins here " + " ".join(t) + " and so it ends" for t in texts])
    assert [" ".join(texts[i]) for i in range(len(texts)) if (i, 0) not in rows] == []


def test_slots_of_other_length_and_sentence_openers(spark):
    texts = [
        TOWN.replace("Boston", "New York"), TOWN.replace("1,000", "500"), TOWN.replace("Boston", "New York").replace("1,000", "3.5"),
        ALICE.replace("Alice", "Clara").replace("3", "17"),
    ]
    rows = found(spark, [TOWN, ALICE], [f"so it was. {t}" for t in texts])
    assert {k: (r["kind"], r["coverage"]) for k, r in rows.items()} == {
        **{(i, 0): ("template", 1.0) for i in range(3)}, (3, 1): ("template", 1.0)
    }


def test_items_dense_in_slots(spark):
    items = [SUMS, TITLE, PEOPLE, SPARSE]
    texts = [f"they said this: {t} and no more of it" for t in items]
    texts += [f"we ask you to {' '.join(SPARSE.split()[:8])} work and hand it in on time with your name on it"]
    texts += [" ".join(str(i * i) for i in range(60))]
    rows = found(spark, items, texts)
    assert {k: r["kind"] for k, r in rows.items()} == {(i, i): "verbatim" for i in range(4)}
    assert rows[3, 3]["n_windows"] == 31


def test_long_runs_of_separators(spark):
    """A megabyte of one separator, or of two in turn, takes no stack."""
    texts = [f"so it is: {TOWN} {run} and so on" for run in ("-" * (1 << 20), " " * (1 << 20), ".," * (1 << 19), "\n" * (1 << 20), "=-" * 1000)]
    texts += ["1.," * 3000, "." * (1 << 20), "\x02\x03" * 5000]
    rows = found(spark, [TOWN], texts)
    assert {k: r["kind"] for k, r in rows.items()} == {(i, 0): "verbatim" for i in range(5)}


def test_dense_items_with_other_fillers_and_names_that_become_one(spark):
    sums = "add 12 to 7 to get 19, add 4 to 9 to get 13, add 22 to 6 to get 28 and add 31 to 5 to get 36"
    other = "add 14 to 8 to get 20, add 3 to 1 to get 15, add 25 to 2 to get 30 and add 33 to 7 to get 39"
    swap = "while we ate Anna gave the red ball to Bruno and then Bruno gave the old hat back to Anna before noon"
    one = swap.replace("Bruno", "Clara").replace("Anna", "Clara")
    two = swap.replace("Bruno", "Clara").replace("Anna", "Dora")
    numbers = " ".join(str(i * 3) for i in range(40)) + " add to get and"
    rows = found(spark, [sums, swap], [f"one says: {t} in the end" for t in (other, one, two, numbers)])
    assert {k: r["kind"] for k, r in rows.items()} == {(0, 0): "template", (2, 1): "template"}


def test_columns_of_documents_with_other_uses(spark):
    docs = spark.createDataFrame([(1, TOWN, 5, "x"), (2, "quite another text", 6, "y"), (None, TOWN, 7, "z")], "doc_id long, text string, _bad int, item_id string")
    benchmark = spark.createDataFrame([(1, TOWN)], "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r["_bad"], r["item_id"]) for r in kept.collect()) == [(6, "y"), (7, "z")]
