import hashlib
import zlib

import pytest

from hitscope.llm import merkle


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(nodes):
    """Root of a list of hashes, and for each of them its siblings as (side, hash) by level, by the plain rule."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            if i ^ 1 < len(nodes):
                path.append(("L" if i & 1 else "R", nodes[i ^ 1]))
            else:
                path.append(("", ""))
        nodes = [_h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], paths


def _fold(leaf, path):
    for side, other in path:
        leaf = _h(other + leaf if side == "L" else leaf + other)
    return leaf


@pytest.mark.parametrize("n", [*range(1, 20), 31, 32, 33, 70])
def test_appended_witnesses_are_those_of_the_whole_tree(n):
    leaves = [_h(str(i)) for i in range(n)]
    appender = merkle.Appender()
    for leaf in leaves:
        appender.append(leaf)
    assert len(appender.open) == n.bit_count()
    root, paths = _tree(leaves)
    assert appender.close(merkle.height_of(n)) == root
    assert appender.witnesses == [[side + other for side, other in path] for path in paths]


SCHEMA = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, root STRING, key INT, hash STRING, part INT, leaf INT"


def _brute(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: _h("".join(map(field, (*r[:3], r[3] if r[3] is None else r[3] + more, r[4]))))
    langs = sorted({r[2] for r in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    groups = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs]
    trees = [_tree([leaf(r) for r in group]) for group in groups]
    root, above = _tree([t[0] for t in trees])
    found = []
    for group, (subroot, paths), upper in zip(groups, trees, above):
        for r, path in zip(group, paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = _fold(leaf(r, int(hit)), path + upper)
            proof = _h("".join(other for _, other in path + upper))
            found.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return found


def _rows(n=90):
    rows = [(i, "web" if i % 3 else None, [None, "en", "", "é", "zz"][i % 5 if i > 40 else 1], i if i % 4 else None, f"text {i}") for i in range(n)]
    rows += [(None, None, None, None, None), (None, "s", "en", 3, "x"), (7, "web", "en", 7, "other"), (7, "web", "en", 7, "other")]
    rows += [(1000, "s", "lone", 1, ""), (1001, "s", "en", 2**63 - 1, "word " * 300_000), (1002, "s", "en", None, None), (-5, "é", "en", -1, "ß")]
    return [(*r, "own root", 1, "own hash", 2, 3) for r in rows]


@pytest.mark.parametrize("block", [4, 1024])
def test_manifest_equals_the_plain_rule(spark, block):
    rows = _rows()
    assert any(zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is None for r in rows if r[0] is not None)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = merkle.verified_manifest(table, block)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    order = lambda rows: sorted(map(str, rows))
    assert order(tuple(r) for r in found.collect()) == order(_brute(rows))


def test_a_table_of_equal_rows_and_an_empty_one(spark):
    rows = [(3, "s", "en", 4, "same", None, None, None, None, None)] * 40
    table = spark.createDataFrame(rows, SCHEMA)
    found = merkle.verified_manifest(table, 4)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, _brute(rows)))
    assert merkle.verified_manifest(table.limit(0)).collect() == []
    one = merkle.verified_manifest(table.limit(1)).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == _h("")
