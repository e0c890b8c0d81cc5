"""Merkle manifest of a dataset, with a proof for every row by incremental witnesses.

Leaves are appended in order. Subtrees of equal height merge as soon as both are
there, so what is open at any moment is one subtree for each binary digit of the
number of leaves. Every open subtree carries the partial witnesses (the siblings
met so far) of its leaves, and whenever a sibling completes, both sides' witnesses
are extended by the other side's hash. A task appends one aligned block of leaves;
the roots of the blocks are then appended in the same way, block by block, and what
their witnesses gain is put behind those of the leaves. No task holds more than one
block, whatever the size of a group.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hitscope.llm.common import save

#: Leaves, or roots of blocks, that one block holds: a power of two.
BLOCK = 1 << 10
#: What the witness has at a level: the sibling behind a side, or LONE where a run holds one node only.
LEFT, RIGHT, LONE = "L", "R", ""
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Appender:
    """Open subtrees of the leaves appended so far, and the witnesses of those leaves."""

    def __init__(self):
        self.witnesses: list[list[str]] = []
        self.open: list[tuple[int, str, int]] = []  # height, hash, first leaf; heights fall from left to right

    def append(self, leaf: str) -> None:
        self.open.append((0, leaf, len(self.witnesses)))
        self.witnesses.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._merge()

    def _merge(self) -> None:
        _, right, middle = self.open.pop()
        height, left, first = self.open.pop()
        for witness in self.witnesses[first:middle]:
            witness.append(RIGHT + right)
        for witness in self.witnesses[middle:]:
            witness.append(LEFT + left)
        self.open.append((height + 1, digest(left + right), first))

    def close(self, height: int) -> str:
        """Root at this height; a node without a sibling is hashed alone, level by level."""
        while len(self.open) > 1 or self.open[0][0] < height:
            level, lone, first = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == level:
                self._merge()
                continue
            for witness in self.witnesses[first:]:
                witness.append(LONE)
            self.open[-1] = level + 1, digest(lone), first
        return self.open[0][1]


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    return max(0, leaves - 1).bit_length()


def _sized(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    """Hash of the fields, each as its size in bytes, a colon and its text, or ``-`` for NULL."""
    return F.sha2(F.concat(*map(_sized, fields)).cast("binary"), 256)


def placed(frame: DataFrame, key: str, *order: str) -> DataFrame:
    """*frame* with ``pos``, the place of a row (from 0) in its *key* by *order*, and ``total``, the rows of the key.

    A distributed sort: a key that holds most rows is spread over many ranges, as are rows that
    are all equal, and only the numbers of rows of a key in each range are added up.
    """
    ties = frame.withColumn("tie", F.monotonically_increasing_id())
    ranges = ties.repartitionByRange(key, *order, "tie").sortWithinPartitions(key, *order, "tie").drop("tie")
    ranges = save(
        ranges.withColumn("part", F.spark_partition_id()).withColumn(
            "place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "placed",
    )
    counts = ranges.groupBy("part", key).agg(F.min("place").alias("low"), F.count("*").alias("n"))
    own = Window.partitionBy(key)
    before = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("part", key, (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"), F.sum("n").over(own).alias("total"))
    joined = ranges.join(counts, ["part", key])
    return joined.withColumn("pos", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def _append_block(block: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows.column("pos").to_numpy())))
        total = rows.column("total")[0].as_py()
        appender = Appender()
        for leaf in rows.column("hash").to_pylist():
            appender.append(leaf)
        root = appender.close(height_of(min(total, block)))
        kept = rows.drop_columns(["witness", "root"])
        return kept.append_column("witness", pa.array(appender.witnesses, pa.list_(pa.string()))).append_column(
            "root", pa.array([root] * rows.num_rows, pa.string())
        )

    return run


def witnessed(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """*nodes* (``key, pos, total, hash`` and more) with ``witness`` and ``root`` of the tree of their key."""
    shape = nodes.withColumn("block", F.floor(F.col("pos") / block)).withColumns(
        {"witness": F.lit(None).cast("array<string>"), "root": F.lit(None).cast("string")}
    )
    appended = save(shape.groupBy("key", "block").applyInArrow(_append_block(block), shape.schema), "appended")
    roots = appended.filter(F.col("total") > block).groupBy("key", F.col("block").alias("pos")).agg(
        F.ceil(F.first("total") / block).alias("total"), F.first("root").alias("hash")
    )
    if roots.isEmpty():
        return appended.drop("block")
    above = witnessed(roots, block).select("key", F.col("pos").alias("block"), F.col("witness").alias("more"), F.col("root").alias("top"))
    whole = appended.join(above, ["key", "block"], "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return whole.select(
        *(c for c in nodes.columns), F.concat("witness", more).alias("witness"), F.coalesce("top", "root").alias("root")
    )


def fold(leaf: Column, witness: Column) -> Column:
    """Root that a leaf and its witness give."""

    def step(node: Column, sibling: Column) -> Column:
        other = F.substring(sibling, 2, 64)
        both = F.when(F.startswith(sibling, F.lit(LEFT)), F.concat(other, node)).otherwise(F.concat(node, other))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(witness, leaf, step)


def proof_hash(witness: Column) -> Column:
    """Hash of the siblings of a witness, in order."""
    return F.sha2(F.translate(F.array_join(witness, ""), LEFT + RIGHT, "").cast("binary"), 256)


def manifest(docs: DataFrame, claimed: Column | None = None, block: int = BLOCK) -> DataFrame:
    """``doc_id, lang, leaf, claimed, subroot, root, witness``, one row for each row of *docs*.

    A row's leaf is the hash of ``doc_id, source, lang, n_chars, text``. The leaves of a language
    are ordered by ``doc_id`` (rows without an id first, rows that repeat one by leaf) and paired
    up to its subroot; the subroots, a NULL language first, then by the bytes of the name, are paired up
    to the root. A language of one row has its leaf for a subroot, and a table of one language
    that subroot for a root. ``witness`` is the siblings from leaf to root (``L`` or ``R`` and the hash,
    or an empty text where there is none). *claimed*, an expression on the columns of
    *docs*, is a leaf hash to check later by ``fold``; the leaf itself without it. An empty table gives no rows.
    Texts may be NULL, empty or of any length; other columns are not read.
    """
    leaf = leaf_hash(*map(F.col, FIELDS))
    key = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = docs.select(
        F.col("doc_id"), F.col("lang"), key.alias("key"), leaf.alias("hash"), (leaf if claimed is None else claimed).alias("claimed")
    )
    grown = witnessed(placed(leaves, "key", "doc_id", "hash"), block)
    grown = save(grown, "grown")
    subroots = grown.groupBy(F.col("key").alias("part_of")).agg(F.first("root").alias("hash"))
    top = witnessed(placed(subroots.withColumn("key", F.lit("")), "key", "part_of"), block)
    top = top.select(F.col("part_of").alias("key"), F.col("witness").alias("more"), F.col("root").alias("top"))
    return grown.join(top, "key").select(
        "doc_id", "lang", F.col("hash").alias("leaf"), "claimed", F.col("root").alias("subroot"), F.col("top").alias("root"),
        F.concat("witness", "more").alias("witness"),
    )


def tampered_leaf() -> Column:
    """Leaf hash with 1 added to ``n_chars`` where 7 divides the crc32 of the id as text; a NULL id or count stays."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    changed = F.when(hit, more).otherwise(F.col("n_chars").cast("string"))
    return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), changed, F.col("text"))


def verified_manifest(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: the manifest, checked against tampered rows."""
    rows = manifest(docs, tampered_leaf(), block)
    folded = rows.withColumn("folded_root", fold(F.col("claimed"), F.col("witness")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("witness")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql_sized(value: str) -> str:
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


_SQL_LEAF = "sha256(" + " || ".join(_sql_sized(f"CAST({c} AS VARCHAR)") for c in FIELDS) + ")"
_SQL_CHANGED = _SQL_LEAF.replace("CAST(n_chars AS VARCHAR)", "CAST(CAST(n_chars AS HUGEINT) + hit AS VARCHAR)")
# One step of crc32 for a bit, and eight of them for a byte.
_CRC_BYTE = "xor(c, x)"
for _ in range(8):
    _CRC_BYTE = f"list_transform([{_CRC_BYTE}], lambda v: xor(v >> 1, (v & 1) * 3988292384))[1]"

ORACLE_SQL = f"""
WITH RECURSIVE crcs AS (
  SELECT doc_id, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda c, x: {_CRC_BYTE}, CAST(4294967295 AS BIGINT)), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
marked AS (
  SELECT d.*, CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS hit FROM documents d LEFT JOIN crcs USING (doc_id)),
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS key, {_SQL_LEAF} AS leaf, {_SQL_CHANGED} AS claimed FROM marked),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
tree AS (
  SELECT key, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY key) AS n FROM numbered
  UNION ALL
  SELECT key, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY key, level, pos // 2),
nodes AS MATERIALIZED (SELECT * FROM tree),
subroots AS MATERIALIZED (
  SELECT key, h AS subroot, level AS height, row_number() OVER (ORDER BY key) - 1 AS pos FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM upper WHERE n > 1 GROUP BY level, pos // 2),
above AS MATERIALIZED (SELECT * FROM upper),
steps AS (
  SELECT l.doc_id, l.key, l.pos AS place, s.pos & 1 AS odd, s.level, o.h
  FROM numbered l JOIN nodes s ON s.key = l.key AND s.pos = l.pos >> s.level AND s.n > 1
  LEFT JOIN nodes o ON o.key = s.key AND o.level = s.level AND o.pos = xor(s.pos, 1)
  UNION ALL
  SELECT l.doc_id, l.key, l.pos, s.pos & 1, r.height + s.level, o.h
  FROM numbered l JOIN subroots r ON r.key = l.key JOIN above s ON s.pos = r.pos >> s.level AND s.n > 1
  LEFT JOIN above o ON o.level = s.level AND o.pos = xor(s.pos, 1)),
proofs AS MATERIALIZED (
  SELECT key, place, list({{'odd': odd, 'h': coalesce(h, '')}} ORDER BY level) AS path FROM steps GROUP BY key, place),
walk AS (
  SELECT l.key, l.pos, 0 AS done, l.claimed AS h, coalesce(p.path, []) AS path
  FROM numbered l LEFT JOIN proofs p ON p.key = l.key AND p.place = l.pos
  UNION ALL
  SELECT key, pos, done + 1,
    sha256(CASE WHEN path[done + 1].odd = 1 THEN path[done + 1].h || h ELSE h || path[done + 1].h END), path
  FROM walk WHERE done < len(path))
SELECT l.doc_id, l.leaf, r.subroot, (SELECT h FROM above WHERE n = 1) AS root,
  sha256(list_aggregate(list_concat([''], list_transform(w.path, lambda s: s.h)), 'string_agg', '')) AS proof_sha256,
  w.h AS folded_root, w.h = (SELECT h FROM above WHERE n = 1) AS verified
FROM numbered l JOIN subroots r ON r.key = l.key JOIN walk w ON w.key = l.key AND w.pos = l.pos AND w.done = len(w.path)
"""
