"""Line deduplication: drop lines that other documents hold as well.

DataFrame functions only. Lines are exploded as (digest of the normalised line,
document, position); the text of a line is never shuffled. Documents per digest
are counted by a partial aggregate, so a line of every document costs one row
per task, and the inner join back is one that adaptive execution can split.
Positions of dropped lines are gathered per document and the rest of the lines
is put together again in order.
"""

from pyspark.sql import DataFrame, functions as F

from hitscope.llm.common import id_and_text

# What is stripped from both ends of a line, and the letters that are lowered.
BLANKS = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """A line without blanks at its ends, A-Z lowered."""
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def _digest(key):
    """Two hashes with seeds of their own: 128 bits tell lines apart at any corpus size."""
    return F.struct(F.xxhash64(key).alias("low"), F.xxhash64(F.lit("line"), key).alias("high"))


def shared_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``digest, first_doc, n_docs`` of every line key of *min_chars* or more that *min_docs* documents hold."""
    per_doc = _long_lines(docs, min_chars).select("digest", "doc_id").distinct()
    return (
        per_doc.groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    lines = (
        id_and_text(docs)
        .filter(F.col("doc_id").isNotNull())
        .select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
    )
    keyed = lines.select("doc_id", "position", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select("doc_id", "position", _digest(F.col("key")).alias("digest"))


def dropped_positions(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``doc_id, dropped``: positions (from 0) of the lines that each document loses.

    With the usual two documents, "held by another one" is first_doc < last_doc,
    which needs no list of distinct documents and combines fully on the map side.
    """
    lines = _long_lines(docs, min_chars)
    if min_docs == 2:
        shared = (
            lines.groupBy("digest")
            .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
            .filter("first_doc < last_doc")
            .drop("last_doc")
        )
    else:
        shared = shared_lines(docs, min_chars, min_docs).drop("n_docs")
    lost = lines.join(shared, "digest").filter(F.col("doc_id") != F.col("first_doc"))
    return lost.groupBy("doc_id").agg(F.collect_set("position").alias("dropped"))


def line_dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, counts: bool = True) -> DataFrame:
    """All columns of *docs* with the kept text as ``text``, and with *counts* ``n_lines``, ``n_dropped``.

    Columns of *docs* of these two names give way to the counts.

    A text is split at line feeds; NULL and empty are one empty line. A key (see
    line_key) of at least *min_chars* characters that is found in at least
    *min_docs* documents stays only in the smallest ``doc_id`` that holds it, where all its
    lines stay. ``doc_id`` names the document: rows that repeat an id are one
    document (a position lost by one of them is lost by all), a row without an
    id neither causes nor suffers a loss. Other columns pass as they are.
    """
    packed = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    positions = dropped_positions(docs, min_chars, min_docs).select(F.col("doc_id").alias("id"), "dropped")
    joined = packed.join(positions, "id", "left").select(
        "row",
        F.split(F.coalesce(F.col("row").getField("text"), F.lit("")), "\n", -1).alias("lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    text = F.when(F.size("dropped") == 0, F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at("lines", i + 1)), "\n")
    )
    counted = joined.select(
        "row", text.alias("kept"), F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped")
    )
    own = ["n_lines", "n_dropped"] if counts else []
    columns = [F.col("kept").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c not in own]
    return counted.select(*columns, *own)


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.first_doc AS lost
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
