"""Line deduplication in DataFrame operations.

Lines are exploded with a 128-bit hash of their key and their position, distinct documents are counted for each hash,
and only hashes over the threshold go back to the lines they belong to. What reaches a document is the sorted list of
positions to drop (the hashes are checkpointed in between, so that the join deals out both of its sides and Spark can split
a hot hash among tasks); the kept lines are the slices between them, so reassembly is one pass over the lines. Texts are
shuffled once, by document; a hash that a third of all lines share is counted with partial sums before the shuffle and
split by Spark's skew handling in the join, whose rows are three numbers wide.

Defined cases: null or empty text is one empty line. Rows with equal doc_id and text get the same result; rows with equal
doc_id and other texts count as one document and are reassembled each by its own positions. A row without doc_id counts
as no document and keeps all its lines. Other columns pass through untouched in drop_lines().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, as_row, ascii_lower, checkpoint, from_row, table

LEAST_CHARS = 20
LEAST_DOCS = 3


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def dropped_positions(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(id, text_hash, dropped): the positions, ascending from 0, that each document with any loses."""
    lines = (
        docs.select(F.col("doc_id").alias("id"), _text_hash(F.col("text")).alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .where(F.col("id").isNotNull())
        .select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= least_chars)
        .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    common = checkpoint(
        lines.groupBy("h1", "h2").agg(F.count_distinct("id").alias("docs"), F.max("id").alias("last"))
        .where(F.col("docs") >= least_docs).select("h1", "h2", "last")
    )
    return (
        lines.join(common, ["h1", "h2"]).where(F.col("id") != F.col("last"))
        .groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped positions, joined again."""
    after = F.concat(F.array(F.lit(-1)), dropped)
    until = F.concat(dropped, F.array(F.size(lines)))
    runs = F.zip_with(after, until, lambda a, b: F.slice(lines, a + F.lit(2), b - a - F.lit(1)))
    return F.array_join(F.flatten(runs), "\n")


def _joined(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """row, lines, dropped."""
    wide = as_row(docs).select("row", F.col("row")["doc_id"].alias("doc"), _text_hash(F.col("row")["text"]).alias("hash"))
    drops = dropped_positions(docs, least_chars, least_docs)
    both = wide.join(drops, (F.col("doc") == F.col("id")) & (F.col("hash") == F.col("text_hash")), "left")
    return both.select("row", _lines(F.col("row")["text"]).alias("lines"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text."""
    return _joined(docs.select("doc_id", "text"), least_chars, least_docs).select(
        F.col("row")["doc_id"].alias("doc_id"), F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"),
        F.when(F.size("dropped") == 0, F.coalesce(F.col("row")["text"], F.lit(""))).otherwise(_kept(F.col("lines"), F.col("dropped"))).alias("kept_text"),
    )


def drop_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """`docs` with its texts deduplicated, and n_chars, if there is one, counted again where lines went."""
    joined = _joined(docs, least_chars, least_docs)
    same = F.size("dropped") == 0
    kept = joined.select("row", same.alias("same"), F.when(same, F.col("row")["text"]).otherwise(_kept(F.col("lines"), F.col("dropped"))).alias("kept"))
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("same"), F.col("row")["n_chars"]).otherwise(F.char_length("kept").cast(docs.schema["n_chars"].dataType))
    return from_row(kept, docs.columns, **new)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_lines(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, u.pos AS pos, u.line AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(ls) AS line, unnest(range(len(ls))) AS pos) u
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM k LEFT JOIN c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
