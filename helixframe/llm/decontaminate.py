"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations.

Each benchmark item is cut into windows of WINDOW consecutive words (an item of fewer words is one window). A window is
a set of shingles of up to three words. Since a document must hold the whole window, it must hold any single shingle of
it: the shingles are ordered by their number of occurrences in all documents, and the rarest one of a window, with its
place in it, is the window's prefix. Positions of the documents' words join the prefixes on that shingle. The place fixes
where the window would start (positional bound), the start and the window's length must fit the document (length bound),
and the words there must equal the window's (verification). Counting occurrences is a partial sum over a semi-join, so
frequent shingles cost a map-side counter each.

The prefixes hold about one row per benchmark word. Their bytes are added up first: up to BROADCAST_BYTES they are broadcast,
and the words are exploded, joined and verified without a shuffle. Beyond that, positions and prefixes are shuffled by
shingle and only candidates meet their documents again, by document. Words are split once in each of three passes (rarity,
candidates, word counts), whatever the lengths of the items.

A hit carries the number of its window's item list, not the list; ids are looked up once for each distinct combination
of lists that any document has, so a passage that a third of all documents hold costs one lookup.

Defined cases: null text has no words. Items with null text or no word are left out; an item with null item_id marks
words as hit and adds no item. Equal items count by their ids. Rows with equal doc_id and other texts keep their own
hits. Document and item columns other than doc_id, text and item_id are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_row, checkpoint, from_row, stored, table, words_between

#: Words are runs of anything else, A-Z lower-cased.
GAPS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
WINDOW = 10
SHINGLE = 3
#: Bytes of prefixes that may be broadcast.
BROADCAST_BYTES = 48 << 20


def item_words(text: Column) -> Column:
    return words_between(text, GAPS, lower=True)


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, ids): each distinct window with the sorted ids of the items it belongs to."""
    words = items.select("item_id", item_words(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    cut = words.select("item_id", "all", F.explode(starts).alias("start")).select("item_id", F.slice("all", F.col("start"), window).alias("words"))
    return cut.groupBy("words").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))


def _shingle(words: Column, at: Column, size: int) -> Column:
    """Hash of the `size` words from 0-based `at`; null if they reach over the end."""
    parts = [F.get(words, at + F.lit(k)) for k in range(size)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(size), *parts))


def _positions(docs: DataFrame, sizes: list[int], keep: list[str]) -> DataFrame:
    """A row for each word position and size of (id, text_hash, words), with its shingle."""
    exploded = docs.select("id", "text_hash", "words", F.posexplode("words").alias("pos", "word"))
    made = [F.when(F.lit(True) if n == 1 else F.get("words", F.col("pos") + F.lit(n - 1)).isNotNull(), F.xxhash64(F.lit(n), "word", *[F.get("words", F.col("pos") + F.lit(k)) for k in range(1, n)])) for n in sizes]
    return exploded.select(*keep, "pos", made[0].alias("shingle") if len(made) == 1 else F.explode(F.array(*made)).alias("shingle"))


def _prefixes(docs: DataFrame, cut: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """(shingle, place, window_words, ids_no): the rarest shingle of each window."""
    size = F.least(F.size("words"), F.lit(SHINGLE))
    places = cut.select("words", "ids_no", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("place"))
    shingle = F.coalesce(*[F.when(size == n, _shingle(F.col("words"), F.col("place"), n)) for n in sizes])
    places = places.select("words", "ids_no", "place", shingle.alias("shingle"))
    known = places.select("shingle").distinct()
    seen = _positions(docs, sizes, []).join(F.broadcast(known) if small else known, "shingle").groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    ranked = places.join(seen, "shingle")  # a window with a shingle that occurs nowhere occurs nowhere
    whole = ranked.groupBy("words").agg(F.min_by(F.struct("shingle", "place", "ids_no"), F.struct("seen", "place")).alias("p"), F.count(F.lit(1)).alias("found"))
    whole = whole.where(F.col("found") == F.size("words") - size + 1)
    return whole.select("p.shingle", "p.place", F.col("words").alias("window_words"), "p.ids_no")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, spans, sets) for each document with any occurrence, and (ids_no, ids).

    spans are [start, end) pairs; sets are the numbers of the item lists of its windows.
    """
    all_windows = checkpoint(windows(items, window))
    numbered = checkpoint(all_windows.select("ids").distinct().select("ids", F.monotonically_increasing_id().alias("ids_no")))
    cut = all_windows.join(numbered, "ids").select("words", "ids_no")
    # what a row takes in memory: its words, 16 bytes a word for their places, and 64 for the rest
    row = F.octet_length(F.array_join("words", "")) + 16 * F.size("words") + 64
    sizes = all_windows.groupBy(F.least(F.size("words"), F.lit(SHINGLE)).alias("size")).agg(F.sum(row).alias("bytes"), F.sum(F.size("words")).alias("places")).collect()
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), item_words(F.col("text")).alias("words"))
    span = F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))
    sets = F.sort_array(F.collect_set("ids_no")).alias("sets")
    if not sizes:
        none = texts.where(F.lit(False)).withColumns({"start": F.lit(0), "length": F.lit(0), "ids_no": F.lit(0).cast("long")})
        return none.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(span)).alias("spans"), sets), numbered
    lengths = sorted(r["size"] for r in sizes)
    small = max(sum(r["bytes"] for r in sizes), 24 * sum(r["places"] for r in sizes)) <= broadcast_bytes
    prefixes = _prefixes(texts, cut, lengths, small)
    start, length = F.col("pos") - F.col("place"), F.size("window_words")
    if small:
        near = _positions(texts, lengths, ["id", "text_hash", "words"]).join(F.broadcast(prefixes), "shingle")
        near = near.where((start >= 0) & (start + length <= F.size("words")))
    else:
        near = _positions(texts, lengths, ["id", "text_hash"]).join(prefixes, "shingle").where(start >= 0)
        near = near.select("id", "text_hash", "pos", "place", "window_words", "ids_no").alias("n").join(
            texts.alias("t"), F.col("n.id").eqNullSafe(F.col("t.id")) & (F.col("n.text_hash") == F.col("t.text_hash")))
        near = near.select("n.*", "t.words").where(start + length <= F.size("words"))
    same = near.where(F.slice("words", start + 1, length) == F.col("window_words")).select("id", "text_hash", start.alias("start"), length.alias("length"), "ids_no")
    return same.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(span)).alias("spans"), sets), numbered


def _item_ids(found: DataFrame, numbered: DataFrame) -> DataFrame:
    """(sets, item_ids): for each distinct combination of item lists the sorted ids; documents with one passage share one."""
    parts = found.select("sets").distinct().select("sets", F.explode("sets").alias("ids_no")).join(numbered, "ids_no")
    ids = parts.select("sets", F.explode_outer("ids").alias("item"))
    return ids.groupBy("sets").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))


def _covered(spans: Column) -> Column:
    """Words in the union of spans that are sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["upto"]), F.lit(0)).cast("long")).alias("n"),
        F.greatest(acc["upto"], s["end"]).alias("upto"),
    )
    return F.aggregate(spans, zero, step)["n"]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), contaminated; a row for each row of docs."""
    found, numbered = hits(docs.select("doc_id", "text"), items.select("item_id", "text"), window, broadcast_bytes)
    found = checkpoint(found)
    # a table, which is broadcast where it is small; beyond that Spark can split a combination that very many documents have
    named = found.join(stored(_item_ids(found, numbered)), "sets").select("id", "text_hash", "spans", F.col("item_ids").alias("ids"))
    every = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    both = every.join(named, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left")
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return both.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), (n_hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of `docs` without a word in any occurrence of a benchmark window; columns as they came."""
    found = hits(docs.select("doc_id", "text"), items.select("item_id", "text"), window)[0].select("id", "text_hash")
    wide = as_row(docs).select("row", F.xxhash64(F.coalesce(F.col("row")["text"], F.lit(""))).alias("hash"))
    clean = wide.join(found, F.col("row")["doc_id"].eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left_anti")
    return from_row(clean, docs.columns)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    sha = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return got.select("doc_id", "n_words", "n_hit", "n_items", sha.alias("items_sha256"), "contaminated")


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), ik AS (
  SELECT DISTINCT item_id, len(s) AS n, array_to_string(s, ' ') AS k FROM (
    SELECT item_id, w[i:least(i + 9, len(w))] AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0))
), sizes AS (SELECT DISTINCT n FROM ik),
dk AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(w) >= n)
), m AS (SELECT doc_id, i, dk.n AS n, item_id FROM dk JOIN ik ON dk.k = ik.k AND dk.n = ik.n),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN p ON dw.doc_id = p.doc_id LEFT JOIN t ON dw.doc_id = t.doc_id
"""
