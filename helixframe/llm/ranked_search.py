"""Ranked lexical search over a length-stratified index, exact, for a whole set of queries at once.

A document's score depends on its length only through the integer normaliser m, so documents of equal m are one stratum. The
index holds, for each part of a stratum (at most PART_DOCS documents, in the order of doc_id), the postings of every query term
grouped by tf, largest first: inside a stratum the impact w * (1000000000 tf div (1000 tf + 20 m)) of a group is one number, so it is
computed once for a tf and not once for a posting. The first group of a term bounds what any document of the part can gain from
it, and the sum over a query's terms bounds its score there.

The search orders its visits by these bounds. Each query first visits the SEEDS parts that promise it most, anywhere in the
index, and the score of its last place there is a threshold that the final one cannot fall below. Then every part is offered
to every query, within a task those of the largest bounds first, and a query skips each part whose bound is below its threshold,
which rises with what the task has found. Equal bounds are visited, so ties are settled by doc_id alone.

Documents are ranged over the cluster by (m, doc_id), so a stratum with a third of all documents is many parts in many tasks.
The queries (terms, weights, thresholds) are broadcast in blocks whose bytes are added up before, BLOCK_BYTES at most or one query;
each block reads the documents once. A task returns no more than `best` rows a query.

Defined cases: null and empty texts have no terms and are no documents of the statistics. Queries without terms, or whose terms
occur nowhere, give no row. Each row of either table counts by itself, repeated ones too; null doc_id come first among equal
scores. Columns other than doc_id, item_id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table, words_between

#: Terms are runs of anything else, A-Z lower-cased.
GAPS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
BEST = 50
#: Most documents of a part, and postings after which a part ends.
PART_DOCS, PART_POSTINGS = 4096, 200_000
#: Parts that set a query's first threshold.
SEEDS = 4
#: Bytes of queries that are broadcast at once.
BLOCK_BYTES = 32 << 20
#: (query, posting) pairs that are added up at once.
AT_ONCE = 2_000_000

_FOLD = bytes(ord(" ") if chr(b) in GAPS else ord(chr(b).lower()) if b < 128 else b for b in range(256))


def _words(text: pa.Scalar) -> list[bytes]:
    return bytes(text.as_buffer()).translate(_FOLD).split() if text.is_valid else []


@dataclass
class Queries:
    """A block of queries: the terms of query k are terms[starts[k]:starts[k + 1]], numbered as in `vocabulary`."""

    ids: list[int]
    vocabulary: list[bytes]
    starts: np.ndarray
    terms: np.ndarray


def _blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """(q, item_id, terms, block) with terms, and the number of blocks: doubled until none has more than BLOCK_BYTES."""
    terms = F.array_distinct(words_between(F.col("text").cast("string"), GAPS, lower=True))
    rows = stored(items.select("item_id", terms.alias("terms")).where(F.size("terms") > 0).withColumn("q", F.monotonically_increasing_id()))
    size = F.octet_length(F.array_join("terms", "")) + 64 * F.size("terms") + 64
    blocks = 1
    while True:
        placed = rows.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)))
        most = placed.groupBy("block").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).agg(F.max("bytes")).first()[0]
        if (most or 0) <= BLOCK_BYTES:
            return placed, blocks
        blocks *= 2


def _queries(block: DataFrame) -> Queries:
    rows = sorted(block.select("q", "terms").collect(), key=lambda r: r["q"])  # BLOCK_BYTES at most, or one query
    vocabulary = sorted({t.encode() for r in rows for t in r["terms"]})
    number = {t: k for k, t in enumerate(vocabulary)}
    starts = np.concatenate([[0], np.cumsum([len(r["terms"]) for r in rows])]).astype(np.int64)
    return Queries([r["q"] for r in rows], vocabulary, starts, np.array([number[t.encode()] for r in rows for t in r["terms"]], np.int64))


def _forward(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs): each document's number of terms, and how often it has those of the vocabulary."""
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("tfs", ints)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(vocabulary.value)}
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column(0):
                words = _words(text)
                n.append(len(words))
                for word, tf in Counter(words).items():
                    k = number.get(word)
                    if k is not None:
                        terms.append(k)
                        tfs.append(tf)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n, pa.int64()), *lists], schema.names)

    return stored(docs.select(F.col("text").cast("string"), "doc_id").mapInArrow(run, schema).where("n > 0"))


def _index(forward: DataFrame, n: int, total: int) -> DataFrame:
    """(part, m, doc_ids, terms, tfs, sizes, docs): a row for each part of a stratum.

    Group g has the documents doc_ids[docs[...]] that hold terms[g] exactly tfs[g] times, sizes[g] of them; terms ascend, and
    inside each the tfs descend.
    """
    kind = forward.schema["doc_id"].dataType
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("m", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)), *(T.StructField(c, ints) for c in ("terms", "tfs", "sizes", "docs"))])

    def row(m: int, pieces: list[tuple[pa.Array, pa.Array, pa.Array]]) -> pa.RecordBatch:
        ids = pa.concat_arrays([p[0] for p in pieces])
        doc = np.repeat(np.arange(len(ids)), np.concatenate([p[1].value_lengths().to_numpy(zero_copy_only=False) for p in pieces]))
        term, tf = (np.concatenate([p[k].flatten().to_numpy(zero_copy_only=False) for p in pieces]) for k in (1, 2))
        order = np.lexsort((doc, -tf, term))
        term, tf, doc = term[order], tf[order], doc[order]
        heads = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])) if len(term) else np.zeros(0, np.int64)
        lists = [ids, *(pa.array(v, pa.int32()) for v in (term[heads], tf[heads], np.diff(np.append(heads, len(term))), doc))]
        return pa.RecordBatch.from_arrays([pa.array([m], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pieces, held, postings = None, [], 0, 0
        for batch in batches:
            m = batch.column(0).to_numpy()
            ends = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).cumsum()
            at = 0
            while at < len(m):
                if pieces and (m[at] != now or held >= PART_DOCS or postings >= PART_POSTINGS):
                    yield row(int(now), pieces)
                    pieces, held, postings = [], 0, 0
                now = m[at]
                before = int(ends[at - 1]) if at else 0
                upto = min(int(np.searchsorted(m, now, "right")), at + PART_DOCS - held, int(np.searchsorted(ends, before + PART_POSTINGS - postings)) + 1)
                pieces.append(tuple(batch.column(k).slice(at, upto - at) for k in (1, 2, 3)))
                held, postings, at = held + upto - at, postings + int(ends[upto - 1]) - before, upto
        if pieces:
            yield row(int(now), pieces)

    m = F.expr(f"50 + (50L * n * {n}L) div {total}L").alias("m")
    tasks = int(forward.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = forward.select(m, "doc_id", "terms", "tfs").repartitionByRange(tasks, "m", "doc_id").sortWithinPartitions("m", "doc_id")
    return stored(ranged.mapInArrow(run, schema).withColumn("part", F.monotonically_increasing_id()))


def _weights(forward: DataFrame, n: int, size: int) -> np.ndarray:
    """Each term's weight; 0 for terms that no document has."""
    out = np.zeros(size, np.int64)
    for k, df in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term of the block
        out[k] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return out


class _Part:
    """A part of the index in memory, for the queries of a block."""

    def __init__(self, batch: pa.RecordBatch, k: int, queries: Queries, weight: np.ndarray):
        self.number = batch.column("part")[k].as_py()
        self.ids = batch.column("doc_ids")[k].values
        m = batch.column("m")[k].as_py()
        term, tf, size, self.docs = (batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs", "sizes", "docs"))
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        self.impact = np.repeat(impact, size)
        heads = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        self.start, self.size, most = (np.zeros(len(weight), np.int64) for _ in range(3))
        self.start[term[heads]] = ends[heads]
        self.size[term[heads]] = np.diff(np.append(ends[heads], ends[-1]))
        most[term[heads]] = impact[heads]
        self.bounds = np.add.reduceat(most[queries.terms], queries.starts[:-1])

    def scores(self, chosen: np.ndarray, queries: Queries, least: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, score) of the chosen queries, the `best` first of each with a score of at least `least`."""
        found = []
        lengths = queries.starts[chosen + 1] - queries.starts[chosen]
        of = np.repeat(np.arange(len(chosen)), lengths)
        term = queries.terms[np.repeat(queries.starts[chosen] - np.cumsum(lengths) + lengths, lengths) + np.arange(len(of))]
        work = self.size[term]
        per_query = np.maximum(np.bincount(of, work, len(chosen)), len(self.ids)).cumsum()
        at = 0
        while at < len(chosen):
            upto = max(at + 1, int(np.searchsorted(per_query, (per_query[at - 1] if at else 0) + AT_ONCE, "right")))
            mine = slice(*np.searchsorted(of, (at, upto)))
            sizes = work[mine]
            posting = np.repeat(self.start[term[mine]] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            key = np.repeat((of[mine] - at) * len(self.ids), sizes) + self.docs[posting]
            total = np.bincount(key, self.impact[posting], (upto - at) * len(self.ids)).astype(np.int64)  # below 2 ** 53
            good = np.flatnonzero(total >= np.repeat(np.maximum(least[chosen[at:upto]], 1), len(self.ids)))
            q, doc = good // len(self.ids), good % len(self.ids)
            order = np.lexsort((doc, -total[good], q))
            q, doc, score = q[order], doc[order], total[good][order]
            keep = _place(q) < best
            found.append((chosen[at + q[keep]], doc[keep], score[keep]))
            at = upto
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def _place(sorted_: np.ndarray) -> np.ndarray:
    """Each row's place among the equal values before it."""
    if not len(sorted_):
        return sorted_
    heads = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    return np.arange(len(sorted_)) - np.repeat(heads, np.diff(np.append(heads, len(sorted_))))


def _promising(index: DataFrame, shared, seeds: int) -> DataFrame:
    """(q, part): for each query the parts of the largest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = shared.value
        q = np.arange(len(queries.ids))
        kept = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            for k in range(batch.num_rows):
                part = _Part(batch, k, queries, weight)
                kept = [np.concatenate(x) for x in zip(kept, (q, part.bounds, np.full(len(q), part.number)), strict=True)]
                if len(kept[0]) > 200_000 or k == batch.num_rows - 1:
                    order = np.lexsort((kept[2], -kept[1], kept[0]))
                    order = order[(_place(kept[0][order]) < seeds) & (kept[1][order] > 0)]
                    kept = [x[order] for x in kept]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], ["q", "bound", "part"])

    rows = index.mapInArrow(run, "q long, bound long, part long")
    first = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound"), "part"))
    return rows.withColumn("first", first).where(F.col("first") <= seeds).select("q", "part")


def _visit(index: DataFrame, shared, least: np.ndarray, best: int, only: bool) -> DataFrame:
    """(q, doc_id, score): each task's `best` documents of every query, of scores not below `least`; with `only`, of the queries listed in column qs."""
    kind = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = shared.value
        floor = least.copy()
        kept = None
        for batch in batches:
            parts = [_Part(batch, k, queries, weight) for k in range(batch.num_rows)]
            for k in sorted(range(len(parts)), key=lambda k: -int((parts[k].bounds - floor).max(initial=0))):
                part = parts[k]
                chosen = np.flatnonzero((part.bounds >= floor) & (part.bounds > 0))
                if only:
                    chosen = np.intersect1d(chosen, batch.column("qs")[k].values.to_numpy(zero_copy_only=False))
                if not len(chosen):
                    continue
                q, doc, score = part.scores(chosen, queries, floor, best)
                new = pa.table({"q": pa.array(q), "doc_id": part.ids.take(pa.array(doc)), "score": pa.array(score)})
                kept = new if kept is None else pa.concat_tables([kept, new])
                if len(kept) > 100_000:
                    kept = _best_of(kept, best, floor)
        if kept is not None:
            yield from _best_of(kept, best, floor).combine_chunks().to_batches()

    return index.mapInArrow(run, schema)


def _best_of(found: pa.Table, best: int, floor: np.ndarray) -> pa.Table:
    """The `best` rows of each query; raises `floor` to the last score of those that have as many."""
    order = pc.sort_indices(found, sort_keys=[("q", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_start")
    found = found.take(order)
    q = found.column("q").to_numpy()
    place = _place(q)
    last = place == best - 1
    floor[q[last]] = np.maximum(floor[q[last]], found.column("score").to_numpy()[last])
    return found.filter(pa.array(place < best))


def _first(rows: DataFrame, best: int, *keys: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= best)


def _search_block(docs: DataFrame, block: DataFrame, best: int, seeds: int) -> DataFrame:
    """(q, rank, doc_id, score) of one block of queries."""
    sc = docs.sparkSession.sparkContext
    queries = _queries(block)
    vocabulary = sc.broadcast(queries.vocabulary)
    forward = _forward(docs, vocabulary)
    vocabulary.destroy()
    n, total = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
    index = _index(forward, n, total)
    shared = sc.broadcast((queries, _weights(forward, n, len(queries.vocabulary))))
    numbers = len(queries.ids)
    wanted = _promising(index, shared, seeds).groupBy("part").agg(F.collect_list("q").alias("qs"))  # a query at most once a part
    # `seeds` rows a query of the block at most, so that the index is not shuffled for them
    tried = stored(_visit(index.join(F.broadcast(wanted), "part"), shared, np.zeros(numbers, np.int64), best, True))
    least = np.zeros(numbers, np.int64)
    for q, score in _first(tried, best, "q").where(F.col("rank") == best).select("q", "score").collect():  # a row for each query of the block
        least[q] = score
    rows = stored(_visit(index, shared, least, best, False).withColumn("share", F.spark_partition_id() % 64))
    shared.destroy()
    first = _first(_first(rows, best, "q", "share").drop("rank"), best, "q").drop("share")
    names = docs.sparkSession.createDataFrame([(k, q) for k, q in enumerate(queries.ids)], "_k long, _q long")
    return first.join(F.broadcast(names), F.col("q") == F.col("_k")).select(F.col("_q").alias("q"), "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, seeds: int = SEEDS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the `best` documents of each item with a score above 0."""
    placed, blocks = _blocks(items)
    found = None
    for k in range(blocks):
        block = placed.where(F.col("block") == k)
        if block.isEmpty():
            continue
        rows = _search_block(docs.select("doc_id", "text"), block, best, seeds)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return placed.join(docs.select("doc_id"), F.lit(False)).select("item_id", F.lit(0).alias("rank"), "doc_id", F.lit(0).cast("long").alias("score"))
    return placed.select("q", "item_id").join(found, "q").select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents WHERE text IS NOT NULL
), i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL
), s AS (SELECT count(*) AS n, CAST(sum(len(ws)) AS BIGINT) AS l FROM d WHERE len(ws) > 0),
ds AS (SELECT r, doc_id, 50 + (50 * CAST(len(ws) AS BIGINT) * n) // l AS m FROM d, s WHERE len(ws) > 0),
it AS (SELECT DISTINCT q, unnest(ws) AS term FROM i),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM it) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT n FROM s) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf GROUP BY term),
im AS (SELECT tf.r, tf.term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS impact FROM tf JOIN ds ON tf.r = ds.r JOIN w ON tf.term = w.term),
sc AS (SELECT q, r, CAST(sum(impact) AS BIGINT) AS score FROM it JOIN im ON it.term = im.term GROUP BY q, r HAVING sum(impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM sc JOIN ds ON sc.r = ds.r
) x JOIN i ON x.q = i.q WHERE rank <= 50
"""
