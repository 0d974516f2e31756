"""SimHash near-duplicates: fingerprints, a binary-trie self-join of them, and connected components.

Fingerprints are made in Arrow batches (bytes.split, XXH64 of each shingle, bit counts by numpy). From there on rows are
a few numbers wide, and only distinct fingerprints take part in the join.

Two fingerprints that differ in at most BITS bits agree on at least one of BITS + 1 blocks of bits, so each fingerprint
goes to BITS + 1 buckets, one for each block's value, and every link lies inside some bucket. A bucket is a binary trie
(its sorted fingerprints); node pairs are traversed together from (root, root), level by level, with the differing bits
added up, and a pair is pruned when these exceed BITS. Two more prunings keep dense groups cheap without losing a link
that matters: links to one-bit neighbours and to the next fingerprint in order are taken first, and a node pair all of
whose fingerprints already are in one component is left out, since no link there could join anything. Small node pairs
are compared outright. A bucket's result is a star of links for each of its components, at most one row a fingerprint.

A bucket of more than HOT fingerprints (a large group of near copies) is never given to one task: its fingerprints are
dealt again by the blocks of the bits that are still free, as often as needed. Free bits run out after a few rounds, and
so many distinct fingerprints cannot agree on all others, so this ends.

Components are the fixed point of large-star and small-star steps over the links (each a min-aggregation and a join),
stored in the shared folder at each round. The aggregates are stored before they are joined, so that both sides
of a join are dealt out for it alone and Spark can split the rows of a large component among tasks.

Defined cases: null or blank text has fingerprint zero and links like any other. component_id is the smallest non-null
doc_id of the component, or null if there is none. Repeated rows each get a row. Columns other than doc_id and text are
not read; near_dedup() passes them through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_row, from_row, stored, table

SHINGLE = 4
BITS = 4
#: Distinct fingerprints of one bucket that one task may get. The traversal's work grows almost with the square of a bucket
#: of unrelated fingerprints (2,000 took 9 s on one slow core, 8,000 took 116 s), while dealing out again costs a few rows each.
HOT = 2_000
#: Node pairs of at most so many comparisons are compared outright.
LEAF = 64
#: Rows that a task gathers before it works through whole buckets.
GATHER = 200_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return sign_bits(np.fromiter((digest(joined[a:b], 42) for a, b in cuts), np.uint64, len(words) - width + 1))


def sign_bits(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        ones += np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(0)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())])
    return docs.select(F.col("text").cast("string"), "doc_id").mapInArrow(run, schema)


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _union(comp: np.ndarray, a: np.ndarray, b: np.ndarray, used: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """Components (labels are smallest members) after the links a-b; a link for each two components that these join goes to `used`."""
    while len(a):
        x, y = comp[a], comp[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        if not len(a):
            break
        if used is not None:
            one = np.unique(np.minimum(x, y) * len(comp) + np.maximum(x, y), return_index=True)[1]
            used.append((a[one], b[one]))
            used = None
        parent = np.arange(len(comp))
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        comp = _roots(parent)[comp]
    return comp


def _near(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= bits


def trie_components(bucket: np.ndarray, fp: np.ndarray, bits: int = BITS, used: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """For rows sorted by (bucket, fp), distinct: the index of the first row of each row's component in its bucket.

    `used` gets pairs of rows within `bits` bits that join these components.
    """
    n = len(fp)
    comp = np.arange(n)
    same = bucket[1:] == bucket[:-1]
    at = np.flatnonzero(same & _near(fp[1:], fp[:-1], bits))
    comp = _union(comp, at, at + 1, used)
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    ends = np.append(starts[1:], n)
    size = ends - starts
    big = np.repeat(size, size) > LEAF
    if big.any():  # one-bit neighbours, by position in (bucket, fp) order
        rows = np.flatnonzero(big)
        order = np.repeat(np.arange(len(starts)), size)
        lo, hi = starts[order[rows]], ends[order[rows]]
        for bit in range(64):
            want = fp[rows] ^ np.uint64(1 << bit)
            a, b = lo.copy(), hi.copy()
            while (a < b).any():
                mid = (a + b) // 2
                low = (a < b) & (fp[np.minimum(mid, n - 1)] < want)
                a, b = np.where(low, mid + 1, a), np.where(low | (a >= b), b, mid)
            hit = (a < hi) & (fp[np.minimum(a, n - 1)] == want)
            comp = _union(comp, rows[hit], a[hit], used)
    # the traversal: node pairs (a0, a1) x (b0, b1), depth, bits that differ so far
    alone = size > 1
    z = np.zeros(int(alone.sum()), np.int64)
    stack = [(starts[alone], ends[alone], starts[alone], ends[alone], z, z)]
    while stack:
        a0, a1, b0, b1, depth, diff = stack.pop()
        if len(a0) > 50_000:
            half = len(a0) // 2
            stack += [tuple(v[half:] for v in (a0, a1, b0, b1, depth, diff)), tuple(v[:half] for v in (a0, a1, b0, b1, depth, diff))]
            continue
        change = np.append(np.flatnonzero(comp[1:] != comp[:-1]) + 1, n)  # ends of runs of one component
        upto = lambda i: change[np.searchsorted(change, i, "right")]
        open_ = ~((upto(a0) >= a1) & (upto(b0) >= b1) & (comp[a0] == comp[b0]))
        a0, a1, b0, b1, depth, diff = (v[open_] for v in (a0, a1, b0, b1, depth, diff))
        work = (a1 - a0) * (b1 - b0)
        leaf = (work <= LEAF) | (depth == 64)
        if leaf.any():
            k = np.repeat(np.flatnonzero(leaf), work[leaf])
            nth = np.arange(len(k)) - np.repeat(np.cumsum(work[leaf]) - work[leaf], work[leaf])
            width = (b1 - b0)[k]
            i, j = a0[k] + nth // width, b0[k] + nth % width
            hit = (i < j) & _near(fp[i], fp[j], bits)
            comp = _union(comp, i[hit], j[hit], used)
        a0, a1, b0, b1, depth, diff = (v[~leaf] for v in (a0, a1, b0, b1, depth, diff))
        if not len(a0):
            continue
        bit = np.uint64(63) - depth.astype(np.uint64)
        half_a, half_b = _split(fp, a0, a1, bit), _split(fp, b0, b1, bit)
        twin = (a0 == b0) & (a1 == b1)
        pairs = [(a0, half_a, b0, half_b, depth, diff, None), (half_a, a1, half_b, b1, depth, diff, None), (a0, half_a, half_b, b1, depth, diff + 1, None), (half_a, a1, b0, half_b, depth, diff + 1, ~twin)]
        for p0, p1, q0, q1, d, f, only in pairs:
            go = (p1 > p0) & (q1 > q0) & (f <= bits)
            if only is not None:
                go &= only
            if go.any():
                stack.append((p0[go], p1[go], q0[go], q1[go], d[go] + 1, f[go]))
    return comp


def _split(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """First index in [lo, hi) whose `bit` is set; all higher bits are equal there."""
    a, b, top = lo.copy(), hi.copy(), len(fp) - 1
    while (a < b).any():
        mid = (a + b) // 2
        low = (a < b) & ((fp[np.minimum(mid, top)] >> bit & np.uint64(1)) == 0)
        a, b = np.where(low, mid + 1, a), np.where(low | (a >= b), b, mid)
    return a


def _bucket_links(bits: int, direct: bool):
    """Tasks' rows (bucket, fp), sorted, to links (a, b); whole buckets only."""

    def work(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        used: list[tuple[np.ndarray, np.ndarray]] | None = [] if direct else None
        comp = trie_components(bucket, fp, bits, used)
        a = np.flatnonzero(comp != np.arange(len(comp)))
        b = comp[a]
        if direct:
            a, b = (np.concatenate([x[k] for x in used]) if used else a[:0] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, fps, held = [], [], 0
        for batch in batches:
            buckets.append(batch.column(0).to_numpy())
            fps.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held >= GATHER:
                bucket, fp = np.concatenate(buckets), np.concatenate(fps)
                cut = int(np.flatnonzero(bucket == bucket[-1])[0])
                if cut:
                    yield work(bucket[:cut], _ordered(bucket[:cut], fp[:cut]))
                buckets, fps, held = [bucket[cut:]], [fp[cut:]], len(bucket) - cut
        if held:
            bucket = np.concatenate(buckets)
            yield work(bucket, _ordered(bucket, np.concatenate(fps)))

    return run


def _ordered(bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Fingerprints of rows that are together by bucket, in unsigned order inside each."""
    run = np.cumsum(np.concatenate([[0], bucket[1:] != bucket[:-1]]))
    fp = fp.view(np.uint64)
    return fp[np.lexsort((fp, run))]


def _deal(df: DataFrame, bits: int) -> DataFrame:
    """(mask, value, fp) to the finer buckets of the `bits` + 1 blocks of the bits that are not in mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, value, fp = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            for m in np.unique(mask):
                mine = mask == m
                free = [b for b in range(64) if not int(m) >> b & 1]
                for k in range(bits + 1):
                    block = sum(1 << b for b in free[k * len(free) // (bits + 1) : (k + 1) * len(free) // (bits + 1)])
                    new = np.uint64(int(m) | block)
                    parts = (np.full(int(mine.sum()), new), fp[mine] & new, fp[mine])
                    yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)) for p in parts], ["mask", "value", "fp"])

    return df.mapInArrow(run, "mask long, value long, fp long")


def links(distinct: DataFrame, bits: int = BITS, hot: int = HOT, direct: bool = False) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` that have the same components as all links of at most `bits` bits.

    The links are stars, at most a row for each fingerprint and bucket; with `direct`, each is of at most `bits` bits itself.
    """
    left = distinct.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"), "fp")
    found = None
    while True:
        left = stored(_deal(left, bits) if found is None else _deal(left, bits).distinct())
        free = 64 - F.bit_count("mask")  # of no more than `bits` free bits, all of a bucket's fingerprints link
        crowded = left.groupBy("mask", "value").count().where((F.col("count") > hot) & (free > bits)).select("mask", "value")
        crowded = stored(crowded)
        some = not crowded.isEmpty()
        whole = left.join(crowded, ["mask", "value"], "left_anti") if some else left
        bucket = F.xxhash64("mask", "value")
        # a number of its own, since the work is in the pairs and tasks coalesced by their few bytes would be long
        tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = whole.select(bucket.alias("bucket"), "fp").repartition(tasks, "bucket").sortWithinPartitions("bucket")
        got = dealt.mapInArrow(_bucket_links(bits, direct), "a long, b long")
        found = got if found is None else found.unionByName(got)
        if not some:
            break
        left = left.join(crowded, ["mask", "value"], "left_semi")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of edges (a, b): every node that has one, and the smallest node of its component."""
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        # large star: a node's larger neighbours link to its smallest one
        large = now.select(F.col("v").alias("x"), F.col("u").alias("y")).join(least, F.col("x") == F.col("u")).where(F.col("y") > F.col("m")).select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        # small star: its smaller neighbours and the node itself do
        large = stored(large)
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        now = stored(small)
        after = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("u")).first()
        if after[0] == after[2] and after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def least_of_component(distinct: DataFrame, value: str, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """(fp, least): of distinct fingerprints `fp` with a `value` each, the least value of the fingerprint's component."""
    member = components(links(distinct.select("fp"), bits, hot))
    rooted = stored(distinct.join(member, F.col("fp") == F.col("node"), "left").select("fp", F.col(value).alias("value"), F.coalesce("root", "fp").alias("root")))
    least = stored(rooted.groupBy("root").agg(F.min("value").alias("least")))
    return rooted.join(least, "root").select("fp", "least")


def near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id; a row for each row of docs."""
    prints = stored(fingerprints(docs.select("doc_id", "text"), shingle))
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    named = least_of_component(first, "first", bits, hot).select("fp", F.col("least").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """Of each component one row stays, with all its columns: the smallest doc_id, then the smallest hash of the row.

    Rows of one doc_id whose texts are no near duplicates are rows of different components. Rows without doc_id link others
    but cannot be named, so all of them stay. Rows equal in every column are one row.
    """
    wide = as_row(docs).select("row", F.xxhash64("row").alias("tie"))
    named = F.struct(F.col("row")["doc_id"].alias("doc_id"), F.col("tie").alias("tie"))
    prints = stored(fingerprints(wide.select(named.alias("doc_id"), F.col("row")["text"].alias("text")), shingle))
    known = F.min(F.when(F.col("doc_id.doc_id").isNotNull(), F.col("doc_id"))).alias("first")
    stay = least_of_component(stored(prints.groupBy("fp").agg(known)), "first", bits).where("least IS NOT NULL").select("least.doc_id", "least.tie").distinct()
    rows = wide.select("row", F.col("row")["doc_id"].alias("doc_id"), "tie")
    kept = rows.join(stay, ["doc_id", "tie"], "left_semi").dropDuplicates(["doc_id", "tie"]).select("row")
    return from_row(kept.unionByName(rows.where(F.col("doc_id").isNull()).select("row")), docs.columns)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
