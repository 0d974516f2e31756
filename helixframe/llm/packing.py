"""Packing by length: optimal buckets, then batches of a token budget.

The lengths' histogram over all documents is one aggregation. Dynamic programming over its bins chooses the bucket
boundaries for which padding every document to its bucket's boundary adds the fewest tokens. Documents are then sorted
over the cluster by (bucket, length, doc_id), numbered by partition offsets, and cut into batches whose rows times
boundary stay within the budget. No bucket is gathered anywhere: a hot bucket is many sorted partitions.

Every length is a bin of its own, so the padding is the least there is. The histogram has a bound without rounding: k distinct
lengths need k * (k - 1) / 2 tokens at least, so documents of T tokens together have at most 1 + sqrt(2 T) of them (4.5
million rows of two numbers for 10 ** 13 tokens), and all that the driver does grows with that root.

Defined cases: null text has length 0 and is packed with a boundary of 0. A document longer than the budget is a batch
of its own. Ties are ordered by doc_id, then by text hash; equal rows get places of their own. Empty input gives no row.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import bisect
from array import array as numbers

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, plain_words, table

BUCKETS = 16
BUDGET = 65_536


def boundaries(ends: list[int], counts: list[int], buckets: int = BUCKETS) -> list[int]:
    """The at most `buckets` ends for which sum(count * (boundary - end)) is least; ends ascending.

    f[k][j] = min over i < j of f[k-1][i] + ends[j] * (n[j] - n[i]): lines in ends[j], whose slopes -n[i] fall while the
    ends rise, so that each layer is one pass over a lower hull.
    """
    n = np.concatenate([[0], np.cumsum(np.array(counts, dtype=object))]).tolist()
    last = [0] + [None] * len(ends)
    back: list[numbers] = []
    best, layers = None, 0
    for k in range(min(buckets, len(ends))):
        now: list[int | None] = [None] * (len(ends) + 1)
        came = numbers("i", bytes(4 * (len(ends) + 1)))
        hull: list[tuple[int, int, int]] = []  # slope, value at 0, i
        at = 0
        for j in range(1, len(ends) + 1):
            if last[j - 1] is not None:
                line = (-n[j - 1], last[j - 1], j - 1)
                while len(hull) >= 2 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            if hull:
                x = ends[j - 1]
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                    at += 1
                now[j], came[j] = hull[at][0] * x + hull[at][1] + x * n[j], hull[at][2]
        back.append(came)
        if best is None or now[-1] < best:
            best, layers = now[-1], k + 1
        last = now
    out, j = [], len(ends)
    for k in range(layers - 1, -1, -1):
        out.append(ends[j - 1])
        j = back[k][j]
    return out[::-1]


def token_counts(text: Column) -> Column:
    """The default length: words between white space."""
    return F.size(plain_words(text)).cast("long")


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_len, batch_id, slot: each document's place in a batch padded to bucket_len.

    `length` is a column expression over `docs` for the tokens of a document.
    """
    spark = docs.sparkSession
    n = F.coalesce(token_counts(F.col("text")) if length is None else length.cast("long"), F.lit(0).cast("long"))
    sized = checkpoint(docs.select("doc_id", n.alias("n_tokens"), F.xxhash64("text").alias("tie")))
    histogram = sized.groupBy("n_tokens").count().toArrow().sort_by("n_tokens")  # a row for each distinct length
    lengths, counts = (histogram.column(c).to_pylist() for c in ("n_tokens", "count"))
    ends = boundaries(lengths, counts, buckets)
    inside = [0] * len(ends)
    for b, c in zip(lengths, counts, strict=True):
        inside[bisect.bisect_left(ends, b)] += c
    rows_in = [max(1, budget // max(1, e)) for e in ends]
    first_row, first_batch = [0], [0]
    for c, r in zip(inside, rows_in, strict=True):
        first_row.append(first_row[-1] + c)
        first_batch.append(first_batch[-1] + -(-c // r))
    array = lambda values: F.array(*[F.lit(v).cast("long") for v in values or [0]])
    bucket = F.size(F.filter(array(ends), lambda e: e < F.col("n_tokens")))
    ordered = checkpoint(sized.select("doc_id", "n_tokens", bucket.alias("bucket"), "tie").orderBy("bucket", "n_tokens", "doc_id", "tie"))
    placed = ordered.withColumn("at", F.monotonically_increasing_id())
    part, local = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect())  # a row for each partition
    offsets, total = [], 0
    for p, c in sizes:
        offsets.append((p, total))
        total += c
    starts = spark.createDataFrame(offsets, "p long, offset long")
    numbered = placed.select("*", part.alias("p"), local.alias("local")).join(F.broadcast(starts), "p")
    b = F.col("bucket")
    rank = F.col("offset") + F.col("local") - F.get(array(first_row), b)
    numbered = numbered.select("doc_id", "n_tokens", "bucket", F.get(array(ends), b).alias("bucket_len"), rank.alias("rank"), F.get(array(rows_in), b).alias("rows_in"), F.get(array(first_batch), b).alias("first"))
    return numbered.select(
        "doc_id", "n_tokens", "bucket", "bucket_len", (F.col("first") + F.floor(F.col("rank") / F.col("rows_in"))).alias("batch_id"),
        (F.col("rank") % F.col("rows_in")).alias("slot"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
