"""Best rows and places within keys, where one key may hold any share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored


def best_of(rows: DataFrame, key: list[str], order: Column) -> DataFrame:
    """(key, best): the least `order` of each key that has several rows.

    Partial minima leave a row for each key and task to shuffle. The result is a table, so that whoever joins it with `rows` deals
    out both sides for that join alone, or broadcasts it where it is small: rows of a key that has very many are then split among
    tasks (as Spark does for skewed sides), which it cannot do where an aggregate on the key goes straight into the join.
    """
    return stored(rows.groupBy(*key).agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))


def with_best(rows: DataFrame, key: list[str], order: Column) -> DataFrame:
    """`rows` with `best`, the least `order` of the row's key; null where it is the only row. Nulls in keys are equal."""
    best = best_of(rows, key, order).withColumnsRenamed({k: f"_{k}" for k in key})
    same = None
    for k in key:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    return rows.join(best, same, "left").drop(*[f"_{k}" for k in key])


def ranked(df: DataFrame, *order: str | Column) -> DataFrame:
    """`df` with `rank`, each row's place from 0 in the given order; the working columns _at, _part and _offset must be free.

    Rows are sorted over range partitions and stored with their places there; the driver adds up one count a partition.
    """
    placed = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, local = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    offsets, total = [], 0
    for p, n in sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect()):
        offsets.append((p, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("rank", F.col("_offset") + local).drop("_at", "_part", "_offset")  # a row for each partition


def occurrences(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """`df` with `occurrence`, each row's place from 1 among the rows of its key.

    Keys of one row, which is most of them, are not sorted: only rows of repeated keys are ranked, over range partitions.
    """
    repeated = stored(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key))
    if repeated.isEmpty():
        return df.withColumn("occurrence", F.lit(1).cast("long"))
    once = df.join(repeated, key, "left_anti").withColumn("occurrence", F.lit(1).cast("long"))
    many = ranked(df.join(repeated, key, "left_semi"), *key, *order)
    first = stored(many.groupBy(*key).agg(F.min("rank").alias("_first")))
    return once.unionByName(many.join(first, key).withColumn("occurrence", F.col("rank") - F.col("_first") + 1).drop("rank", "_first"))
