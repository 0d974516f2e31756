"""What the operators of this folder share: table reading, shared storage, text rules."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def words_between(text: Column, gaps: str, lower: bool = False) -> Column:
    """What stands between characters of `gaps`, with A-Z lower-cased on request; none for null.

    The gaps become blanks in the pass that lower-cases, and a split at one blank needs no regular expression.
    """
    upper = string.ascii_uppercase if lower else ""
    even = F.translate(text, upper + gaps, upper.lower() + " " * len(gaps))
    return F.coalesce(F.array_remove(F.split(even, " "), ""), F.array().cast("array<string>"))


def plain_words(text: Column) -> Column:
    """The words between white space; none for null."""
    return words_between(text, BLANKS)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local mode only, a local one where it is unset (tests)."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with files in the shared folder, which outlive any executor; partitions stay as they are."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared folder.

    For loops of joins: the planner knows the table's size, while a checkpoint goes by the estimates of the plan that made it,
    which are products of sizes and have twice as many digits after every join.
    """
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """`df` with `rank`, each row's place from 0 in the given order, nulls first; the working column _at must be free.

    Rows are sorted over range partitions and stored with their place in the partition; what the driver adds up is one count a
    partition. Every key, and every group of equal keys, may be as many partitions as it fills.
    """
    spark = df.sparkSession
    sorted_ = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, local = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    offsets, total = [], 0
    for p, n in sorted((r[0], r[1]) for r in sorted_.groupBy(part.alias("p")).count().collect()):
        offsets.append((p, total))
        total += n
    starts = spark.createDataFrame(offsets, "_part long, _offset long")
    numbered = sorted_.withColumn("_part", part).join(F.broadcast(starts), "_part")  # a row for each partition
    return numbered.withColumn("rank", F.col("_offset") + local).drop("_at", "_part", "_offset")


def as_row(df: DataFrame) -> DataFrame:
    """Puts every column into one struct `row`, so that no working column can clash with a column of the input."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def from_row(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The input's columns again, with those named in `new` replaced."""
    return df.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in columns])
