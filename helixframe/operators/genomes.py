"""FASTA lines re-aimed for short-read aligners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mask_headers(text: Column) -> Column:
    """Every line with `>` becomes ten N and joins the next line."""
    return F.regexp_replace(text, r"(?m)^.*>.*(?:\r?\n|\z)", "NNNNNNNNNN")


def repack(lines: DataFrame, chunks: int = 100, width: int = 50) -> DataFrame:
    """(chunk, line_no, line) of (line_no, line): headers as two lines of N, lines filled up with N to `width`, cut into chunks of lines div `chunks`, a header for each.

    Line numbers of the output come from a count of headers before each range of input lines, so no window spans all lines.
    """
    n_lines = lines.count()
    size = max(1, n_lines // chunks)
    head = F.col("line").startswith(">")
    block = F.floor(F.col("line_no") / 100_000)
    heads = lines.groupBy(block.alias("block")).agg(F.count_if(head).alias("heads"))
    before = heads.select("block", (F.sum("heads").over(Window.orderBy("block")) - F.col("heads")).alias("before"))  # one row for 100,000 lines
    inside = F.sum(head.cast("long")).over(Window.partitionBy("block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1))
    placed = lines.withColumn("block", block).join(before, "block").withColumn("at", F.col("line_no") + F.col("before") + F.coalesce(inside, F.lit(0)))
    out = placed.select("at", F.posexplode(F.when(head, F.array(F.lit("N" * width), F.lit("N" * width))).otherwise(F.array(F.when(F.length("line") < width, F.rpad("line", width, "N")).otherwise(F.col("line"))))).alias("k", "line"))
    body = out.select((F.floor((F.col("at") + F.col("k")) / size) + 1).alias("chunk"), ((F.col("at") + F.col("k")) % size + 1).alias("line_no"), "line")
    title = body.select("chunk").distinct().select("chunk", F.lit(0).cast("long").alias("line_no"), F.concat(F.lit(">fake"), F.col("chunk").cast("string")).alias("line"))
    return body.unionByName(title)
