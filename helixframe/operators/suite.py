"""Calculators that share one scan: each adds up its own state in a common aggregation, and makes its metrics of the sums.

A calculator's state is a row of numbers for each key and place: sums that start at 0 and greatest values that start at nothing.
What a read adds to it are `rows`, and `letters`, texts of which each letter counts at its position. Both are columns of the reads,
so all calculators' additions are one explode, one partial and one final aggregation, with a row for each key and task
between them. The sums are a small table, and `finish` sees only that.

    Calculator("gc", rows=lambda r: [Row(F.col("rname"), sums=[gc_bases, bases])], finish=lambda t: t.select(F.col("key").alias("rname"), ...))
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reads as R
from ..sources.shared import stored
from . import metrics as M

#: Numbers of a state.
SUMS, HIGHS = 9, 2


@dataclass
class Row:
    """What a read adds at (key, at): `sums` are added, of `highs` the greatest stay; nothing where `when` does not hold."""

    key: Column
    sums: list[Column]
    highs: list[Column] | None = None
    at: Column | None = None
    when: Column | None = None


@dataclass
class Letters:
    """A text of which each letter counts at (key, its position from 0): in the state's rows `letter` is set and sum_0 the count. With `only`, that letter alone."""

    key: Column
    text: Column
    when: Column | None = None
    only: str | None = None


@dataclass
class Calculator:
    """`rows` gives what a read adds; `finish` makes the metrics of the state (key, at, letter, sum_0..., high_0...), any number of rows."""

    name: str
    rows: Callable[[DataFrame], list[Row | Letters]]
    finish: Callable[[DataFrame], DataFrame]


def state(reads: DataFrame, calculators: list[Calculator]) -> DataFrame:
    """(calculator, key, at, letter, sum_0..., high_0...) of all calculators: one scan of `reads`, stored."""
    long = lambda c: (F.lit(None) if c is None else c).cast("long")
    parts = []
    for n, calculator in enumerate(calculators):
        for entry in calculator.rows(reads):
            is_row = isinstance(entry, Row)
            sums, highs = (entry.sums, entry.highs or []) if is_row else ([], [])
            if len(sums) > SUMS or len(highs) > HIGHS:
                raise ValueError(f"calculator {calculator.name} has more than {SUMS} sums or {HIGHS} greatest values in a row")
            cells = [long(sums[k] if k < len(sums) else None).alias(f"s{k}") for k in range(SUMS)] + [long(highs[k] if k < len(highs) else None).alias(f"h{k}") for k in range(HIGHS)]
            text = F.lit(None).cast("string") if is_row else entry.text
            row = F.struct(F.lit(n).alias("c"), entry.key.cast("string").alias("key"), long(entry.at if is_row else None).alias("at"), text.alias("text"), F.lit(None if is_row else entry.only).cast("string").alias("only"), *cells)
            parts.append(row if entry.when is None else F.when(entry.when, row))
    exploded = reads.select(F.explode(F.array_compact(F.array(*parts))).alias("e"))
    # a text has a row a letter, everything else is one row with an empty letter
    spread = exploded.select("e", F.posexplode(F.when(F.col("e.text").isNull(), F.array(F.lit(""))).otherwise(F.split("e.text", ""))).alias("pos", "letter"))
    is_text = F.col("e.text").isNotNull()
    wanted = F.col("e.only").isNull() | (F.col("letter") == F.col("e.only"))
    keys = [F.col("e.c").alias("c"), F.col("e.key").alias("key"), F.when(is_text, F.col("pos").cast("long")).otherwise(F.col("e.at")).alias("at"), F.when(is_text, F.col("letter")).alias("letter")]
    first = F.sum(F.when(is_text, F.lit(1).cast("long")).otherwise(F.col("e.s0"))).alias("sum_0")
    got = spread.where(wanted).groupBy(*keys).agg(first, *[F.sum(f"e.s{k}").alias(f"sum_{k}") for k in range(1, SUMS)], *[F.max(f"e.h{k}").alias(f"high_{k}") for k in range(HIGHS)])
    names = F.array(*[F.lit(c.name) for c in calculators])
    return stored(got.select(F.get(names, F.col("c")).alias("calculator"), "key", "at", "letter", *[c for c in got.columns if c.startswith(("sum_", "high_"))]))


def _one(c: Column) -> Column:
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def _alignment(reads: DataFrame) -> list[Row]:
    mapped, dup, bases = ~F.col("unmapped"), F.col("dup"), F.length("seq")
    miss = F.when(mapped, R.mismatches())
    none = F.lit(0)
    cells = [F.lit(1), _one(mapped), _one(~mapped), _one(mapped & dup), _one(F.coalesce(miss == 0, F.lit(False))), bases, bases - R.n_count(), F.coalesce(miss, none.cast("long")), F.when(mapped, bases).otherwise(none)]
    return [Row(R.read_type(), cells, when=R.read_type().isNotNull())]


def _alignment_metrics(state: DataFrame) -> DataFrame:
    names = ["total_reads", "mapped_reads", "unmapped_reads", "dup_reads", "exact_reads", "total_bases", "valid_bases", "mismatches", "mapped_bases"]
    return M.with_alignment_shares(state.select(F.col("key").alias("read_type"), *[F.col(f"sum_{k}").alias(n) for k, n in enumerate(names)]))


def _pairs(reads: DataFrame) -> list[Row]:
    um, mm = F.col("unmapped"), F.col("mate_unmapped")
    cells = [F.lit(1), *(_one(c) for c in (um & mm, ~um & ~mm, ~um & ~mm & R.same_chr_pair(), ~um & mm, um & ~mm))]
    return [Row(F.lit(""), cells, when=F.col("paired") & (F.col("read_no") != 1))]


def _pair_metrics(state: DataFrame) -> DataFrame:
    names = ["pairs", "both_unmapped", "both_mapped", "both_mapped_same_chr", "only_read2_mapped", "only_read1_mapped"]
    return M.with_pair_shares(state.agg(*[F.coalesce(F.sum(f"sum_{k}"), F.lit(0)).alias(n) for k, n in enumerate(names)]))


def _sizes(reads: DataFrame) -> list[Row]:
    return [Row(R.pair_orientation(), [F.lit(1)], at=F.abs("tlen"), when=R.insert_size_eligible())]


def _histogram(state: DataFrame) -> DataFrame:
    return state.select(F.col("key").alias("orientation"), F.col("at").alias("size"), F.col("sum_0").alias("pairs"))


def _qualities(reads: DataFrame) -> list[Letters]:
    chars = F.when(F.col("neg"), F.reverse("qual")).otherwise(F.col("qual"))
    return [Letters(F.when(F.col("paired") & (F.col("read_no") == 2), 2).otherwise(1), chars, when=F.col("qual") != "*")]


def _quality_metrics(state: DataFrame) -> DataFrame:
    got = state.groupBy(F.col("key").cast("int").alias("series"), (F.col("at") + 1).cast("int").alias("position")).agg(F.sum((F.ascii("letter") - 33) * F.col("sum_0")).alias("quality_sum"), F.sum("sum_0").alias("n"))
    return M.quality_grid(got)


def _n_content(reads: DataFrame) -> list[Row | Letters]:
    text = F.upper("seq")
    return [Row(F.col("read_no"), [F.lit(1)], highs=[F.length("seq")]), Letters(F.col("read_no"), text, when=text.contains("N"), only="N")]


def _n_metrics(state: DataFrame) -> DataFrame:
    reads = state.where(F.col("letter").isNull()).select(F.col("key").cast("int").alias("read_no"), F.col("sum_0").alias("total"), "high_0")
    longest = reads.agg(F.max("high_0").alias("n")).where(F.col("n") > 0).select(F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("start"))
    counts = state.where(F.col("letter").isNotNull()).select(F.col("key").cast("int").alias("read_no"), F.col("at").cast("int").alias("start"), F.col("sum_0").alias("n"))
    return M.n_grid(reads.select("read_no", "total"), counts, longest)


#: The calculators by name; of a plain function DataFrame -> DataFrame nothing can be shared, so it scans the reads by itself.
CALCULATORS: dict[str, Calculator | Callable[[DataFrame], DataFrame]] = {
    c.name: c
    for c in (
        Calculator("alignment", _alignment, _alignment_metrics), Calculator("pairs", _pairs, _pair_metrics), Calculator("insert_size", _sizes, lambda t: M.insert_size_metrics(_histogram(t))),
        Calculator("insert_size_histogram", _sizes, _histogram), Calculator("quality", _qualities, _quality_metrics), Calculator("n_content", _n_content, _n_metrics),
    )
}


def register(name: str, calculator: Calculator | Callable[[DataFrame], DataFrame]) -> None:
    CALCULATORS[name] = calculator


def register_sql(spark: SparkSession, name: str, partial: Callable[[pa.Table], pa.Table], state: str) -> None:
    """Makes `partial` a table function of SQL, for a calculator whose state needs code of its own.

    It is called with an Arrow batch of the rows at a time, where they are, and gives their state as a table of the columns `state`
    (a DDL text). Nothing is kept from batch to batch, so states come in parts, and the query that asks for them merges those:

        SELECT key, sum(n) AS n FROM name(TABLE(SELECT ... FROM reads)) GROUP BY key

    Spark adds up the parts of a task before it shuffles them. An empty table gives no parts; a batch may give an empty state.
    """

    class Partial:
        def eval(self, batch):
            yield partial(pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch)

    spark.udtf.register(name, F.arrow_udtf(Partial, returnType=state))


def metric_suite(reads: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(calculator, metric, value) of all calculators, or those named; one scan of `reads` serves all that are a Calculator.

    A metric's name is its keys (text columns, and size, series, position and read_no) and its column's name.
    """
    chosen = {n: CALCULATORS[n] for n in names or CALCULATORS}
    shared = [c for c in chosen.values() if isinstance(c, Calculator)]
    sums = state(reads, shared) if shared else None
    out = None
    for name, calculator in chosen.items():
        if isinstance(calculator, Calculator):
            got = calculator.finish(sums.where(F.col("calculator") == calculator.name).drop("calculator"))
        else:
            got = calculator(reads)
        keys = [f.name for f in got.schema.fields if f.dataType.simpleString() == "string" or f.name in ("size", "series", "position", "read_no")]
        values = [c for c in got.columns if c not in keys]
        label = lambda c, keys=keys: F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.lit(c))
        rows = got.select(F.explode(F.array(*[F.struct(label(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])).alias("v"))
        rows = rows.select(F.lit(name).alias("calculator"), "v.metric", "v.value")
        out = rows if out is None else out.unionByName(rows)
    return out
