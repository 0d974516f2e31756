"""Overlap joins of intervals through levels of bins of growing width.

An interval belongs to the first level whose bins are at least as wide as it is long, so it touches two bins there at most,
however long it is. Two intervals meet on the coarser one of their levels: each side's rows are dealt to its own level, and once
more to those coarser levels that the other side uses, so an interval is two rows for each level in use at most, and most
are one. On the level where they meet one of the two is at least a quarter as long as a bin, so what shares a bin
nearly always overlaps, and a crowded place makes few rows beside its results. Bins meet by an equi-join with an exchange on both
sides, which Spark splits where one bin has very many rows. Where many pairs come of few rows, sizes in bytes say nothing about
the work: pairs are added up by bin first, and crowded bins are dealt out as cells of a bounded number of pairs, by place inside each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import small, stored

#: Pairs that a task looks at where bins are dealt out as cells, rows of a side in a cell, and the pairs a row of the left side from which on they are.
TASK_PAIRS, CELL_ROWS, CROWDED = 16_000_000, 4096, 16
#: Width of the finest bins, if none is given, and how much wider those of the next level are.
FINEST, WIDER, LEVELS = 64, 4, 14


def level(start: Column, end: Column, finest: int = FINEST) -> Column:
    """The first level whose bins are at least as wide as the interval, the last one for longer ones; null if it is none."""
    out = F.when(end >= start, F.lit(LEVELS - 1))
    for k in range(LEVELS - 2, -1, -1):
        out = F.when((end - start).between(0, finest * WIDER**k - 1), F.lit(k)).otherwise(out)
    return out


def _width(at: Column, finest: int) -> Column:
    return F.get(F.array(*[F.lit(finest * WIDER**k).cast("long") for k in range(LEVELS)]), at)


def _places(side: DataFrame, contig: str, start: str, finest: int) -> DataFrame:
    """(contig, _level, start, _n): how many intervals begin in each bin of their own level, `start` being the bin's first position."""
    width = _width(F.col("_level"), finest)
    began = (F.floor(F.col(start) / width) * width).alias(start)
    return stored(side.where(F.col("_level").isNotNull() & F.col(contig).isNotNull()).groupBy(contig, "_level", began).agg(F.count(F.lit(1)).alias("_n")), "places")


def _used(places: DataFrame) -> list[int]:
    """The levels in use, ascending; LEVELS at most."""
    return sorted(r[0] for r in places.select("_level").distinct().collect())


def _dealt(side: DataFrame, start: str, end: str, kinds: list[tuple[int, Column, Column]], finest: int = FINEST) -> DataFrame:
    """A row for each bin that the interval touches on each level it is dealt to: _kind, _on (the level), _bin, and _first, the first such bin.

    kinds: (kind, level, whether to deal it there).
    """
    bin_of = lambda c, at: F.floor(F.col(c) / _width(at, finest))
    places = [F.when(there, F.struct(F.lit(kind).alias("kind"), at.alias("on"), bin_of(start, at).alias("first"), bin_of(end, at).alias("last"))) for kind, at, there in kinds]
    on = side.withColumn("_p", F.explode(F.array_compact(F.array(*places))))
    on = on.withColumn("_bin", F.explode(F.sequence("_p.first", "_p.last")))
    return on.withColumns({"_kind": F.col("_p.kind"), "_on": F.col("_p.on"), "_first": F.col("_p.first")}).drop("_p", "_level")


def interval_join(left: DataFrame, right: DataFrame, contig: str, of_left: tuple[str, str], of_right: tuple[str, str], finest: int = FINEST) -> DataFrame:
    """Every pair of rows with equal `contig` whose closed intervals (start, end) overlap, once; columns of both sides.

    Column names must differ but for `contig`. Rows with a null in it or an end, and intervals that end before they start, overlap nothing.
    """
    left, right = (df.withColumn("_level", level(F.col(a), F.col(b), finest)) for df, (a, b) in ((left, of_left), (right, of_right)))
    here, there = _places(left, contig, of_left[0], finest), _places(right, contig, of_right[0], finest)
    in_left, in_right = _used(here), _used(there)
    own = F.col("_level")
    # kind 0 meets where the right interval's level is the coarser one or the same, kind 1 where the left one's is
    finer = F.lit(in_right[0] if in_right else LEVELS) < own
    of_one = [*((0, F.lit(k), own <= k) for k in in_right), (1, own, finer)]
    of_two = [(0, own, own.isNotNull()), *((1, F.lit(k), own < k) for k in in_left)]
    one = _dealt(left, *of_left, of_one, finest)
    two = _dealt(right, *of_right, of_two, finest).withColumnRenamed("_first", "_first_r")
    key = [contig, "_kind", "_on", "_bin"]
    at = lambda places, start, kinds, n: _dealt(places, start, start, kinds, finest).groupBy(*key).agg(F.sum("_n").alias(n))
    work = at(here, of_left[0], of_one, "_a").join(at(there, of_right[0], of_two, "_b"), key)
    pairs, rows = work.agg(F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0)), F.coalesce(F.sum("_a"), F.lit(0))).first()
    if pairs > max(TASK_PAIRS, CROWDED * rows):
        cells = lambda n: F.ceil(F.col(n) / CELL_ROWS).cast("int")
        cut = small(stored(work.select(*key, cells("_a").alias("_a"), cells("_b").alias("_b")).where("_a > 1 OR _b > 1"), "cells"))
        one, two = (_celled(df, cut, key, *own_cells) for df, own_cells in ((one, ("_a", "_b")), (two, ("_b", "_a"))))
        key += ["_a", "_b"]
        tasks = int(pairs // TASK_PAIRS) + 1
        one, two = _in_order(one.repartition(tasks, *key), key, of_left, "_at"), _in_order(two.repartition(tasks, *key), key, of_right, "_at_r")
    both = one.join(two, key)
    overlap = (F.col(of_left[0]) <= F.col(of_right[1])) & (F.col(of_left[1]) >= F.col(of_right[0])) & (F.col("_bin") == F.greatest("_first", "_first_r"))
    if "_at" in both.columns:
        overlap &= (F.col("_at") > 0) & (F.col("_at_r") > 0)
    return both.where(overlap).drop("_kind", "_on", "_bin", "_first", "_first_r", "_a", "_b", "_at", "_at_r")


def _in_order(side: DataFrame, key: list[str], ends: tuple[str, str], at: str) -> DataFrame:
    """The rows of each cell by their places, numbered (`at`) from 1, so that pairs come in runs that a file holds in few bytes.

    The numbers keep that order: a plain sort below a join is taken out by the optimizer.
    """
    return side.withColumn(at, F.row_number().over(Window.partitionBy(*key).orderBy(*ends)))


def _celled(side: DataFrame, cut: DataFrame, key: list[str], own: str, other: str) -> DataFrame:
    """A row of `side` for each cell of its bin that it belongs to: one part of its own side, by its values, and every part of the other."""
    mine = F.pmod(F.xxhash64(*[c for c, kind in side.dtypes if "map<" not in kind]), F.coalesce(own, F.lit(1))).cast("int")
    found = side.join(cut, key, "left").withColumn(own, mine)
    return found.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))


def merged(side: DataFrame, contig: str, start: str, end: str, bin_size: int = 1024) -> DataFrame:
    """(contig, start, end): the union of closed intervals as disjoint ones that do not touch.

    A position belongs to it where more intervals have opened than closed. Events are summed by position and add up inside bins,
    on top of what is open before them; the window over a contig's bins has a row for each bin_size positions of it at most.
    """
    ends = F.array(F.struct(F.col(start).cast("long").alias("at"), F.lit(1).alias("d")), F.struct((F.col(end) + 1).cast("long").alias("at"), F.lit(-1).alias("d")))
    events = side.where((F.col(end) >= F.col(start)) & F.col(contig).isNotNull()).select(contig, F.explode(ends).alias("e"))
    steps = events.groupBy(contig, F.floor(F.col("e.at") / bin_size).alias("_bin"), F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"))
    along, inside = Window.partitionBy(contig).orderBy("_bin"), Window.partitionBy(contig, "_bin").orderBy("at")
    before = F.coalesce(F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = steps.groupBy(contig, "_bin").agg(F.sum("d").alias("d")).select(contig, "_bin", before.alias("before"))
    up = F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    level = steps.select(contig, "_bin", "at", "d", up.alias("up")).join(bins, [contig, "_bin"]).withColumn("open", F.col("up") + F.col("before"))
    edges = level.where((F.col("open") == 0) != (F.col("open") == F.col("d"))).select(contig, "_bin", "at", "open", F.lead("at").over(inside).alias("until"))
    later = edges.groupBy(contig, "_bin").agg(F.min("at").alias("first")).select(contig, "_bin", F.lead("first").over(along).alias("next"))
    return edges.join(later, [contig, "_bin"]).where(F.col("open") > 0).select(contig, F.col("at").alias(start), (F.coalesce("until", "next") - 1).alias(end))
