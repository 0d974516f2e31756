"""Interval joins, best rows of a key and places within keys: results, and how a hot key or bin is dealt out."""

import contextlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helixframe.operators import intervals, keyed
from helixframe.operators import reads as O
from helixframe.sources import sequences

SKEWED = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def frames(spark, left, right):
    return spark.createDataFrame(left, "a int, chr string, s long, e long"), spark.createDataFrame(right, "b int, chr string, low long, high long")


def joined(spark, left, right):
    got = intervals.interval_join(*frames(spark, left, right), "chr", ("s", "e"), ("low", "high")).select("a", "b").collect()
    return sorted(tuple(r) for r in got)


def plain(left, right):
    return sorted((a, b) for a, c, s, e in left for b, d, low, high in right if None not in (c, s, e, d, low, high) and c == d and s <= e and low <= high and s <= high and e >= low)


def test_intervals_of_all_lengths_meet_once(spark):
    rng = random.Random(7)
    lengths = [1, 2, 63, 64, 65, 255, 256, 257, 4096, 100_000, 4_000_000, 250_000_000]

    def some(n):
        out = []
        for k in range(n):
            start, size = rng.randrange(-200, 5_000_000), rng.choice(lengths)
            out.append((k, f"c{rng.randrange(2)}", start, start + size - 1))
        return out

    left, right = some(150), some(150)
    left += [(900, "c1", 10, 9), (901, None, 1, 5), (902, "c1", None, 5), (903, "c1", 64, 64), (904, "c1", 63, 64)]
    right += [(900, "c1", 10, 9), (901, None, 1, 5), (902, "c1", 1, None), (903, "c1", 64, 64), (904, "c1", 0, 63)]
    assert joined(spark, left, right) == plain(left, right)
    assert joined(spark, left[:20], []) == [] and joined(spark, [], right[:20]) == []
    one = [(k, "c", 1000, 1000) for k in range(3)]
    assert joined(spark, one, one) == sorted((a, b) for a in range(3) for b in range(3))


def test_an_interval_is_a_few_rows_however_long_it_is(spark):
    left, right = frames(spark, [(1, "c", 0, 240_000_000), (2, "c", 5, 80)], [(1, "c", 7, 9), (2, "c", 100, 220_000_000)])
    dealt = intervals._dealt(left.withColumn("_level", intervals.level(F.col("s"), F.col("e"))), "s", "e", [(0, F.col("_level"), F.lit(True))])
    assert max(Counter(r["a"] for r in dealt.collect()).values()) <= 2


def test_a_hot_bin_is_split_among_tasks(spark):
    left = [(k, "c", 100 + k % 7, 130 + k % 7) for k in range(20_000)] + [(k, "c", 10_000 * k, 10_000 * k + 30) for k in range(1, 300)]
    right = [(k, "c", 10_000 * k, 10_000 * k + 40) for k in range(300)] + [(500, "c", 120, 140)]
    with settings(spark, SKEWED):
        a, b = frames(spark, left, right)
        got = intervals.interval_join(a.repartition(6), b, "chr", ("s", "e"), ("low", "high"))
        assert "skew=true" in plan_of(got)
        assert got.count() == len(plain(left, right))


def test_best_of_a_hot_key_is_split_among_tasks(spark):
    rows = [(None if k % 11 == 0 else "hot" if k % 3 else f"k{k % 97}", k) for k in range(30_000)]
    best = defaultdict(list)
    for key, v in rows:
        best[key].append(v)
    with settings(spark, SKEWED):
        got = keyed.with_best(spark.createDataFrame(rows, "key string, v long").repartition(6), ["key"], F.struct(F.col("v")))
        assert "skew=true" in plan_of(got)
        assert all(r["best"]["v"] == min(best[r["key"]]) for r in got.collect()) and got.count() == len(rows)


def test_occurrences_number_the_rows_of_repeated_keys(spark):
    rng = random.Random(1)
    rows = [(f"k{rng.randrange(400)}" if rng.random() < 0.5 else "hot", rng.randrange(1000)) for _ in range(1000)]
    got = defaultdict(list)
    for r in keyed.occurrences(spark.createDataFrame(rows, "key string, v int").repartition(5), ["key"], ["v"]).collect():
        got[r["key"]].append((r["occurrence"], r["v"]))
    for key in {k for k, _ in rows}:
        assert sorted(got[key]) == list(enumerate(sorted(v for k, v in rows if k == key), 1))
    assert keyed.occurrences(spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int"), ["key"], ["v"]).select("occurrence").distinct().collect() == [(1,)]


def test_as_many_reads_come_out_of_mate_fixing(spark):
    columns = "qname string, read_no int, paired boolean, unmapped boolean, mate_unmapped boolean, neg boolean, mate_neg boolean, not_primary boolean, rname string, pos long, cigar string, rnext string, pnext long, tlen long, seq string, qual string"
    read = lambda n, k, pos: (n, k, True, False, False, False, False, False, "c", pos, "4M", "*", 0, 0, "ACGT", "IIII")
    rows = [read("*", k, 5) for k in (1, 2)] * 4 + [read(None, k, 5) for k in (1, 2)] * 2 + [read("r", k, 10 * k) for k in (1, 2)] * 8 + [read("s", 1, 7), read("s", 1, 9), read("s", 2, 30), read("t", 0, 1)]
    got = O.fix_mate_information(spark.createDataFrame(rows, columns)).collect()
    assert len(got) == len(rows)
    assert {(r["qname"], r["tlen"]) for r in got if r["qname"] in ("*", None)} == {("*", 0), (None, 0)}
    assert Counter((r["read_no"], r["tlen"]) for r in got if r["qname"] == "r") == {(1, 14): 8, (2, -14): 8}
    assert sorted((r["read_no"], r["pos"], r["tlen"]) for r in got if r["qname"] == "s") == [(1, 7, 27), (1, 9, 0), (2, 30, -27)]


@pytest.mark.parametrize("size", [29, 1000])
def test_fastq_splits_may_cut_anywhere(spark, tmp_path, size):
    rng = random.Random(size)
    rows = [(f"@r{i}", "ACGT"[: rng.randrange(5)] * 3, "+", "@" + "I" * rng.randrange(9)) for i in range(40)]
    for name, part in (("a", rows[:35]), ("b", rows[35:])):
        (tmp_path / f"{name}.txt").write_text("".join(f"{x}\n" for r in part for x in r) + ("@cut\nAC\n" if name == "b" else ""))
    (tmp_path / "none.txt").write_text("")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}):
        got = sequences.read_fastq(spark, str(tmp_path))
        found = sorted((r["file"][-5:], r["rec_no"], r["header"], r["seq"], r["qual_header"], r["qual"]) for r in got.collect())
    assert found == [(f"{n}.txt", i, *r) for n, part in (("a", rows[:35]), ("b", rows[35:])) for i, r in enumerate(part)]


def test_fastq_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.txt").write_text("@a\nAC\n+\nII\n" * 50)
    plan = sequences.read_fastq(spark, str(tmp_path / "a.txt"))._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union")[1].split("HashAggregate")[0].split("ObjectHashAggregate")[0].split("SortAggregate")[0]
    assert "MapInArrow" in whole and "FileScan text" in whole and "Exchange hash" not in whole.replace("BroadcastExchange", "")
