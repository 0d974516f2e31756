"""Overlaps where very many intervals lie on one another: pairs are dealt out by their number, and metrics make none."""

import random

from pyspark.sql import functions as F

from helixframe.operators import intervals
from helixframe.operators import metrics as M

READ = "qname string, read_no int, paired boolean, unmapped boolean, dup boolean, rname string, pos long, cigar string"


def crowd(spark, n=300, targets=40):
    rng = random.Random(3)
    reads = [(f"r{k % 200}", 1 + k % 2, True, k % 9 == 0, False, f"c{k % 2}", rng.randrange(400), "20M") for k in range(n)]
    wanted = [(f"c{k % 2}", s := rng.randrange(300), s + rng.randrange(30)) for k in range(targets)] + [("c0", 5000, 5010), ("c0", 90, 85), ("c1", 450, 430)]
    return spark.createDataFrame(reads, READ), spark.createDataFrame(wanted, "chr string, start_pos long, end_pos long")


def test_crowded_bins_are_dealt_out_by_their_pairs(spark, monkeypatch):
    reads, targets = crowd(spark)
    want = sorted(map(str, M.capture_overlap(reads, targets, 10).collect()))
    monkeypatch.setattr(intervals, "TASK_PAIRS", 50)
    monkeypatch.setattr(intervals, "CELL_ROWS", 7)
    monkeypatch.setattr(intervals, "CROWDED", 2)
    dealt = M.capture_overlap(reads, targets, 10)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, dealt.collect())) == want and len(want) > 500


def test_unions_of_intervals(spark):
    rng = random.Random(5)
    rows = [(f"c{rng.randrange(2)}", s := rng.randrange(-50, 9000), s + rng.choice([-1, 0, 3, 40, 1500])) for _ in range(60)] + [(None, 1, 2), ("c0", None, 3)]
    covered = {(c, x) for c, s, e in rows if None not in (c, s, e) for x in range(s, e + 1)}
    got = sorted(tuple(r) for r in intervals.merged(spark.createDataFrame(rows, "chr string, s long, e long"), "chr", "s", "e", bin_size=64).collect())
    assert {(c, x) for c, s, e in got for x in range(s, e + 1)} == covered
    assert all(a[0] != b[0] or a[2] + 1 < b[1] for a, b in zip(got, got[1:], strict=False))


def test_capture_metrics_make_no_pairs(spark, monkeypatch):
    reads, targets = crowd(spark)
    pairs = M.capture_overlap(reads, targets, 10)
    names = lambda df, *c: df.select(*c).distinct().count()
    on, read, target = pairs.where("on_target"), ("qname", "read_no"), ("chr", "start_pos", "end_pos")
    want = (names(on, *read), names(pairs, *read), names(on, *target), names(pairs, *target))
    made = []
    pair = M.capture_overlap
    monkeypatch.setattr(M, "capture_overlap", lambda r, t, *a: made.append(t.where(F.col("start_pos") <= F.col("end_pos")).count()) or pair(r, t, *a))
    got = M.capture_metrics(reads, targets, 10).first()
    assert (got["target_reads"], got["target_or_buffer_reads"], got["targets_hit"], got["target_buffers_hit"]) == want
    assert made == [0]


def test_pairs_of_a_crowded_cell_come_by_place(spark, monkeypatch):
    rng = random.Random(7)
    reads = spark.createDataFrame([(f"r{k}", 1, True, False, False, "c", rng.randrange(1100, 1200), "20M") for k in range(60)], READ)
    targets = spark.createDataFrame([("c", s := rng.randrange(1050, 1120), s + rng.randrange(70, 100)) for _ in range(50)], "chr string, start_pos long, end_pos long")
    monkeypatch.setattr(intervals, "TASK_PAIRS", 50)
    monkeypatch.setattr(intervals, "CROWDED", 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [(r["r_start"], r["start_pos"], r["end_pos"]) for r in M.capture_overlap(reads, targets, 10).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    places = [k for k in range(1, len(got)) if got[k][0] != got[k - 1][0]]
    assert len(got) > 500 and got == sorted(got, key=lambda g: g[0]) and len(places) < 60
    assert sum(a[1:] > b[1:] for a, b in zip(got, got[1:])) < 60  # only where the next read begins
