"""Work is dealt out by what it costs: files by their number, small tables by broadcast."""

import os

from helixframe.sources import sequences, shared
from helixframe.streaming import runs as T


def test_many_small_files_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "TASK_FILES", 5)
    rows = spark.createDataFrame([(f"r{k}", "x") for k in range(60)], "run string, file string")
    shared.write_folders(rows, str(tmp_path / "out"), "run")
    names = [f for _, _, files in os.walk(tmp_path / "out") for f in files if f.startswith("part-")]
    assert len(names) == 60 and len({n[:10] for n in names}) > 4


def test_markers_are_files_of_run_folders(spark, tmp_path):
    for path in ("m1/fc1/done", "m1/fc2/done", "m1/beside", "m1/fc1/deep/done", "m2/fc3/RTAComplete.txt"):
        at = tmp_path / "root" / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text("x")
    out = str(tmp_path / "out")
    T.run_to_end(T.marker_stream(spark, str(tmp_path / "root")), out, str(tmp_path / "check"))
    got = sorted(tuple(r)[:3] for r in spark.read.parquet(out).collect())
    assert got == [("m1", "fc1", "done"), ("m1", "fc2", "done"), ("m2", "fc3", "RTAComplete.txt")]


def test_reads_are_not_dealt_out_by_contig_to_be_written(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(sequences, "small", lambda df: asked.append(df.columns) or shared.small(df))
    (tmp_path / "a.sam").write_text("@SQ\tSN:c\tLN:9\nr\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    sequences.write_sam(*sequences.read_sam(spark, str(tmp_path / "a.sam")), str(tmp_path / "out"))
    assert asked == [["rname", "ref_at"]]


def test_a_file_for_each_key_takes_no_file_beside_it(spark, tmp_path):
    keys = ["plain", "a/b", "x=y:z", "50%", "it's {x}[1]^", 'q"#*?\\', "ü é", " ", "", None]
    rows = spark.createDataFrame([(k, n, v) for k in keys for n in (1, 2) for v in (f"{n}", "ü\tx", None)], "run string, n int, file string")
    for call in range(2):
        shared.write_folders(rows, str(tmp_path / "out"), "run", "n")
    rows.unionAll(rows).repartition(1, "run").write.partitionBy("run", "n").text(str(tmp_path / "plain"))
    read = lambda at: spark.read.schema("value string, run string, n int").text(str(tmp_path / at))
    folders = lambda at: sorted(os.path.relpath(d, tmp_path / at) for d, _, files in os.walk(tmp_path / at) if any(f.startswith("part-") for f in files))
    assert folders("out") == folders("plain") and read("out").count() == 120
    assert sorted(map(str, read("out").collect())) == sorted(map(str, read("plain").collect()))
    files = [f for _, _, names in os.walk(tmp_path / "out") for f in names]
    assert len(files) == 2 * len(folders("out")) and all(f.startswith("part-") for f in files)


def test_markers_are_read_by_a_few_tasks(spark, tmp_path):
    most = T.CORE_TASKS * spark.sparkContext.defaultParallelism
    for k in range(most + 20):
        at = tmp_path / "root" / "m" / f"fc{k}"
        at.mkdir(parents=True)
        (at / "done").write_text("x")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    jobs = spark.conf.get(T.LISTING_TASKS)
    try:
        T.run_to_end(T.marker_stream(spark, str(tmp_path / "root")), str(tmp_path / "out"), str(tmp_path / "check"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spark.read.parquet(str(tmp_path / "out")).count() == most + 20
    assert len([f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]) <= most and spark.conf.get(T.LISTING_TASKS) == jobs


def test_header_tables_are_not_paired_line_by_line(spark, sf):
    from helixframe.plans import registry

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.QUERIES["sam_tags_round_trip"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" in plan


def test_sam_by_a_stored_header_is_the_same(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1.0\n@SQ\tSN:c\tLN:9\n@RG\tID:g\tDS:x\n@PG\tID:t\n@CO\tnote\nr\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n@SQ\tSN:d\tLN:8\tM5:f\n")
    path = str(tmp_path / "a.sam")
    header = sequences.sam_header(spark, path)
    rows = lambda dfs: [sorted(map(str, df.collect())) for df in dfs]
    assert rows(sequences.read_sam(spark, path, header)) == rows(sequences.read_sam(spark, path))
    assert rows([sequences.read_sam_other(spark, path, header)]) == rows([sequences.read_sam_other(spark, path)]) != [[]]
