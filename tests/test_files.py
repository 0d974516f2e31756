"""Readers, writers and parsers on literal files."""

import os

import pytest
from pyspark.sql import functions as F

from helixframe.functions import names as N
from helixframe.operators import genomes, runs
from helixframe.sources import reports, sequences, tables, xml


def write(path, text):
    path.write_text(text)
    return str(path)


def parts(path):
    return "".join(open(os.path.join(path, f), newline="").read() for f in sorted(os.listdir(path)) if f.startswith("part-"))


def test_fastq_framing_and_round_trip(spark, tmp_path):
    text = "@a/1\nACGT\n+\n@!!!\n@b/1\nAC\n+\nII\n"
    a = write(tmp_path / "s_1_1_sequence.txt", text)
    b = write(tmp_path / "s_1_2_sequence.txt", "@a/2\nGG\n+\nII\n@cut\nAC\n")
    got = sequences.read_fastq(spark, [a, b])
    rows = sorted((r["file"][-20:], r["rec_no"], r["header"], r["seq"], r["qual"]) for r in got.collect())
    assert [r[1:] for r in rows] == [(0, "@a/1", "ACGT", "@!!!"), (1, "@b/1", "AC", "II"), (0, "@a/2", "GG", "II")]
    sequences.write_fastq(got.where(F.col("file").endswith("_1_sequence.txt")), str(tmp_path / "out"))
    assert parts(str(tmp_path / "out")) == text


def test_fastq_over_many_splits(spark, tmp_path):
    n = 3000
    path = write(tmp_path / "big.txt", "".join(f"@r{i}\n{'ACGT' * 10}{i}\n+\n@{'I' * 39}{i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = sequences.read_fastq(spark, path).select("rec_no", "header", "seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(tuple(r) for r in got) == sorted((i, f"@r{i}", "ACGT" * 10 + str(i)) for i in range(n))


SAM = "@HD\tVN:1.0\n@SQ\tSN:chr2\tLN:500\tUR:u\n@SQ\tSN:chr1\tLN:400\n@RG\tID:0\tSM:s\tCN:c\n@PG\tID:bwa\tVN:0.5\nr1\t99\tchr1\t7\t29\t4M\t=\t30\t27\tACGT\tIIII\tMD:Z:4\tRG:Z:0\tXT:A:U\nr1\t147\tchr1\t30\t29\t4M\t=\t7\t-27\tACGT\tIIII\tMD:Z:4\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\nr3\tx\tchr2\n"


def test_sam_is_read_leniently_and_written(spark, tmp_path):
    records, sq, rg, pg = sequences.read_sam(spark, write(tmp_path / "a.sam", SAM))
    got = {(r["qname"], r["read_no"]): r for r in records.collect()}
    assert len(got) == 4 and got["r1", 1]["mate_neg"] and got["r1", 2]["neg"] and got["r1", 1]["md"] == "4" and got["r1", 1]["tags"]["XT"] == "U"
    assert got["r2", 1]["unmapped"] and got["r3", 1]["flag"] is None and got["r3", 1]["seq"] is None
    assert [(r["idx"], r["sn"], r["ln"]) for r in sq.orderBy("idx").collect()] == [(0, "chr2", 500), (1, "chr1", 400)]
    assert rg.first()["cn"] == "c" and pg.first()["vn"] == "0.5"
    sequences.write_sam(records.where("qname <> 'r3'"), sq, rg, pg, str(tmp_path / "out"))
    lines = parts(str(tmp_path / "out")).splitlines()
    assert lines[:4] == SAM.splitlines()[1:5]
    assert [x.split("\t")[:4] for x in lines[4:]] == [["r1", "99", "chr1", "7"], ["r1", "147", "chr1", "30"], ["r2", "4", "*", "0"]]
    again = sequences.read_sam(spark, str(tmp_path / "out"))[0]
    cols = ["qname", "flag", "rname", "pos", "cigar", "seq", "md", "rg"]
    assert sorted(map(repr, again.select(cols).collect())) == sorted(map(repr, records.where("qname <> 'r3'").select(cols).collect()))


def test_barcodes_and_sheets(spark, tmp_path):
    got = tables.read_barcodes(spark, write(tmp_path / "b.txt", "ID01, ACGTAC\nID02,TTTTTT\n"))
    assert sorted((r["tag"], r["seq"]) for r in got.collect()) == [("ID01", "ACGTAC"), ("ID02", "TTTTTT")]
    with pytest.raises(Exception, match="not a barcode line"):
        tables.read_barcodes(spark, write(tmp_path / "bad.txt", "ID01\n")).collect()
    dirs = tables.read_sample_dirs(spark, write(tmp_path / "d.csv", "FC,1,a,b,ACG,ID01,c,d,e,001\n")).first()
    assert (dirs["lane"], dirs["tag"], dirs["bin"]) == ("1", "ID01", "001")
    assert tables.read_sample_sheet(spark, write(tmp_path / "s.csv", "FC,1,l,s,ACG,ID01,n,r1,op\n")).first()["recipe"] == "r1"


def test_sample_sheet_and_definition_files(spark, tmp_path):
    sheet = spark.createDataFrame([("FC", "1", "dummy_library", "dummy_sample", "ACG", "ID01", "n", "r1")], "flowcell string, lane string, library string, sample string, seq string, tag string, control string, recipe string")
    reports.write_sample_sheet(sheet, str(tmp_path / "s"), "an operator")
    assert parts(str(tmp_path / "s")) == "FC,1,dummy_library,dummy_sample,ACG,ID01,n,r1,an operator\r\n"
    reports.write_barcode_definition(sheet, str(tmp_path / "b"))
    assert parts(str(tmp_path / "b")) == "ID01,ACG\n"


def test_run_params_round_trip(spark, tmp_path):
    path = write(tmp_path / "p.txt", "REFERENCE_PATH=/x\nLIBRARY_NAME=\nFILTER_PHIX=true\nCHIP_DESIGN=c1\n")
    got = tables.read_run_params(spark, path)
    row = got.first()
    assert (row["reference_path"], row["library_name"], row["filter_phix"], row["chip_design"], row["scheduler_queue"]) == ("/x", None, True, "c1", "normal")
    reports.write_run_params(tables.run_params_lines(got), str(tmp_path / "o"))
    assert parts(str(tmp_path / "o")) == "REFERENCE_PATH=/x\nLIBRARY_NAME=\nFILTER_PHIX=true\nCHIP_DESIGN=c1\nSCHEDULER_QUEUE=normal\n"


def test_lane_info(spark):
    text = "FLOWCELL_TYPE=pe;Library=lib ;Sample=None;ChipDesign=vc;NUMBER_OF_CYCLES_READ1=101;NUMBER_OF_CYCLES_READ2=101+7;BUILD_PATH= /mount/a/b.fa x"
    got = spark.createDataFrame([(text,), ("FLOWCELL_TYPE=f;BUILD_PATH=Sequence",), (None,)], "t string").select(tables.parse_lane_info("t", "/mount").alias("i")).collect()
    assert tuple(got[0]["i"]) == ("paired", "lib", None, "vc", "101+7", "/mount/a/b.fa")
    assert got[1]["i"]["type"] == "fragment" and got[1]["i"]["reference_path"] == "sequence" and got[2]["i"]["type"] is None


def test_small_text_parsers(spark, tmp_path):
    path = write(tmp_path / "config.txt", "12:ANALYSIS eland\n34:ANALYSIS none\n567:ANALYSIS eland\n")
    assert tables.read_analysis_lanes(spark, path).first()["lanes"] == "567"
    text = "PercentMapped : 91.5%\nPercentMismatch : 0.4%\nPercentMapped : 80%\n"
    got = spark.createDataFrame([(text, 1), (text, 2), ("", 1)], "t string, n int").select(tables.parse_map_stats("t", "n").alias("m")).collect()
    assert [tuple(r["m"]) for r in got] == [(91.5, 0.4), (80.0, 0.0), (0.0, 0.0)]
    files = spark.createDataFrame([(1, "x\n% Unique Reads : 45.5 %\n"), (2, "none"), (3, "% Unique Reads 1"), (3, "% Unique Reads 2")], "lane int, text string")
    assert {r["lane"]: r["pct_unique"] for r in tables.parse_unique_percent(files).collect()} == {1: 45.5, 2: None, 3: None}


def test_capture_report(spark, tmp_path):
    text = "Total Reads Produced: ,1000\nDuplicate Reads: ,100,(10.5%)\nTotal Reads Aligned: ,900,(90%),Paired:,800,Mates:,700\nTargets Hit: ,5,(50%)\nAverage Coverage: ,x,(12.5)\nNon target regions with high coverage: ,3\nBases Targeted: ,77\nBases with 1+ coverage: ,70,(91%)\nTotal Aligned Reads (expected): ,1\nignored,5\n"
    got = tables.read_capture_report(spark, write(tmp_path / "c.csv", text))
    row = got.first()
    assert (row["total_reads"], row["pct_duplicate_reads"], row["reads_paired_mapped_mates"], row["average_coverage"], row["non_target_hits"], row["target_bases"], row["bases_40x"], row["expected_aligned_reads"]) == (1000, 10.5, 700, 12.5, 3, 77, 0, 1)
    line = got.select(reports.capture_result_string().alias("s"), reports.capture_text().alias("t")).first()
    assert line["s"].startswith("TOTAL_READS 1000 DUPLICATE_READS 100 PERCENT_DUPLICATE_READS 10.5 ") and "HIGH_COVERAGE_NON_TARGET_HITS 3 BASES_ON_TARGET 77" in line["s"]
    assert "Duplicate Reads = 100 (10.5)%\r\n" in line["t"]


DEFINITION = '<FCInfo Name="FC1" NumCycles="101+7" Type="paired"><LaneBarcodeList><LaneBarcode Name="1-ID01"/><LaneBarcode Name=""/></LaneBarcodeList><LaneBarcodeInfo><LaneBarcode ID="1-ID01" ReferencePath="/r" Sample="s"/><LaneBarcode ID="2" Library=""/></LaneBarcodeInfo></FCInfo>'


def test_flowcell_definition_round_trip(spark, tmp_path):
    got = xml.read_flowcell_definition(spark, write(tmp_path / "d.xml", DEFINITION))
    row = got.first()
    assert (row["name"], row["read_length"], row["lane_barcodes"]) == ("FC1", 100, ["1-ID01"])
    assert [(i["id"], i["reference_path"], i["sample"], i["library"]) for i in row["info"]] == [("1-ID01", "/r", "s", None), ("2", "sequence", None, None)]
    xml.write_flowcell_definition(got, str(tmp_path / "o"))
    assert xml.read_flowcell_definition(spark, str(tmp_path / "o")).first() == row
    from helixframe.operators import samples

    known = samples.lane_info_lookup(got, spark.createDataFrame([("2",)], "lane_barcode string")).first()
    assert known["reference_path"] == "sequence"
    with pytest.raises(Exception, match="no such lane barcode"):
        samples.lane_info_lookup(got, spark.createDataFrame([("9",)], "lane_barcode string")).collect()


def test_lane_summary_xml(spark, tmp_path):
    lane = "<Lane><laneNumber>3</laneNumber><laneYield>{y}</laneYield><clusterCountRaw><mean>5.5</mean></clusterCountRaw><errorPF><mean></mean></errorPF></Lane>"
    text = f"<Summary><ChipSummary><RunFolder>run_FCX</RunFolder></ChipSummary><LaneResultsSummary><Read><readNumber>1</readNumber>{lane.format(y=77)}</Read><Read><readNumber>2</readNumber>{lane.format(y='')}</Read></LaneResultsSummary><ExpandedLaneSummary><Read><readNumber>1</readNumber><Lane><laneNumber>3</laneNumber><phasingApplied>0.4</phasingApplied></Lane></Read></ExpandedLaneSummary></Summary>"
    got = {r["read_no"]: r for r in xml.read_lane_summary(spark, write(tmp_path / "s.xml", text)).collect()}
    assert (got[1]["yield_kb"], got[1]["clusters_raw"], got[1]["error_pf"], got[1]["phasing"], got[1]["prephasing"], got[2]["yield_kb"], got[2]["phasing"]) == (77, 5.5, 0, 0.4, 0, 0, 0)


def test_html_summary(spark, tmp_path):
    def table(keys, values):
        return "<table>" + "".join("<tr>\n" + "".join(f"<td>{c} </td>\n" for c in row) + "</tr>\n" for row in (keys, values)) + "</table>"

    text = "<h2>Lane Results Summary</h2>" + table(["Lane", "Yield"], ["1", "9 +/- 2"]) + "<h2>Expanded Lane Summary</h2>" + table(["Lane", "% Phasing", "% Prephasing"], ["1", "0.3", "0.2"]) + "<h2>Lane Results Summary : Read 2</h2>" + table(["Lane"], ["2"])
    got = {r["read_no"]: r["values"] for r in xml.read_html_summary(spark, write(tmp_path / "s.htm", text)).collect()}
    assert got[1] == {"Lane": "1", "Yield": "9 +/- 2", "% Phasing": "0.3", "% Prephasing": "0.2"} and got[2]["Lane"] == "2"
    mean, name, sd = N.split_mean_sd("k", "v")
    row = spark.createDataFrame([("Yield", "9 +/- 2"), ("Lane", "1")], "k string, v string").select(mean, name, sd).collect()
    assert [tuple(r) for r in row] == [("9", "+/- SD Yield", "2"), ("1", None, None)]


def test_listing_and_paths(spark, tmp_path):
    (tmp_path / "root/EAS1/FC9").mkdir(parents=True)
    write(tmp_path / "root/EAS1/FC9/RTAComplete.txt", "x")
    row = tables.list_runs(spark, str(tmp_path / "root")).first()
    assert (row["instrument"], row["flowcell"], row["file"]) == ("EAS1", "FC9", "RTAComplete.txt")
    names = {
        "10-58-47_1192204727-CF071008_USI-EAS09_0002_FC8963-L6-Strep_pneumoniae": ("071008", "USI-EAS09", "Fragment", "FC8963", "Strep_pneumoniae"),
        "09-26-07_10-13-02_1190819582-T_cuniculi_A": (None, None, "Fragment", None, "T_cuniculi_A"),
        "080114_USI-EAS09_R2_PE_FC13018AAXX-L5-phix": ("080114", "USI-EAS09", "PE", "FC13018AAXX", "phix"),
        "080205_USI-EAS09_0002_PE1_FC13354AAXX-L2-staph_300": ("080205", "USI-EAS09", "PE1", "FC13354AAXX", "staph_300"),
        "FC8963-L3-PB07": (None, None, "Fragment", None, "PB07"), "PE2_FC8963-L3-a-L4-b": (None, None, "PE2", None, "a-L4-b"), "_PE_FC1-L3-x": (None, None, "PE", None, "x"),
        "09-26-07_10-13-02_119_PE-a_b-c": (None, None, "PE", None, "a_b-c"), "none": None, "L5-sample": None, "FC8963-Lx-PB07": None, "09-26-07_10-13_119-a": None, "": None,
    }
    rows = spark.createDataFrame([(n, f"/a/{n}/data_dir/x") for n in names], "n string, p string").select("n", N.parse_run_path("p").alias("r")).collect()
    for n, r in rows:
        assert (r and (r["date_created"], r["instrument"], r["type"], r["fc"], r["sample"])) == names[n], n
        assert r is None or r["run"] == n
    assert spark.createDataFrame([("/a/FC8963-L3-PB07/other",), (None,)], "p string").select(N.parse_run_path("p")).distinct().collect()[0][0] is None


def test_versions_and_names(spark):
    rows = [("<RunParameters><Setup><RTAVersion>1.9</RTAVersion></Setup></RunParameters>", None), (None, "x\nIllumina RTA 1.8.4\n"), (None, None)]
    assert [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(N.rta_version("a", "b")).collect()] == ["1.9", "1.8.4", None]
    fc = spark.createDataFrame([("110413_SN166_0177_BC0117ABXX", "7-IDMB44")], "fc string, lb string")
    assert fc.select(N.lims_flowcell("fc"), N.platform_unit("fc", "lb")).first()[:] == ("C0117ABXX", "700166_20110413_C0117ABXX-7-IDMB44")
    names = [("4", True), ("1-ID01", True), ("7-IDMB4", True), ("7-IDMB44", True), ("9", False), ("1-ID1", False), ("1-IDMB444", False)]
    got = spark.createDataFrame(names, "n string, ok boolean").select("ok", N.lane_barcode_valid("n")).collect()
    assert all(a == b for a, b in got)


def test_metric_reports(spark, tmp_path):
    flat = spark.createDataFrame([(["A"], 0, "k", "1"), (["A"], 1, "l", "x<y"), (["A", "B"], 2, "m", "2"), (["C"], 3, None, None)], "path array<string>, at int, key string, value string")
    assert reports.metrics_text(flat).first()["text"] == "\r\nA\r\nk : 1\r\nl : x<y\r\n\r\nB\r\nm : 2\r\n\r\nC\r\n"
    assert reports.metrics_xml(flat).first()["xml"] == '<AnalysisMetrics><A k="1" l="x&lt;y"><B m="2"/></A><C/></AnalysisMetrics>'
    hist = spark.createDataFrame([("FR", 9, 1), ("FR", 3, 2), ("RF", 5, 5)], "orientation string, size int, pairs int")
    reports.write_histogram_csv(hist, str(tmp_path / "h"))
    assert parts(str(tmp_path / "h/orientation=FR")) == "3,2\n9,1\n"
    quality = spark.createDataFrame([(1, 1, 30.0), (1, 2, 20.5), (2, 1, 10.0)], "series int, position int, mean_quality double")
    reports.write_quality_csv(quality, str(tmp_path / "q"))
    assert parts(str(tmp_path / "q")) == "1,30.0,10.0,\n2,20.5,\n"


def test_fasta(spark):
    got = spark.createDataFrame([(">a\nACGT\n>b\nGG\n",)], "t string").select(genomes.mask_headers(F.col("t"))).first()[0]
    assert got == "N" * 10 + "ACGT\n" + "N" * 10 + "GG\n"
    lines = spark.createDataFrame(list(enumerate([">c1", "ACGT", "A" * 60, ">c2", "GG"])), "line_no long, line string")
    got = [(r["chunk"], r["line"]) for r in genomes.repack(lines, 2).orderBy("chunk", "line_no").collect()]
    n = "N" * 50
    body = [n, n, "ACGT".ljust(50, "N"), "A" * 60, n, n, "GG".ljust(50, "N")]
    assert got == [x for c in range(4) for x in [(c + 1, f">fake{c + 1}"), *((c + 1, b) for b in body[2 * c : 2 * c + 2])]]


def test_run_ready_edges(spark):
    at = "2030-01-01 00:00:00"
    three = ["Basecalling_Netcopy_complete.txt", "Basecalling_Netcopy_complete_READ1.txt", "Basecalling_Netcopy_complete_READ2.txt"]
    copies = lambda fc, names, version: [("I", fc, f, at, version) for f in names]
    rows = [*copies("old", three, "1.9"), *copies("SN601_x", three, "1.9"), *copies("newer", three, "1.12"), *copies("unknown", three, None), *copies("thrice", three[:1] * 3, "1.9"), *copies("two", three[:2], "1.9"),
            ("I", "old", three[1], "2030-01-01 00:50:00", "1.9"), ("I", "done", ".rsync_finished", at, None), ("I", "rta", "RTAComplete.txt", at, "1.9"), *copies("rta", three, "1.9")]
    files = spark.createDataFrame(rows, "instrument string, flowcell string, file string, mtime string, version string").withColumn("mtime", F.col("mtime").cast("timestamp"))
    versions = files.groupBy("instrument", "flowcell").agg(F.max("version").alias("version"))
    for now, old in (("2030-01-01 00:59:59", False), ("2030-01-01 01:00:00", True)):
        want = {"old": (old, False), "SN601_x": (False, False), "newer": (False, False), "unknown": (False, False), "thrice": (False, False), "two": (False, False), "done": (True, False), "rta": (False, True)}
        for listed in (runs.run_ready(files, F.lit(now).cast("timestamp")), runs.run_ready(files.drop("version"), F.lit(now).cast("timestamp"), versions)):
            assert {r["flowcell"]: (r["ready"], r["mark"]) for r in listed.collect()} == want
    assert not any(r["ready"] for r in runs.run_ready(files.drop("version").where("flowcell <> 'done'"), F.lit(at).cast("timestamp")).collect())


FULL = """@HD\tVN:1.0\tSO:coordinate
@SQ\tSN:chr2\tLN:500\tUR:u\tM5:abc\tXX:y z
@SQ\tSN:chr1\tLN:400
@RG\tID:0\tSM:s\tCN:c\tDT:sometime\tDS:what it is\tPI:300
@PG\tID:bwa\tVN:0.5\tPN:bwa\tCL:bwa aln -t 8 x.fa
@CO\ta comment\twith a tab
@CO\tanother
r0\t0\tchr2\t7\t29\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:3\tMD:Z:4\tXF:f:0.5\tXA:A:c\tZB:B:c,1,-2\tRG:Z:0\tNM:i:4
r1\t0\tchr1\t7\t29\t4M\t*\t0\t0\tACGT\tIIII\tXH:H:1AE301
r2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII
"""


def test_sam_keeps_tag_types_and_header_fields(spark, tmp_path):
    path = write(tmp_path / "full.sam", FULL)
    records, sq, rg, pg = sequences.read_sam(spark, path)
    other = sequences.read_sam_other(spark, path)
    row = records.where("qname = 'r0'").first()
    assert row["tags"]["NM"] == "3" and row["tag_text"][0] == "NM:i:3" and sq.where("sn = 'chr2'").first()["rest"] == "M5:abc\tXX:y z"
    assert rg.first()["dt"] is None and rg.first()["rest"] == "DT:sometime\tDS:what it is\tPI:300" and [r["value"] for r in other.orderBy("at").collect()] == [FULL.split("\n")[k] for k in (0, 5, 6)]
    sequences.write_sam(records, sq, rg, pg, str(tmp_path / "out"), other)
    assert parts(str(tmp_path / "out")) == FULL
    changed = records.withColumn("rg", F.lit("new")).withColumn("md", F.lit(None).cast("string"))
    sequences.write_sam(changed.where("qname <> 'r2'"), sq, rg, pg, str(tmp_path / "changed"))
    tags = [x.split("\t")[11:] for x in parts(str(tmp_path / "changed")).splitlines() if not x.startswith("@")]
    assert tags == [["NM:i:3", "XF:f:0.5", "XA:A:c", "ZB:B:c,1,-2", "RG:Z:new", "NM:i:4"], ["XH:H:1AE301", "RG:Z:new"]]


def test_barcode_rows_that_repeat_a_tag(spark):
    from helixframe.operators import samples

    rows = [(0, "a", "ACGTAC"), (1, "a", "ACGTAC"), (2, "b", "ACGTACGGG"), (3, "a", "ACGTAA"), (4, "c", "TTTTTT")]
    df = spark.createDataFrame(rows, "line_no int, tag string, seq string")
    apart = lambda x, y: abs(len(x) - len(y)) + sum(p != q for p, q in zip(x, y, strict=False))
    for k in (1, 2, 3, 4, 5, 7, 99):
        want = sorted((t, u, apart(s, v)) for i, t, s in rows for j, u, v in rows if i < j and apart(s, v) < k)
        assert sorted(tuple(r) for r in samples.barcode_distance(df, k).collect()) == want


def test_the_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from helixframe.sources.shared import checkpoint_folder

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://x:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_folder(cluster)
