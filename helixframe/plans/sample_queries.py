"""Queries over derived sample, flowcell and run tables, with the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import runs as U
from ..operators import samples as S
from ..sources import reports
from .fixtures import BARCODES, FLOWCELLS, LANE_BARCODES, LANE_SUMMARY, READS, RUN_FILES, SAMPLE_SHEET, ctes, load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


HAMMING = lambda a, b: f"(abs(length({a}) - length({b})) + CAST(list_sum(list_transform(range(1, least(length({a}), length({b})) + 1), lambda i: CASE WHEN substr({a}, i, 1) <> substr({b}, i, 1) THEN 1 ELSE 0 END)) AS INT))"


@query("barcode_distance", ctes(b=BARCODES) + f"SELECT * FROM (SELECT x.tag AS tag1, y.tag AS tag2, CAST({HAMMING('x.seq', 'y.seq')} AS INT) AS distance FROM b x JOIN b y ON x.tag < y.tag) WHERE distance < 7")
def barcode_distance(spark, sf_dir):
    return S.barcode_distance(load(spark, sf_dir, BARCODES), 7).select("tag1", "tag2", F.col("distance").cast("int").alias("distance"))


@query("pad_barcodes", ctes(s=SAMPLE_SHEET) + ", l AS (SELECT *, min(length(seq)) OVER (PARTITION BY flowcell) AS a, max(length(seq)) OVER (PARTITION BY flowcell) AS b FROM (SELECT DISTINCT flowcell, tag, seq FROM s)) SELECT flowcell, tag, CASE WHEN b - a = 3 AND length(seq) = a THEN concat(seq, 'CTC') ELSE seq END AS seq FROM l")
def pad_barcodes(spark, sf_dir):
    return S.pad_barcodes(load(spark, sf_dir, SAMPLE_SHEET).select("flowcell", "tag", "seq").distinct(), ["flowcell"])


TAG = "CASE WHEN contains(lane_barcode, '-') THEN regexp_replace(lane_barcode, '^[0-9]-', '') ELSE '' END"


@query("build_sample_sheet", ctes(b=BARCODES, l=LANE_BARCODES) + f"SELECT 'FC1' AS flowcell, lane, seq, x.tag AS tag, count(*) AS n FROM (SELECT substr(lane_barcode, 1, 1) AS lane, {TAG} AS tag FROM l) x JOIN b ON x.tag = b.tag GROUP BY lane, seq, x.tag")
def build_sample_sheet(spark, sf_dir):
    got = S.build_sample_sheet(load(spark, sf_dir, LANE_BARCODES), load(spark, sf_dir, BARCODES), "FC1", strict=False)
    return got.groupBy("flowcell", "lane", "seq", "tag").agg(F.count(F.lit(1)).alias("n"))


@query("demultiplex", ctes(reads=READS, b=BARCODES) + f""", q AS (SELECT qname, read_no, substr(seq, 1, 6) AS barcode FROM reads), s AS (SELECT tag, substr(seq, 1, 6) AS seq FROM b),
d AS (SELECT barcode, tag, seq, {HAMMING('barcode', 'seq')} AS d FROM (SELECT DISTINCT barcode FROM q) x JOIN s ON length(barcode) = length(seq) WHERE {HAMMING('barcode', 'seq')} <= 1),
w AS (SELECT barcode, min(d) AS m FROM d GROUP BY barcode), o AS (SELECT d.barcode, min(tag) AS tag, min(seq) AS seq FROM d JOIN w ON d.barcode = w.barcode AND d.d = w.m GROUP BY d.barcode HAVING count(*) = 1)
SELECT qname, read_no, q.barcode AS barcode, coalesce(tag, 'unknown') AS tag, seq AS corrected FROM q LEFT JOIN o ON q.barcode = o.barcode""")
def demultiplex(spark, sf_dir):
    sheet = load(spark, sf_dir, BARCODES).select(F.lit("FC").alias("flowcell"), F.lit(1).alias("lane"), "tag", F.substring("seq", 1, 6).alias("seq"))
    reads = load(spark, sf_dir, READS).select("qname", "read_no", F.lit("FC").alias("flowcell"), F.lit(1).alias("lane"), F.substring("seq", 1, 6).alias("barcode"))
    return S.demultiplex(reads, sheet).select("qname", "read_no", "barcode", "tag", "corrected")


@query("missing_barcode", ctes(s=SAMPLE_SHEET) + ", d AS (SELECT DISTINCT flowcell, lane, seq FROM s WHERE tag < 'ID20'), m AS (SELECT s.* FROM s LEFT JOIN d ON s.flowcell = d.flowcell AND s.lane = d.lane AND s.seq = d.seq WHERE d.seq IS NULL) SELECT flowcell, lane, min_by(seq, concat(tag, seq)) AS seq FROM m GROUP BY flowcell, lane")
def missing_barcode(spark, sf_dir):
    sheet = load(spark, sf_dir, SAMPLE_SHEET).withColumn("line_no", F.concat("tag", "seq"))
    return S.missing_barcode(sheet, sheet.where("tag < 'ID20'"))


@query("directory_bin", ctes(s=SAMPLE_SHEET) + ", d AS (SELECT flowcell, lane, tag, min_by(concat('bin', seq), seq) AS bin FROM s WHERE tag < 'ID30' GROUP BY flowcell, lane, tag) SELECT DISTINCT s.flowcell, s.lane, s.tag, coalesce(bin, 'unknown') AS bin FROM s LEFT JOIN d ON s.flowcell = d.flowcell AND s.lane = d.lane AND s.tag = d.tag")
def directory_bin(spark, sf_dir):
    sheet = load(spark, sf_dir, SAMPLE_SHEET)
    dirs = sheet.where("tag < 'ID30'").select("flowcell", "lane", "tag", F.concat(F.lit("bin"), "seq").alias("bin"), F.col("seq").alias("line_no"))
    return S.directory_bin(sheet.select("flowcell", "lane", "tag").distinct(), dirs)


@query("lane_barcode_valid", ctes(l=LANE_BARCODES, s=SAMPLE_SHEET) + f""", x AS (SELECT id, lane_barcode, substr(lane_barcode, 1, 1) AS lane, {TAG} AS tag FROM l), t AS (SELECT DISTINCT CAST(lane AS VARCHAR) AS lane, tag FROM s WHERE lane < 6)
SELECT id, lane_barcode, lane, tag, regexp_matches(lane_barcode, '^[1-8](-ID([0-9][0-9]|MB[0-9][0-9]?))?$') AND CASE WHEN tag = '' THEN lane NOT IN (SELECT lane FROM t) ELSE (lane, tag) IN (SELECT (lane, tag) FROM t) END AS valid FROM x""")
def lane_barcode_valid(spark, sf_dir):
    return S.validate_lane_barcode(load(spark, sf_dir, LANE_BARCODES), load(spark, sf_dir, SAMPLE_SHEET).where("lane < 6"))


@query("tag_lookup", ctes(s=SAMPLE_SHEET) + ", b AS (SELECT tag, max(seq) AS q FROM s GROUP BY tag) SELECT flowcell, lane, s.tag AS tag, q AS seq FROM s JOIN b ON s.tag = b.tag")
def tag_lookup(spark, sf_dir):
    sheet = load(spark, sf_dir, SAMPLE_SHEET)
    return S.tag_lookup(sheet.select("flowcell", "lane", "tag"), sheet.select("tag", "seq", F.col("seq").alias("line_no")))


@query("sequence_lookup", ctes(s=SAMPLE_SHEET) + ", b AS (SELECT seq, max(tag) AS t FROM s GROUP BY seq) SELECT flowcell, lane, s.seq AS seq, t AS tag FROM s JOIN b ON s.seq = b.seq")
def sequence_lookup(spark, sf_dir):
    sheet = load(spark, sf_dir, SAMPLE_SHEET)
    return S.tag_lookup(sheet.select("flowcell", "lane", "seq"), sheet.select("tag", "seq", F.col("tag").alias("line_no")), by="seq")


@query("is_multiplexed", ctes(l=LANE_BARCODES) + "SELECT id % 500 AS fc, bool_or(regexp_matches(lane_barcode, '[1-8]-ID([0-9][0-9]|MB)')) AS multiplexed FROM l GROUP BY id % 500")
def is_multiplexed(spark, sf_dir):
    return S.is_multiplexed(load(spark, sf_dir, LANE_BARCODES).withColumn("fc", F.col("id") % 500), ["fc"])


LIMS = "regexp_replace(regexp_replace(regexp_extract(fc, '([a-zA-Z0-9]+)$', 1), '^FC', ''), '^[a-zA-Z]', '')"


@query("platform_unit", ctes(f=FLOWCELLS) + f"""SELECT id, NOT regexp_matches(fc, 'EAS034|EAS376') AS hiseq, {LIMS} AS lims,
  concat(replace(regexp_extract(regexp_replace(fc, '^[0-9]+_', ''), '([A-Za-z0-9-]+)', 1), 'SN', '700'), '_20', regexp_extract(fc, '^([0-9]+)', 1), '_', {LIMS}, '-', lane_barcode) AS unit FROM f""")
def platform_unit(spark, sf_dir):
    return load(spark, sf_dir, FLOWCELLS).select("id", N.is_hiseq("fc").alias("hiseq"), N.lims_flowcell("fc").alias("lims"), N.platform_unit("fc", "lane_barcode").alias("unit"))


@query("reference_override", ctes(f=FLOWCELLS) + """SELECT id, CASE WHEN contains(library, 'TREN') OR contains(library, 'TLVR') THEN 'hg19/original/hg19.fa' ELSE reference END AS reference,
  CASE WHEN length(chip) > 0 THEN CASE WHEN contains(library, 'TREN') THEN 'ezexome2_hg19' WHEN contains(library, 'TLVR') THEN 'vcrome2.1_hg19' ELSE chip END END AS chip FROM f""")
def reference_override(spark, sf_dir):
    return load(spark, sf_dir, FLOWCELLS).select("id", N.reference_override("library", "reference").alias("reference"), N.chip_override("library", "chip").alias("chip"))


@query("read_group_string", ctes(f=FLOWCELLS) + """SELECT id, concat_ws(chr(9), '@RG', 'ID:0', concat('SM:', coalesce(nullif(sample, ''), fc)), CASE WHEN library <> '' THEN concat('LB:', library) END, concat('PU:', fc), 'CN:center',
  concat('DT:', strftime(run_date, '%Y-%m-%d'), 'T00:00:00Z'), 'PL:Illumina') AS rg FROM f""")
def read_group_string(spark, sf_dir):
    return load(spark, sf_dir, FLOWCELLS).select("id", N.read_group_string("sample", "library", F.lit(None).cast("string"), "fc", "run_date", "center").alias("rg"))


@query("split_lane_barcode", ctes(l=LANE_BARCODES) + f"SELECT id, substr(lane_barcode, 1, 1) AS lane, {TAG} AS tag FROM l")
def split_lane_barcode(spark, sf_dir):
    lane, tag = N.split_lane_barcode("lane_barcode")
    return load(spark, sf_dir, LANE_BARCODES).select("id", lane.alias("lane"), tag.alias("tag"))


SUMS = "(SELECT flowcell, read_no, lane, CAST(sum(CASE WHEN yield_kb = '' THEN 0 ELSE CAST(yield_kb AS BIGINT) END) AS BIGINT) AS yield_kb, sum(clusters_raw) AS clusters_raw, sum(clusters_pf) AS clusters_pf FROM s GROUP BY flowcell, read_no, lane)"


@query("lane_summary", ctes(s=LANE_SUMMARY) + f"SELECT flowcell, read_no, lane, yield_kb, round(CAST(clusters_raw AS DOUBLE), 4) AS clusters_raw, round(CAST(clusters_pf AS DOUBLE), 4) AS clusters_pf FROM {SUMS}")
def lane_summary(spark, sf_dir):
    got = U.lane_summary(load(spark, sf_dir, LANE_SUMMARY))
    return got.select("flowcell", "read_no", "lane", "yield_kb", F.round(F.col("clusters_raw").cast("double"), 4).alias("clusters_raw"), F.round(F.col("clusters_pf").cast("double"), 4).alias("clusters_pf"))


@query("lane_result_string", ctes(s=LANE_SUMMARY) + f"""SELECT flowcell, read_no, lane, concat(' LANE_YIELD_KBASES ', CAST(yield_kb AS VARCHAR), ' CLUSTERS_RAW ', CAST(CAST(floor(clusters_raw) AS BIGINT) AS VARCHAR), ' CLUSTERS_PF 0 FIRST_CYCLE_INT_PF 0 PERCENT_INTENSITY_AFTER_20_CYCLES_PF 0 PERCENT_PF_CLUSTERS 0 PERCENT_PHASING 0 PERCENT_PREPHASING 0',
  CASE WHEN lane < 5 THEN ' PERCENT_ALIGN_PF 7 PERCENT_ERROR_RATE_PF 0 ALIGNMENT_SCORE_PF 0' ELSE '' END, CASE WHEN lane < 5 AND read_no = 1 THEN ' RESULTS_PATH /r REFERENCE_PATH  BAM_PATH /b UNIQUE_PERCENT 90.5' ELSE '' END) AS result FROM {SUMS}""")
def lane_result_string(spark, sf_dir):
    got = U.lane_summary(load(spark, sf_dir, LANE_SUMMARY)).withColumn("clusters_raw", F.floor("clusters_raw"))
    zero = {c: F.lit(0) for c in ("clusters_pf", "first_cycle_int", "int20", "pct_pf", "phasing", "prephasing", "error_pf", "align_score_pf")}
    got = got.withColumns(zero | {"pct_align_pf": F.lit(7.0), "results_path": F.lit("/r"), "reference_path": F.lit(None).cast("string"), "bam_path": F.lit("/b"), "pct_unique": F.lit(90.5), "analysed": F.col("lane") < 5})
    return got.select("flowcell", "read_no", "lane", reports.lane_result_string().alias("result"))


@query("lanes_with_yield", ctes(s=LANE_SUMMARY) + "SELECT flowcell, concat('Summary', coalesce(string_agg(concat('_', CAST(lane AS VARCHAR)), '' ORDER BY lane) FILTER (WHERE lane IS NOT NULL), ''), '.htm') AS label FROM (SELECT DISTINCT flowcell, CASE WHEN read_no <> 2 AND yield_kb <> '' THEN lane END AS lane FROM s) GROUP BY flowcell")
def lanes_with_yield(spark, sf_dir):
    return U.lanes_with_yield(load(spark, sf_dir, LANE_SUMMARY))


@query("is_paired_run", ctes(s=LANE_SUMMARY) + "SELECT flowcell, bool_or(read_no = 2) AND count(DISTINCT yield_kb) >= 2 AS paired FROM s GROUP BY flowcell")
def is_paired_run(spark, sf_dir):
    s = load(spark, sf_dir, LANE_SUMMARY)
    return U.is_paired_run(s, s.select("flowcell", F.col("yield_kb").alias("file")))


@query("new_runs", ctes(r=RUN_FILES) + "SELECT DISTINCT instrument, flowcell FROM r WHERE flowcell NOT IN (SELECT flowcell FROM r WHERE file = '.rsync_finished' AND mtime < (SELECT min(mtime) + INTERVAL 10 DAY FROM r))")
def new_runs(spark, sf_dir):
    files = load(spark, sf_dir, RUN_FILES)
    cut = files.agg((F.min("mtime") + F.expr("INTERVAL 10 DAYS")).alias("cut"))
    done = files.where(F.col("file") == U.FINISHED).crossJoin(F.broadcast(cut)).where(F.col("mtime") < F.col("cut"))  # one row
    return U.new_runs(files, done)


@query("run_finished_date", ctes(r=RUN_FILES) + """, w AS (SELECT DISTINCT instrument, replace(flowcell, 'FC', CASE WHEN length(flowcell) % 2 = 0 THEN '' ELSE 'FC' END) AS flowcell FROM r UNION ALL SELECT 'EAS9', 'FC1'),
d AS (SELECT instrument, flowcell AS directory, max(mtime) FILTER (WHERE file = 'RTAComplete.txt') AS t FROM r GROUP BY instrument, flowcell)
SELECT w.instrument, w.flowcell, CASE WHEN count(directory) = 0 THEN 'INVALID_FLOWCELL' ELSE coalesce(strftime(max(t), '%Y-%m-%d'), 'NONE') END AS finished FROM w LEFT JOIN d ON w.instrument = d.instrument AND contains(directory, w.flowcell) GROUP BY w.instrument, w.flowcell""")
def run_finished_date(spark, sf_dir):
    files = load(spark, sf_dir, RUN_FILES)
    short = F.when(F.length("flowcell") % 2 == 0, F.regexp_replace("flowcell", "FC", "")).otherwise(F.col("flowcell"))
    wanted = files.select("instrument", short.alias("flowcell")).distinct().unionByName(spark.createDataFrame([("EAS9", "FC1")], "instrument string, flowcell string"))
    return U.run_finished_date(wanted, files)


@query("run_ready", ctes(r=RUN_FILES) + """, s AS (SELECT instrument, flowcell, bool_or(file = '.rsync_finished') AS f, bool_or(file = 'RTAComplete.txt') AS c FROM r GROUP BY instrument, flowcell)
SELECT instrument, flowcell, f AS ready, NOT f AND c AS mark FROM s""")
def run_ready(spark, sf_dir):
    """Runs of unknown version, whose copy markers say nothing; run_ready_by_version has the others."""
    return U.run_ready(load(spark, sf_dir, RUN_FILES), F.lit("2030-01-01 00:00:00").cast("timestamp"))


CYCLES = "SELECT concat('L00', CAST(lane AS VARCHAR)) AS lane, concat('C', CAST(CAST(floor(clusters_raw) AS BIGINT) + lane AS VARCHAR), '.1') AS cycle, read_no FROM s"
PER = lambda w: f"(SELECT lane, count(DISTINCT cycle) AS n, CAST(max(CAST(regexp_replace(regexp_replace(cycle, '1$', ''), '[^0-9]', '', 'g') AS INT)) AS INT) AS m FROM c WHERE {w} GROUP BY lane)"


@query("transfer_progress", ctes(s=LANE_SUMMARY) + f", c AS ({CYCLES}) SELECT coalesce(a.lane, b.lane) AS lane, coalesce(a.n, 0) AS inst_cycles, a.m AS inst_last_cycle, coalesce(b.n, 0) AS dest_cycles, b.m AS dest_last_cycle FROM {PER("lane <> 'L003'")} a FULL JOIN {PER("read_no = 1 AND lane <> 'L005'")} b ON a.lane = b.lane")
def transfer_progress(spark, sf_dir):
    s = load(spark, sf_dir, LANE_SUMMARY)
    c = s.select(F.concat(F.lit("L00"), F.col("lane").cast("string")).alias("lane"), F.concat(F.lit("C"), (F.floor("clusters_raw") + F.col("lane")).cast("string"), F.lit(".1")).alias("cycle"), "read_no")
    return U.transfer_progress(c.where("lane <> 'L003'"), c.where("read_no = 1 AND lane <> 'L005'"))


@query("archive_candidates", "SELECT concat('/d/', CAST(o_orderkey AS VARCHAR)) AS directory FROM orders WHERE o_orderdate = DATE '1996-03-15' - INTERVAL 2 DAY")
def archive_candidates(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("run_date"), F.concat(F.lit("run;/d/"), F.col("o_orderkey").cast("string"), F.lit(";x")).alias("line"))
    return U.archive_candidates(o, F.lit("1996-03-15").cast("date"))
