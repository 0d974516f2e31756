"""Queries through reports, small files, name rules and streams, with the SQL they are compared with.

Derived tables are written by a sink (or as the text that the source expects) to the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import reads as R
from ..operators import genomes
from ..operators import metrics as M
from ..operators import reads as O
from ..operators import runs as U
from ..operators import samples as S
from ..operators import suite
from ..sources import reports, sequences, tables, xml
from ..sources.shared import new_folder, write_folders
from ..streaming import runs as T
from .fixtures import BARCODES, FLOWCELLS, LANE_BARCODES, LANE_SUMMARY, READS, RUN_FILES, RUN_MARKERS, SAMPLE_SHEET, ctes, load
from .read_queries import SQL as SQL_OF
from .read_queries import WITH, dictionary, reads, records

READS_SQL = READS.format(orders="orders")
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def files_of(spark: SparkSession, lines: DataFrame, kind: str) -> str:
    """Writes (name, at, value) as a text file for each name, its lines by `at`, in folders name=...; returns the path."""
    path = new_folder(spark, kind)
    lines.select("name", "at", "value").repartition("name").sortWithinPartitions("name", "at").select("name", "value").write.partitionBy("name").text(path)
    return path


def name_of() -> Column:
    return F.regexp_extract("file", "name=([^/]*)/", 1).alias("name")


# sources and sinks of samples


@query("barcode_definition_round_trip", ctes(b=BARCODES) + ", m AS (SELECT min(length(seq)) AS a, max(length(seq)) AS b FROM b) SELECT tag, CASE WHEN m.b - m.a = 3 AND length(seq) = m.a THEN concat(seq, 'CTC') ELSE seq END AS seq FROM b CROSS JOIN m")
def barcode_definition_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "barcodes")
    reports.write_barcode_definition(S.pad_barcodes(load(spark, sf_dir, BARCODES)), path)
    return tables.read_barcodes(spark, path).select("tag", "seq")


TAG = "CASE WHEN contains(lane_barcode, '-') THEN regexp_replace(lane_barcode, '^[0-9]-', '') ELSE '' END"


@query("sample_sheet_round_trip", ctes(b=BARCODES, l=LANE_BARCODES) + f"SELECT 'FC1' AS flowcell, lane, 'dummy_library' AS library, 'dummy_sample' AS sample, seq, x.tag AS tag, 'n' AS control, 'r1' AS recipe, 'someone' AS operator FROM (SELECT substr(lane_barcode, 1, 1) AS lane, {TAG} AS tag FROM l) x JOIN b ON x.tag = b.tag")
def sample_sheet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "sheet")
    reports.write_sample_sheet(S.build_sample_sheet(load(spark, sf_dir, LANE_BARCODES), load(spark, sf_dir, BARCODES), "FC1", strict=False), path, "someone")
    return tables.read_sample_sheet(spark, path).drop("line_no")


@query("sample_dirs_file", ctes(s=SAMPLE_SHEET) + "SELECT flowcell, CAST(lane AS VARCHAR) AS lane, seq, tag, concat('bin', seq) AS bin FROM s")
def sample_dirs_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "dirs")
    x = F.lit("x")
    load(spark, sf_dir, SAMPLE_SHEET).select(F.concat_ws(",", "flowcell", "lane", x, x, "seq", F.concat(F.lit(" "), "tag"), x, x, x, F.concat(F.lit("bin"), "seq")).alias("value")).write.text(path)
    return tables.read_sample_dirs(spark, path).drop("line_no")


@query("barcode_rows", ctes(b=BARCODES) + """, r AS (SELECT tag, seq, row_number() OVER (ORDER BY tag, k) AS i FROM b CROSS JOIN (VALUES (0), (1)) t(k))
SELECT x.tag AS tag1, y.tag AS tag2, CAST(abs(length(x.seq) - length(y.seq)) + (SELECT count(*) FROM range(1, 10) g(p) WHERE p <= least(length(x.seq), length(y.seq)) AND substr(x.seq, p, 1) <> substr(y.seq, p, 1)) AS INT) AS distance
FROM r x JOIN r y ON x.i < y.i WHERE abs(length(x.seq) - length(y.seq)) + (SELECT count(*) FROM range(1, 10) g(p) WHERE p <= least(length(x.seq), length(y.seq)) AND substr(x.seq, p, 1) <> substr(y.seq, p, 1)) < 4""")
def barcode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the map stands twice."""
    twice = load(spark, sf_dir, BARCODES).select("tag", "seq", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    rows = twice.select("tag", "seq", F.concat("tag", text("k")).alias("line_no"))
    return S.barcode_distance(rows, 4).select("tag1", "tag2", F.col("distance").cast("int").alias("distance"))


@query("lane_info_lookup", ctes(f=FLOWCELLS) + "SELECT concat(lane_barcode, '/', CAST(id AS VARCHAR)) AS lane_barcode, concat('D', CAST(id % 50 AS VARCHAR)) AS name, 100 AS read_length, reference AS reference_path, sample, library FROM f")
def lane_info_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = load(spark, sf_dir, FLOWCELLS).withColumn("lb", F.concat("lane_barcode", F.lit("/"), text("id")))
    one = F.struct(F.col("lb").alias("id"), F.col("reference").alias("reference_path"), "sample", "library", F.nullif("chip", F.lit("")).alias("chip_design"))
    definition = f.groupBy((F.col("id") % 50).alias("d")).agg(F.collect_list(one).alias("info")).select(F.concat(F.lit("D"), text("d")).alias("name"), F.lit("paired").alias("type"), F.lit(100).alias("read_length"), "info")
    return S.lane_info_lookup(definition, f.select(F.col("lb").alias("lane_barcode"))).select("lane_barcode", "name", "read_length", "reference_path", "sample", "library")


# run parameters, lane information, configuration


@query("run_params_round_trip", """SELECT concat('N', CAST(n_nationkey AS VARCHAR)) AS name, concat('/ref/', n_name) AS reference_path, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE concat('lib', CAST(n_nationkey AS VARCHAR)) END AS library_name,
  CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name END AS sample_name, n_nationkey % 2 = 0 AS filter_phix, CAST(NULL AS VARCHAR) AS chip_design, CASE WHEN n_nationkey % 5 = 0 THEN 'high' ELSE 'normal' END AS scheduler_queue FROM nation""")
def run_params_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("n_nationkey"), F.lit(None).cast("string")
    rows = base(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), text(k)).alias("file"), F.concat(F.lit("/ref/"), "n_name").alias("reference_path"), F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("lib"), text(k))).alias("library_name"), F.when(k % 4 != 0, F.col("n_name")).alias("sample_name"),
        (k % 2 == 0).alias("filter_phix"), none.alias("chip_design"), none.alias("rg_pu_field"), none.alias("fc_barcode"), F.when(k % 5 == 0, "high").alias("scheduler_queue"))
    path = new_folder(spark, "params")
    reports.write_run_params(tables.run_params_lines(rows), path, by_file=True)
    return tables.read_run_params(spark, path).select(F.regexp_extract("file", "file=([^/]*)/", 1).alias("name"), "reference_path", "library_name", "sample_name", "filter_phix", "chip_design", "scheduler_queue")


@query("lane_info", ctes(f=FLOWCELLS) + """SELECT id, CASE WHEN id % 3 = 0 THEN 'paired' ELSE 'fragment' END AS type, library, sample, nullif(chip, '') AS chip_design, CASE WHEN id % 2 = 0 THEN '101+7' ELSE '76' END AS num_cycles,
  CASE WHEN id % 4 = 0 THEN 'sequence' WHEN id % 4 = 1 THEN NULL ELSE concat('/data', reference) END AS reference_path FROM f""")
def lane_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, k = load(spark, sf_dir, FLOWCELLS), F.col("id")
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("None"))
    build = F.when(k % 4 == 0, "Sequence").when(k % 4 == 1, "/elsewhere/x").otherwise(F.concat(F.lit(" /data"), "reference", F.lit(" more")))
    line = F.concat(F.lit("FLOWCELL_TYPE="), F.when(k % 3 == 0, "pe").otherwise("fr"), F.lit(";Library="), F.coalesce("library", F.lit("")), F.lit(" ;Sample="), known("sample"), F.lit(";ChipDesign="), known("chip"),
                    F.lit(";NUMBER_OF_CYCLES_READ1=76"), F.when(k % 2 == 0, ";NUMBER_OF_CYCLES_READ2=101+7").otherwise(""), F.lit(";BUILD_PATH="), build)
    return f.select("id", tables.parse_lane_info(line, "/data").alias("i")).select("id", "i.*")


@query("analysis_lanes_file", """SELECT concat('N', CAST(c_nationkey AS VARCHAR)) AS name, coalesce(max_by(concat(CAST(1 + c_custkey % 8 AS VARCHAR), '3'), c_custkey) FILTER (WHERE c_custkey % 7 = 1), '') AS lanes FROM customer GROUP BY c_nationkey""")
def analysis_lanes_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    line = F.when(k % 7 == 0, "12:ANALYSIS none").when(k % 7 == 1, F.concat(text(1 + k % 8), F.lit("3:ANALYSIS eland"))).when(k % 7 == 2, "x12:ANALYSIS eland").otherwise("# text")
    lines = base(spark, sf_dir, "customer").select(F.concat(F.lit("N"), text("c_nationkey")).alias("name"), k.alias("at"), line.alias("value"))
    return tables.read_analysis_lanes(spark, files_of(spark, lines, "config")).select(name_of(), "lanes")


# run folders


@query("run_listing", ctes(r=RUN_FILES) + "SELECT DISTINCT instrument, flowcell, true AS dated FROM r")
def run_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "runs")
    write_folders(load(spark, sf_dir, RUN_FILES).select("instrument", "flowcell", "file").distinct(), path, "instrument", "flowcell")
    plain = lambda c: F.regexp_replace(c, "^[a-z]+=", "").alias(c)
    got = tables.list_runs(spark, path).where(F.col("file").startswith("part-"))
    return got.select(plain("instrument"), plain("flowcell"), (F.col("mtime") > "2020-01-01").alias("dated")).distinct()


@query("run_paths", """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE t END AS type, CASE WHEN o_orderkey % 6 < 2 THEN concat('FC', CAST(o_custkey AS VARCHAR), 'AAXX') END AS fc, CASE WHEN o_orderkey % 6 < 2 THEN 'USI-EAS09' END AS instrument,
  CASE o_orderkey % 6 WHEN 0 THEN '080205' WHEN 1 THEN '071008' END AS date_created, CASE WHEN o_orderkey % 6 < 4 THEN concat('s_', CAST(o_custkey AS VARCHAR), CASE WHEN o_orderkey % 6 = 0 THEN '.x+y' ELSE '' END) END AS sample
FROM (SELECT *, CASE WHEN o_orderkey % 12 < 6 THEN 'Fragment' WHEN o_orderkey % 24 < 12 THEN 'PE' ELSE 'PE1' END AS t FROM orders)""")
def run_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), text("o_custkey")
    kind = F.when(k % 12 < 6, "").when(k % 24 < 12, "_PE").otherwise("_PE1")
    fc, sample = F.concat(F.lit("FC"), c, F.lit("AAXX-L"), text(1 + k % 8), F.lit("-")), F.concat(F.lit("s_"), c)
    path = F.concat(F.lit("/data/"), F.when(k % 6 == 0, F.concat(F.lit("080205_USI-EAS09_0002"), kind, F.lit("_"), fc, sample, F.lit(".x+y"))).when(k % 6 == 1, F.concat(F.lit("10-58-47_1192204727-CF071008_USI-EAS09_0002"), kind, F.lit("_"), fc, sample))
                    .when(k % 6 == 2, F.concat(F.lit("09-26-07_10-13-02_1190819582"), kind, F.lit("-"), sample)).when(k % 6 == 3, F.concat(kind, F.when(kind == "", "").otherwise("_"), fc, sample)).when(k % 6 == 4, F.lit("nothing")).otherwise(F.concat(F.lit("L5-"), sample)), F.lit("/data_dir/x"))
    return base(spark, sf_dir, "orders").select(k.alias("id"), N.parse_run_path(path).alias("p")).select("id", "p.type", "p.fc", "p.instrument", "p.date_created", "p.sample")


@query("rta_versions", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN concat('1.', CAST(o_orderkey % 13 AS VARCHAR)) WHEN o_orderkey % 4 = 1 THEN NULL WHEN o_orderkey % 4 = 2 THEN concat('1.9.', CAST(o_custkey AS VARCHAR)) END AS version FROM orders""")
def rta_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    params = F.when(k % 4 == 0, F.concat(F.lit("<RunParameters><Setup><RTAVersion>1."), text(k % 13), F.lit("</RTAVersion></Setup></RunParameters>"))).when(k % 4 == 1, "<RunParameters><Setup/></RunParameters>")
    copied = F.when(k % 4 == 3, "nothing\n").otherwise(F.concat(F.lit("1/2/2011\nIllumina  RTA 1.9."), text("o_custkey"), F.lit("\r\nmore\n")))
    return base(spark, sf_dir, "orders").select(k.alias("id"), N.rta_version(params, copied).alias("version"))


READY = """f AS (SELECT DISTINCT instrument, flowcell, file FROM r), v AS (SELECT instrument, flowcell, max(version) AS version, max(mtime) FILTER (WHERE file = 'Basecalling_Netcopy_complete.txt') AS t FROM r GROUP BY instrument, flowcell),
j AS (SELECT v.*, (SELECT count(*) FROM f WHERE f.instrument = v.instrument AND f.flowcell = v.flowcell AND file IN ('Basecalling_Netcopy_complete.txt', 'Basecalling_Netcopy_complete_READ1.txt', 'Basecalling_Netcopy_complete_READ2.txt')) = 3 AS three,
  (instrument, flowcell) IN (SELECT (instrument, flowcell) FROM f WHERE file = '.rsync_finished') AS fin, (instrument, flowcell) IN (SELECT (instrument, flowcell) FROM f WHERE file = 'RTAComplete.txt') AS comp FROM v)
"""


@query("run_ready_by_version", ctes(r=RUN_MARKERS) + "," + READY + "SELECT instrument, flowcell, CASE WHEN fin THEN true WHEN flowcell LIKE '%SN601%' OR comp THEN false ELSE three AND coalesce(version LIKE '%1.9%', false) AND epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(t) >= 3600 END AS ready, NOT fin AND comp AND flowcell NOT LIKE '%SN601%' AS mark FROM j")
def run_ready_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, RUN_MARKERS)
    versions = files.groupBy("instrument", "flowcell").agg(F.max("version").alias("version"))
    return U.run_ready(files.drop("version"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), versions)


@query("ready_run_stream", ctes(r=RUN_MARKERS) + "," + READY + "SELECT instrument, flowcell FROM j WHERE fin OR (flowcell NOT LIKE '%SN601%' AND (comp OR (three AND version LIKE '%1.9%' AND epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(t) >= 3600)))")
def ready_run_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing arrives in one poll, and a file of no meaning in a later one, at which runs with a completion marker start."""
    listing, done, check = (new_folder(spark, kind) for kind in ("listing", "started", "stream"))
    rows = load(spark, sf_dir, RUN_MARKERS).withColumn("mtime", F.col("mtime").cast("timestamp"))
    for part in (rows, rows.limit(1).withColumns({"file": F.lit("other")})):
        part.write.mode("append").parquet(listing)
        T.new_ready_runs(T.listing_stream(spark, listing), done, check, F.lit("2024-01-20 00:00:00").cast("timestamp")).awaitTermination()
    return spark.read.parquet(done).where("ready").select("instrument", "flowcell")


# summaries and metric texts

SUMS = "(SELECT flowcell, read_no, lane, CAST(sum(CASE WHEN yield_kb = '' THEN 0 ELSE CAST(yield_kb AS BIGINT) END) AS BIGINT) AS y, floor(sum(clusters_raw)) AS c FROM s GROUP BY flowcell, read_no, lane)"


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.lane_summary(load(spark, sf_dir, LANE_SUMMARY)).select("flowcell", "read_no", "lane", "yield_kb", F.floor("clusters_raw").alias("c"))


@query("lane_summary_file", ctes(s=LANE_SUMMARY) + f"SELECT flowcell AS run, read_no, lane, CASE WHEN lane = 4 THEN 0 ELSE CAST(y AS DOUBLE) END AS yield_kb, CAST(c AS DOUBLE) AS clusters_raw, 0::DOUBLE AS error_pf, CASE WHEN read_no = 1 THEN lane + 0.5::DOUBLE ELSE 0 END AS phasing, 0::DOUBLE AS prephasing FROM {SUMS}")
def lane_summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    both = lambda c: F.array_join(F.sort_array(F.collect_list(c)), "")
    lane = tag("Lane", F.concat(tag("laneNumber", text("lane")), tag("laneYield", F.when(F.col("lane") == 4, " ").otherwise(text("yield_kb"))), tag("clusterCountRaw", tag("mean", text("c"))), tag("errorPF", tag("mean", F.lit("")))))
    more = tag("Lane", F.concat(tag("laneNumber", text("lane")), tag("phasingApplied", F.concat(text("lane"), F.lit(".5")))))
    per = lanes(spark, sf_dir).groupBy("flowcell", "read_no").agg(both(lane).alias("lanes"), both(more).alias("more"))
    read = lambda c: tag("Read", F.concat(tag("readNumber", text("read_no")), F.col(c)))
    page = per.groupBy("flowcell").agg(both(read("lanes")).alias("main"), F.array_join(F.collect_list(F.when(F.col("read_no") == 1, read("more"))), "").alias("rest"))
    whole = tag("Summary", F.concat(tag("ChipSummary", tag("RunFolder", F.col("flowcell"))), tag("LaneResultsSummary", F.col("main")), tag("ExpandedLaneSummary", F.col("rest"))))
    return xml.read_lane_summary(spark, files_of(spark, page.select(F.col("flowcell").alias("name"), F.lit(0).alias("at"), whole.alias("value")), "summary")).select("run", "read_no", "lane", "yield_kb", "clusters_raw", "error_pf", "phasing", "prephasing")


@query("html_summary_file", ctes(s=LANE_SUMMARY) + f"SELECT concat(flowcell, '-', CAST(lane AS VARCHAR)) AS name, read_no, CAST(lane AS VARCHAR) AS lane, CAST(y AS VARCHAR) AS yield, '3' AS sd, CASE WHEN read_no = 1 THEN '0.3' END AS phasing FROM {SUMS}")
def html_summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = lambda *rows: F.concat(F.lit("<table>"), *[F.concat(F.lit("<tr>\n"), *[F.concat(F.lit("<td>"), c if isinstance(c, Column) else F.lit(c), F.lit(" </td>\n")) for c in r], F.lit("</tr>\n")) for r in rows], F.lit("</table>"))
    one = lanes(spark, sf_dir)
    main = F.concat(F.lit("<h2>Lane Results Summary"), F.when(F.col("read_no") == 2, " : Read 2").otherwise(""), F.lit("</h2>"), table(["Lane", "Yield"], [text("lane"), F.concat(text("yield_kb"), F.lit(" +/- 3"))]))
    rest = F.when(F.col("read_no") == 1, F.concat(F.lit("<h2>Expanded Lane Summary</h2>"), table(["Lane", "% Phasing"], [text("lane"), "0.3"]))).otherwise("")
    got = xml.read_html_summary(spark, files_of(spark, one.select(F.concat_ws("-", "flowcell", text("lane")).alias("name"), F.col("read_no").alias("at"), F.concat(main, rest).alias("value")), "html"))
    mean, _, sd = N.split_mean_sd(F.lit("Yield"), F.col("values")["Yield"])
    return got.select(name_of(), "read_no", F.col("values")["Lane"].alias("lane"), mean.alias("yield"), sd.alias("sd"), F.col("values")["% Phasing"].alias("phasing"))


@query("mean_and_deviation", "SELECT l_orderkey, l_linenumber, count(*) AS n, CASE WHEN l_returnflag = 'R' THEN 'plain' ELSE CAST(l_partkey AS VARCHAR) END AS mean, CASE WHEN l_returnflag <> 'R' THEN concat('+/- SD ', l_linestatus) END AS sd_name, CASE WHEN l_returnflag <> 'R' THEN CAST(l_suppkey AS VARCHAR) END AS sd FROM lineitem GROUP BY ALL")
def mean_and_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("l_returnflag") == "R", "plain").otherwise(F.concat(text("l_partkey"), F.lit(" +/-  "), text("l_suppkey")))
    mean, name, sd = N.split_mean_sd("l_linestatus", value)
    return base(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", mean.alias("mean"), name.alias("sd_name"), sd.alias("sd")).groupBy("l_orderkey", "l_linenumber", "mean", "sd_name", "sd").agg(F.count(F.lit(1)).alias("n"))


@query("map_stats", """SELECT o_orderkey AS id, n AS read_no, CASE WHEN n = 1 OR o_orderkey % 2 = 0 THEN o_custkey + n + 0.5::DOUBLE ELSE 0 END AS pct_mapped, CASE WHEN o_orderkey % 3 = 0 THEN 0 WHEN n = 1 THEN 0.25::DOUBLE ELSE 0 END AS pct_mismatch FROM orders CROSS JOIN (VALUES (1), (2)) t(n)""")
def map_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    report = F.concat(F.lit("x\nPercentMapped : "), text(c + 1), F.lit(".5%\n"), F.when(k % 3 != 0, "PercentMismatch : 0.25%\r\n").otherwise(""), F.when(k % 2 == 0, F.concat(F.lit("PercentMapped  :  "), text(c + 2), F.lit(".5%\n"))).otherwise(""))
    rows = base(spark, sf_dir, "orders").select(k.alias("id"), report.alias("t"), F.explode(F.array(F.lit(1), F.lit(2))).alias("read_no"))
    return rows.select("id", "read_no", tables.parse_map_stats("t", "read_no").alias("m")).select("id", "read_no", "m.*")


LANE_OF = "CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey - o_orderkey % 4 ELSE o_orderkey END"


@query("unique_percent", f"SELECT {LANE_OF} AS lane, CASE WHEN count(*) = 1 AND max(o_orderkey) % 5 <> 0 THEN max(o_custkey) + 0.5::DOUBLE END AS pct_unique FROM orders GROUP BY 1")
def unique_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    report = F.when(k % 5 == 0, "no such line").otherwise(F.concat(F.lit("Total : 7\n% Unique Reads : "), text("o_custkey"), F.lit(".5 %\n")))
    return tables.parse_unique_percent(base(spark, sf_dir, "orders").select(F.when(k % 4 < 2, k - k % 4).otherwise(k).alias("lane"), report.alias("text")))


CAPTURE = """c AS (SELECT concat('N', CAST(c_nationkey AS VARCHAR)) AS name, count(*) AS n, count(*) FILTER (WHERE c_custkey % 3 = 0) AS d, count(*) FILTER (WHERE c_acctbal > 0) AS a FROM customer GROUP BY c_nationkey)
"""


def capture_files(spark: SparkSession, sf_dir: str) -> str:
    some = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    c = base(spark, sf_dir, "customer").groupBy(F.concat(F.lit("N"), text("c_nationkey")).alias("name")).agg(F.count(F.lit(1)).alias("n"), some(F.col("c_custkey") % 3 == 0).alias("d"), some(F.col("c_acctbal") > 0).alias("a"))
    line = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    rows = [line("Total Reads Produced: ,", text("n")), line("Duplicate Reads: ,", text("d"), ",(12.5%)"), line("Total Reads Aligned: ,", text("a"), ",(50%),Paired:,", text("d"), ",Mates:,7"), line("Targets Hit: ,", text("a"), ",(25%)"), line("Average Coverage: ,x,(", text("n"), ".25)"),
            line("Non target regions with high coverage: ,3"), line("Bases Targeted: ,", text(F.col("n") * 10)), line("Bases with 10+ coverage: ,", text("d"), ",(5%)"), line("no number here,5")]
    return files_of(spark, c.select("name", F.posexplode(F.array(*rows)).alias("at", "value")), "capture")


@query("capture_report_file", "WITH " + CAPTURE + "SELECT name, CAST(n AS DOUBLE) AS total_reads, CAST(d AS DOUBLE) AS duplicate_reads, 12.5::DOUBLE AS pct_duplicate_reads, CAST(a AS DOUBLE) AS aligned_reads, CAST(d AS DOUBLE) AS reads_paired, 7::DOUBLE AS reads_paired_mapped_mates, CAST(a AS DOUBLE) AS targets_hit, n + 0.25::DOUBLE AS average_coverage, 3::DOUBLE AS non_target_hits, CAST(n * 10 AS DOUBLE) AS target_bases, CAST(d AS DOUBLE) AS bases_10x, 0::DOUBLE AS bases_40x FROM c")
def capture_report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = tables.read_capture_report(spark, capture_files(spark, sf_dir))
    return got.select(name_of(), "total_reads", "duplicate_reads", "pct_duplicate_reads", "aligned_reads", "reads_paired", "reads_paired_mapped_mates", "targets_hit", "average_coverage", "non_target_hits", "target_bases", "bases_10x", "bases_40x")


@query("capture_texts", "WITH " + CAPTURE + """SELECT name, concat_ws(' ', 'TOTAL_READS', n, 'DUPLICATE_READS', d, 'PERCENT_DUPLICATE_READS 12.5 TOTAL_ALIGNED_READS', a, 'PERCENT_ALIGNED_READS 50 READS_PAIRED', d, 'READS_PAIRED_MAPPED_MATES 7 BUFFER_ALIGNED_READS 0 PERCENT_BUFFER_ALIGNED_READS 0 TARGET_ALIGNED_READS 0 PERCENT_TARGET_ALIGNED_READS 0 AVERAGE_COVERAGE', concat(n, '.25'),
  'READS_ON_TARGET_OR_BUFFER 0 PERCENT_READS_ON_TARGET_OR_BUFFER 0 TOTAL_EXPECTED_ALIGNED_READS 0 TOTAL_CALC_ALIGNED_READS 0 TARGETS_HIT', a, 'PERCENT_TARGETS_HIT 25 TARGET_BUFFERS_HIT 0 PER_TARGET_BUFFERS_HITS 0 TOTAL_TARGETS 0 HIGH_COVERAGE_NON_TARGET_HITS 3 BASES_ON_TARGET', n * 10, 'BASES_ON_BUFFER 0',
  'ONE_COVERAGE_BASES 0 PER_ONE_COVERAGE_BASES 0 FOUR_COVERAGE_BASES 0 PER_FOUR_COVERAGE_BASES 0 TEN_COVERAGE_BASES', d, 'PER_TEN_COVERAGE_BASES 5 TWENTY_COVERAGE_BASES 0 PER_TWENTY_COVERAGE_BASES 0 FORTY_COVERAGE_BASES 0 PER_FORTY_COVERAGE_BASES 0') AS string,
  concat_ws(concat(chr(13), chr(10)), concat('Total Reads Produced = ', n), concat('Duplicate Reads = ', d, ' (12.5)%'), concat('Total Reads Aligned = ', a, ' (50)%'), concat('Paired Reads = ', d), 'Reads Paired with Mapped Mates = 7', 'Buffer Aligned Reads = 0 (0)%', 'Target Aligned Reads = 0 (0)%', concat('Average Coverage = ', n, '.25'),
  'Reads on Target or Buffer = 0 (0)%', 'Total Aligned Reads (Expected) = 0', 'Total Aligned Reads (Calculated) = 0', concat('Targets Hit = ', a, ' (25)%'), 'Target Buffers Hit = 0 (0)%', 'Total Targets = 0', 'Non Target Hits = 3', concat('Bases on Target = ', n * 10), 'Buffer Bases = 0',
  'Bases with 1+ Coverage = 0 (0)%', 'Bases with 4+ Coverage = 0 (0)%', concat('Bases with 10+ Coverage = ', d, ' (5)%'), 'Bases with 20+ Coverage = 0 (0)%', 'Bases with 40+ Coverage = 0 (0)%', '') AS report FROM c""")
def capture_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = tables.read_capture_report(spark, capture_files(spark, sf_dir))
    return got.select(name_of(), reports.capture_result_string().alias("string"), reports.capture_text().alias("report"))


TREE = WITH + """, t AS (SELECT CASE WHEN NOT paired THEN 'FRAGMENT' WHEN read_no = 1 THEN 'READ1' ELSE 'READ2' END AS k, count(*) AS n, count(*) FILTER (WHERE NOT unmapped) AS m, CAST(sum(length(seq)) AS BIGINT) AS b FROM reads GROUP BY 1)
"""


def metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, at, key, value) of alignment metrics, with the bases as a metric below each read type."""
    got = M.alignment_metrics(reads(spark, sf_dir))
    place = F.ascii(F.substring("read_type", -1, 1)) * 10
    row = lambda path, at, key, value: F.struct(F.array(F.col("read_type"), *map(F.lit, path)).alias("path"), (place + at).alias("at"), F.lit(key).alias("key"), text(value).alias("value"))
    return got.select(F.explode(F.array(row([], 0, "Total", "total_reads"), row([], 1, "Mapped<&>", "mapped_reads"), row(["Bases"], 2, "All", "total_bases"))).alias("r")).select("r.*")


@query("metrics_text", TREE + "SELECT string_agg(concat(chr(13), chr(10), k, chr(13), chr(10), 'Total : ', n, chr(13), chr(10), 'Mapped<&> : ', m, chr(13), chr(10), chr(13), chr(10), 'Bases', chr(13), chr(10), 'All : ', b, chr(13), chr(10)), '' ORDER BY right(k, 1)) AS text FROM t")
def metrics_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.metrics_text(metric_tree(spark, sf_dir))


@query("metrics_xml", TREE + """SELECT concat('<AnalysisMetrics>', string_agg(concat('<', k, ' Total="', n, '" Mapped="', m, '"><Bases All="', b, '"/></', k, '>'), '' ORDER BY right(k, 1)), '</AnalysisMetrics>') AS xml FROM t""")
def metrics_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.metrics_xml(metric_tree(spark, sf_dir).withColumn("key", F.regexp_replace("key", "<&>", "")))


@query("metrics_xml_depths", TREE + """, l AS (SELECT k, n, m, b, right(k, 1) AS o FROM t)
SELECT concat('<AnalysisMetrics>', string_agg(concat('<', k, ' Total="', n, '"><Mapped Reads="', m, '"><Bases><All All="', b, '"/></Bases></Mapped></', k, '>'), '' ORDER BY o), '</AnalysisMetrics>') AS xml FROM l""")
def metrics_xml_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four levels, one of which has no row of its own."""
    tree = metric_tree(spark, sf_dir).withColumn("key", F.regexp_replace("key", "<&>", ""))
    top, key = F.col("path")[0], F.col("key")
    path = F.when(key == "Mapped", F.array(top, F.lit("Mapped"))).when(key == "All", F.array(top, F.lit("Mapped"), F.lit("Bases"), F.lit("All"))).otherwise(F.col("path"))
    return reports.metrics_xml(tree.select(path.alias("path"), "at", F.when(key == "Mapped", "Reads").otherwise(key).alias("key"), "value"))


@query("quality_csv_file", WITH + """, b AS (SELECT CASE WHEN paired AND read_no = 2 THEN 2 ELSE 1 END AS series, CAST(unnest(range(1, length(qual) + 1)) AS INT) AS position, CASE WHEN neg THEN reverse(qual) ELSE qual END AS q FROM reads),
q AS (SELECT position, floor(1000 * avg(ascii(substr(q, position, 1)) - 33) FILTER (WHERE series = 1)) / 1000 AS m1, floor(1000 * avg(ascii(substr(q, position, 1)) - 33) FILTER (WHERE series = 2)) / 1000 AS m2 FROM b GROUP BY position)
SELECT concat(CAST(position AS VARCHAR), ',', CAST(m1 AS VARCHAR), ',', CAST(m2 AS VARCHAR), ',') AS value FROM q""")
def quality_csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "quality")
    reports.write_quality_csv(M.quality_by_position(reads(spark, sf_dir)).withColumn("mean_quality", F.floor(1000 * F.col("mean_quality")) / 1000), path)
    return spark.read.text(path)


# sequence files


@query("fastq_union", WITH + "SELECT read_no, concat('@', qname, '/', CAST(read_no AS VARCHAR)) AS header, seq, qual FROM reads")
def fastq_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = []
    for n in (1, 2):
        paths.append(new_folder(spark, f"reads{n}"))
        sequences.write_fastq(records(spark, sf_dir).where(F.col("read_no") == n), paths[-1])
    return sequences.read_fastq(spark, paths).select(F.regexp_extract("file", "/reads([12])-", 1).cast("int").alias("read_no"), "header", "seq", "qual")


@query("sam_tags_round_trip", WITH + """SELECT qname, read_no, concat('NM:i:', CAST(pos % 7 AS VARCHAR), ' XF:f:0.5', CASE WHEN md IS NOT NULL THEN concat(' MD:Z:', md) ELSE '' END, ' RG:Z:g') AS tags, '@HD VN:1.0 SO:coordinate|@CO a comment' AS other,
  CASE WHEN rname LIKE 'chr%' AND rname <> 'chr9' THEN concat('M5:', rname) END AS sq_rest, 'DS:some text' AS rg_rest, 'CL:tool -x 1' AS pg_rest FROM reads""")
def sam_tags_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    sq = dictionary(spark).withColumn("rest", F.when(F.col("sn").startswith("chr"), F.concat(F.lit("M5:"), "sn")))
    one = spark.range(1)
    rg = one.select(F.lit("g").alias("id"), F.lit("s").alias("sm"), *[none.alias(c) for c in ("lb", "pu", "pl", "cn")], F.lit(None).cast("timestamp").alias("dt"), F.lit("DS:some text").alias("rest"))
    pg = one.select(F.lit("tool").alias("id"), F.lit("1").alias("vn"), F.lit("CL:tool -x 1").alias("rest"))
    other = one.select(F.explode(F.array(F.struct(F.lit(0).alias("at"), F.lit("@HD\tVN:1.0\tSO:coordinate").alias("value")), F.struct(F.lit(1).alias("at"), F.lit("@CO\ta comment").alias("value")))).alias("r")).select("r.*")
    rows = reads(spark, sf_dir).withColumns({"tag_text": F.array(F.concat(F.lit("NM:i:"), text(F.col("pos") % 7)), F.lit("XF:f:0.5")), "rg": F.lit("g")})
    path = new_folder(spark, "sam")
    sequences.write_sam(rows, sq, rg, pg, path, other)
    header = sequences.sam_header(spark, path)
    got, sq2, rg2, pg2 = sequences.read_sam(spark, path, header)
    head = sequences.read_sam_other(spark, path, header).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda e: F.translate(e["value"], "\t", " ")), "|").alias("other"))
    lines = head.crossJoin(F.broadcast(rg2.select(F.col("rest").alias("rg_rest")))).crossJoin(F.broadcast(pg2.select(F.col("rest").alias("pg_rest"))))  # one row each
    named = got.join(O.small(sq2.select(F.col("sn").alias("rname"), F.col("rest").alias("sq_rest"))), "rname", "left")
    return named.crossJoin(F.broadcast(lines)).select("qname", "read_no", F.array_join("tag_text", " ").alias("tags"), "other", "sq_rest", "rg_rest", "pg_rest")


@query("sequence_file_order", "SELECT file, CAST(lane AS INT) AS lane, CAST(n AS INT) AS read_no FROM (SELECT *, concat('/f', CAST(o_orderkey AS VARCHAR), '/s_', CAST(lane AS VARCHAR), CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('_', CAST(n AS VARCHAR)) END, '_sequence.txt') AS file FROM (SELECT o_orderkey, 1 + o_custkey % 8 AS lane, CASE WHEN o_orderkey % 3 = 2 THEN 2 ELSE 1 END AS n FROM orders))")
def sequence_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    n = F.when(k % 3 == 0, "").when(k % 3 == 1, "_1").otherwise("_2")
    return O.order_pair_files(base(spark, sf_dir, "orders").select(F.concat(F.lit("/f"), text(k), F.lit("/s_"), text(1 + F.col("o_custkey") % 8), n, F.lit("_sequence.txt")).alias("file")))


@query("add_program", "SELECT n_name AS id, CAST(n_nationkey AS VARCHAR) AS vn FROM nation UNION ALL SELECT 'tool', '1.2'")
def add_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    pg = base(spark, sf_dir, "nation").select(F.col("n_name").alias("id"), text("n_nationkey").alias("vn"))
    return O.add_program(O.add_program(O.add_program(pg, "tool", "1.2"), "other", ""), "", "3")


CLIP = lambda lead, ln: f"CASE WHEN pos + span - 1 <= {ln} OR pos > {ln} THEN cigar ELSE {lead} END"


@query("clip_to_contig", WITH + """, c AS (SELECT qname, read_no, cigar, unmapped, CASE WHEN rname IN ('chr1', 'chr2', 'chr3', 'chr4', 'chr5', 'gi|9626372|ref|NC_001422.1|') THEN 40000 END AS ln, pos, CASE cigar WHEN '4S60M' THEN 60 WHEN '30M2I32M' THEN 62 WHEN '20M3D44M' THEN 67 ELSE 64 END AS span FROM reads),
k AS (SELECT *, ln - pos AS n FROM c)
SELECT qname, read_no, CASE WHEN unmapped OR ln IS NULL OR pos > ln OR pos + span - 1 <= ln THEN cigar
  WHEN cigar = '4S60M' THEN CASE WHEN n <= 4 THEN '64S' ELSE concat('4S', n - 4, 'M', 64 - n, 'S') END
  WHEN cigar = '30M2I32M' THEN CASE WHEN n = 0 THEN '64S' WHEN n <= 30 THEN concat(n, 'M', 64 - n, 'S') WHEN n <= 32 THEN concat('30M', n - 30, 'I', 64 - n, 'S') ELSE concat('30M2I', n - 32, 'M', 64 - n, 'S') END
  WHEN cigar = '20M3D44M' THEN CASE WHEN n = 0 THEN '64S' WHEN n <= 20 THEN concat(n, 'M', 64 - n, 'S') WHEN n >= 64 THEN cigar ELSE concat('20M3D', n - 20, 'M', 64 - n, 'S') END
  ELSE CASE WHEN n = 0 THEN '64S' ELSE concat(n, 'M', 64 - n, 'S') END END AS cigar FROM k""")
def clip_to_contig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.clip_to_contig(reads(spark, sf_dir), dictionary(spark).withColumn("ln", F.lit(40_000).cast("long"))).select("qname", "read_no", "cigar")


# genomes

LINES = "SELECT p_partkey AS line_no, CASE WHEN p_partkey % 10 = 0 THEN concat('>', p_name) WHEN p_partkey % 3 = 0 THEN repeat('ACGTN', 13) ELSE substr('ACGTACGTACGTACGTACGTACGT', 1, CAST(1 + p_partkey % 24 AS INT)) END AS line FROM part"


@query("masked_fasta", r"SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN concat('NNNNNNNNNNACGT', chr(10), 'NNNNNNNNNN') WHEN 1 THEN concat('AC', chr(10), 'NNNNNNNNNNGG', chr(10)) ELSE p_name END AS masked FROM part")
def masked_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    page = F.when(k % 3 == 0, F.concat(F.lit(">"), "p_name", F.lit("\nACGT\n>"), "p_name")).when(k % 3 == 1, F.concat(F.lit("AC\nx > "), "p_name", F.lit("\nGG\n"))).otherwise(F.col("p_name"))
    return base(spark, sf_dir, "part").select(k.alias("id"), genomes.mask_headers(page).alias("masked"))


@query("repacked_fasta", f"""WITH l AS ({LINES}), z AS (SELECT greatest(1, count(*) // 100) AS size FROM l), x AS (SELECT line_no, 0 AS k, CASE WHEN line LIKE '>%' THEN repeat('N', 50) WHEN length(line) < 50 THEN rpad(line, 50, 'N') ELSE line END AS line FROM l UNION ALL SELECT line_no, 1, repeat('N', 50) FROM l WHERE line LIKE '>%'),
o AS (SELECT row_number() OVER (ORDER BY line_no, k) - 1 AS i, line FROM x), b AS (SELECT CAST(i // size + 1 AS BIGINT) AS chunk, CAST(i % size + 1 AS BIGINT) AS line_no, line FROM o CROSS JOIN z)
SELECT * FROM b UNION ALL SELECT DISTINCT chunk, 0, concat('>fake', chunk) FROM b""")
def repacked_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomes.repack(spark.sql(LINES.replace("FROM part", "FROM {part}"), part=base(spark, sf_dir, "part")))


# extension and number formats


@query("registered_calculator", WITH + "SELECT 'contigs' AS calculator, concat(rname, '/', m) AS metric, CAST(CASE m WHEN 'reads' THEN n ELSE b END AS DOUBLE) AS value FROM (SELECT rname, count(*) AS n, sum(length(seq)) AS b FROM reads GROUP BY rname) CROSS JOIN (VALUES ('reads'), ('bases')) t(m)")
def registered_calculator(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite.register("contigs", lambda r: r.groupBy("rname").agg(F.count(F.lit(1)).alias("reads"), F.sum(F.length("seq")).alias("bases")))
    try:
        return suite.metric_suite(reads(spark, sf_dir), ["contigs"])
    finally:
        del suite.CALCULATORS["contigs"]


@query("mergeable_calculator", "WITH " + f"pairs_rows AS ({SQL_OF['pair_metrics']}), reads AS ({READS_SQL}), " + """g AS (SELECT rname, CAST(sum(length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) AS BIGINT) AS gc, CAST(sum(length(seq)) AS BIGINT) AS bases, CAST(max(mapq) AS BIGINT) AS best_mapq FROM reads WHERE NOT unmapped GROUP BY rname)
SELECT 'gc' AS calculator, concat(rname, '/', m) AS metric, CASE m WHEN 'gc_share' THEN round(gc / bases, 9) ELSE best_mapq END AS value FROM g CROSS JOIN (VALUES ('gc_share'), ('best_mapq')) t(m)
UNION ALL SELECT 'pairs', 'pairs', CAST(pairs AS DOUBLE) FROM pairs_rows""")
def mergeable_calculator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calculator of the user's own in one scan with a built-in one."""
    gc = F.length("seq") - F.length(F.translate("seq", "GC", ""))
    share = lambda t: t.select(F.col("key").alias("rname"), F.round(F.col("sum_0") / F.col("sum_1"), 9).alias("gc_share"), F.col("high_0").alias("best_mapq"))
    suite.register("gc", suite.Calculator("gc", lambda r: [suite.Row(F.col("rname"), [gc, F.length("seq")], [F.col("mapq")], when=~F.col("unmapped"))], share))
    try:
        return suite.metric_suite(reads(spark, sf_dir), ["gc", "pairs"]).where("calculator = 'gc' OR metric = 'pairs'")
    finally:
        del suite.CALCULATORS["gc"]


@query("sql_calculator", WITH + """SELECT read_no, position, letter, count(*) AS n FROM (SELECT read_no, unnest(range(1, length(seq) + 1)) AS position, unnest(string_split(seq, '')) AS letter FROM reads) GROUP BY read_no, position, letter""")
def sql_calculator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters by position, through a table function of SQL whose parts the query merges."""
    suite.register_sql(spark, "letters_by_position", R.letters_by_position, R.LETTERS_BY_POSITION)
    return spark.sql("SELECT read_no, position, letter, sum(n) AS n FROM letters_by_position(TABLE(SELECT read_no, seq FROM {reads})) GROUP BY read_no, position, letter", reads=reads(spark, sf_dir))


@query("number_formats", "SELECT o_orderkey AS id, printf('%.2f', round_even(o_orderkey / 8.0::DOUBLE, 2)) AS half_even, printf('%.2f', floor(o_orderkey * 12.5::DOUBLE + 0.5) / 100) AS half_up FROM orders")
def number_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("o_orderkey") / 8.0
    return base(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), R.format_half_even(x).alias("half_even"), R.format_half_up(x).alias("half_up"))
