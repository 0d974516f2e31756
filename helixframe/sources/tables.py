"""Sample tables, run parameters, reports and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sequences import numbered_lines

#: The parameters of a run, in the order they are written.
RUN_KEYS = ["REFERENCE_PATH", "LIBRARY_NAME", "SAMPLE_NAME", "FILTER_PHIX", "CHIP_DESIGN", "RG_PU_FIELD", "FC_BARCODE", "SCHEDULER_QUEUE"]
ALWAYS = {"REFERENCE_PATH", "LIBRARY_NAME", "FILTER_PHIX"}
#: Capture report lines (pattern of the label, count field, percent field, further fields).
CAPTURE_LINES = [
    ("Total Reads Produced", {"total_reads": 1}), ("Duplicate Reads", {"duplicate_reads": 1, "pct_duplicate_reads": 2}),
    ("Total Reads Aligned", {"aligned_reads": 1, "pct_aligned_reads": 2, "reads_paired": 4, "reads_paired_mapped_mates": 6}),
    ("Aligned Reads On-Buffer", {"buffer_reads": 1, "pct_buffer_reads": 2}), ("Aligned Reads On-Target", {"target_reads": 1, "pct_target_reads": 2}), ("Average Coverage", {"average_coverage": 2}),
    ("Reads that hit target or buffer", {"target_or_buffer_reads": 1, "pct_target_or_buffer_reads": 2}), ("Total Aligned Reads.*expected|expected.*Total Aligned Reads", {"expected_aligned_reads": 1}), ("Total Aligned Reads.*calculated|calculated.*Total Aligned Reads", {"calculated_aligned_reads": 1}),
    ("Targets Hit", {"targets_hit": 1, "pct_targets_hit": 2}), ("Target Buffers Hit", {"target_buffers_hit": 1, "pct_target_buffers_hit": 2}), ("Total Targets", {"total_targets": 1}), ("Non target regions with high coverage", {"non_target_hits": 1}),
    ("Bases Targeted", {"target_bases": 1}), ("Buffer Bases", {"buffer_bases": 1}), *[(rf"Bases with {k}\+ coverage", {f"bases_{k}x": 1, f"pct_bases_{k}x": 2}) for k in (1, 4, 10, 20, 40)],
]


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """(tag, seq, line_no); a line that is not two fields is an error."""
    f = F.split("value", ",")
    lines = numbered_lines(spark, path).where(F.length("value") > 0)
    tag = F.when(F.size(f) == 2, F.trim(F.get(f, F.lit(0)))).otherwise(F.raise_error(F.concat(F.lit("not a barcode line: "), "value")).cast("string"))
    return lines.select(tag.alias("tag"), F.trim(F.get(f, F.lit(1))).alias("seq"), "line_no")


def _positional(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    f = F.split("value", ",")
    return numbered_lines(spark, path).where(F.length(F.trim("value")) > 0).select(*[F.trim(F.get(f, F.lit(k))).alias(n) for k, n in enumerate(names) if n], "line_no")


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    return _positional(spark, path, ["flowcell", "lane", "library", "sample", "seq", "tag", "control", "recipe", "operator"])


def read_sample_dirs(spark: SparkSession, path: str) -> DataFrame:
    return _positional(spark, path, ["flowcell", "lane", "", "", "seq", "tag", "", "", "", "bin"])


def read_run_params(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row a file: known keys as columns, null where unset or empty; filter_phix is true for `true` only, scheduler_queue is `normal` by default."""
    lines = numbered_lines(spark, path).select("file", "line_no", F.regexp_extract("value", r"([A-Z_]+)=", 1).alias("key"), F.trim(F.regexp_extract("value", r"=(.*)$", 1)).alias("value"))
    per = lines.groupBy("file").agg(*[F.max_by(F.when((F.col("key") == k) & (F.col("value") != ""), F.col("value")), F.when((F.col("key") == k) & (F.col("value") != ""), F.col("line_no"))).alias(k.lower()) for k in RUN_KEYS])
    return per.withColumns({"filter_phix": F.coalesce(F.col("filter_phix").startswith("true"), F.lit(False)), "scheduler_queue": F.coalesce("scheduler_queue", F.lit("normal"))})


def run_params_lines(params: DataFrame) -> DataFrame:
    """(file, at, value): KEY=value lines; only the first two keys are written when unset."""
    text = lambda k: F.col(k.lower()).cast("string")
    line = lambda k: F.concat(F.lit(f"{k}="), F.coalesce(text(k), F.lit(""))) if k in ALWAYS else F.when(F.length(text(k)) > 0, F.concat(F.lit(f"{k}="), text(k)))
    return params.select("file", F.posexplode(F.array_compact(F.array(*[line(k) for k in RUN_KEYS]))).alias("at", "value"))


def parse_lane_info(text: str | Column, mount: str) -> Column:
    """struct of the `;`-separated KEY=value fields; a reference path is one below `mount`."""
    text = F.col(text) if isinstance(text, str) else text
    value = lambda key: F.trim(F.get(F.regexp_extract_all(text, F.lit(rf"(?:^|;)[^;]*?{key}=([^;]*)"), F.lit(1)), F.lit(0)))
    named = lambda key: F.when(~value(key).rlike("^[Nn]one") & (value(key) != ""), value(key))
    kind = value("FLOWCELL_TYPE")
    path = F.regexp_extract_all(text, F.lit(r"BUILD_PATH=([^;]*)"), F.lit(1))
    build = F.get(path, F.size(path) - 1)
    cycles = F.regexp_extract_all(text, F.lit(r"NUMBER_OF_CYCLES_READ[12]=([^;]+)"), F.lit(1))
    return F.struct(
        F.when(kind.startswith("p"), "paired").when(kind.isNotNull(), "fragment").alias("type"), F.nullif(value("Library"), F.lit("")).alias("library"), named("Sample").alias("sample"), named("ChipDesign").alias("chip_design"),
        F.get(cycles, F.size(cycles) - 1).alias("num_cycles"), F.when(build.rlike(r"^\s*[Ss]equence"), "sequence").when(F.ltrim(build).startswith(mount), F.regexp_extract(build, r"(\S+)", 1)).alias("reference_path"),
    )


def read_analysis_lanes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, lanes): lane digits of the last ANALYSIS line that does not say none."""
    hit = F.col("value").rlike("^[1-8]+:ANALYSIS") & ~F.col("value").contains("none")
    return numbered_lines(spark, path).groupBy("file").agg(F.coalesce(F.max_by(F.when(hit, F.regexp_extract("value", "^([1-8]+):", 1)), F.when(hit, F.col("line_no"))), F.lit("")).alias("lanes"))


def parse_map_stats(text: str, read_no: str) -> Column:
    """struct(pct_mapped, pct_mismatch) of the given read in a metrics text; 0 where missing."""
    nth = lambda key: F.coalesce(F.nullif(F.get(F.regexp_extract_all(F.col(text), F.lit(rf"{key}\s+:\s+([^%\r\n]*)"), F.lit(1)), F.col(read_no) - 1), F.lit("")).try_cast("double"), F.lit(0.0))
    return F.struct(nth("PercentMapped").alias("pct_mapped"), nth("PercentMismatch").alias("pct_mismatch"))


def parse_unique_percent(files: DataFrame) -> DataFrame:
    """(lane, pct_unique) of (lane, text): null unless the lane has exactly one file with the line."""
    value = F.regexp_extract("text", r"(?m)^.*% Unique Reads[^0-9\r\n]*([0-9.]+)", 1).try_cast("double")
    return files.groupBy("lane").agg(F.when(F.count(F.lit(1)) == 1, F.first(value)).alias("pct_unique"))


def read_capture_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row a file with the named numbers; 0 where a line is missing."""
    f = F.split("value", ",")
    number = lambda k: F.regexp_replace(F.trim(F.get(f, F.lit(k))), r"[()%\s]", "").try_cast("double")
    lines = numbered_lines(spark, path).where(F.col("value").contains(":"))
    label = F.array_compact(F.array(*[F.when(F.col("value").rlike(p), F.lit(i)) for i, (p, _) in enumerate(CAPTURE_LINES)]))
    lines = lines.withColumn("rule", F.get(label, F.lit(0)))
    cols = [F.coalesce(F.max_by(F.when(F.col("rule") == i, number(k)), F.when(F.col("rule") == i, F.col("line_no"))), F.lit(0.0)).alias(name) for i, (_, fields) in enumerate(CAPTURE_LINES) for name, k in fields.items()]
    return lines.groupBy("file").agg(*cols)


def list_runs(spark: SparkSession, root: str) -> DataFrame:
    """(instrument, flowcell, file, mtime) of root/instrument/flowcell/file; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime")
    parts = F.split("path", "/")
    at = lambda k: F.element_at(parts, -k)
    return found.select(at(3).alias("instrument"), at(2).alias("flowcell"), at(1).alias("file"), F.col("modificationTime").alias("mtime"))
