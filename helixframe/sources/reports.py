"""Metric reports: text, XML, CSV and result strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "\r\n"
#: Names of the lane result string and the columns they stand for.
LANE_FIELDS = [("LANE_YIELD_KBASES", "yield_kb"), ("CLUSTERS_RAW", "clusters_raw"), ("CLUSTERS_PF", "clusters_pf"), ("FIRST_CYCLE_INT_PF", "first_cycle_int"), ("PERCENT_INTENSITY_AFTER_20_CYCLES_PF", "int20"), ("PERCENT_PF_CLUSTERS", "pct_pf"), ("PERCENT_PHASING", "phasing"), ("PERCENT_PREPHASING", "prephasing")]
ALIGN_FIELDS = [("PERCENT_ALIGN_PF", "pct_align_pf"), ("PERCENT_ERROR_RATE_PF", "error_pf"), ("ALIGNMENT_SCORE_PF", "align_score_pf")]
FIRST_READ_FIELDS = [("RESULTS_PATH", "results_path"), ("REFERENCE_PATH", "reference_path"), ("BAM_PATH", "bam_path")]
#: Names of the capture result string, label of the text report, count column, percent column.
CAPTURE_FIELDS = [
    ("TOTAL_READS", "Total Reads Produced", "total_reads", None, None), ("DUPLICATE_READS", "Duplicate Reads", "duplicate_reads", "PERCENT_DUPLICATE_READS", "pct_duplicate_reads"), ("TOTAL_ALIGNED_READS", "Total Reads Aligned", "aligned_reads", "PERCENT_ALIGNED_READS", "pct_aligned_reads"),
    ("READS_PAIRED", "Paired Reads", "reads_paired", None, None), ("READS_PAIRED_MAPPED_MATES", "Reads Paired with Mapped Mates", "reads_paired_mapped_mates", None, None), ("BUFFER_ALIGNED_READS", "Buffer Aligned Reads", "buffer_reads", "PERCENT_BUFFER_ALIGNED_READS", "pct_buffer_reads"),
    ("TARGET_ALIGNED_READS", "Target Aligned Reads", "target_reads", "PERCENT_TARGET_ALIGNED_READS", "pct_target_reads"), ("AVERAGE_COVERAGE", "Average Coverage", "average_coverage", None, None), ("READS_ON_TARGET_OR_BUFFER", "Reads on Target or Buffer", "target_or_buffer_reads", "PERCENT_READS_ON_TARGET_OR_BUFFER", "pct_target_or_buffer_reads"),
    ("TOTAL_EXPECTED_ALIGNED_READS", "Total Aligned Reads (Expected)", "expected_aligned_reads", None, None), ("TOTAL_CALC_ALIGNED_READS", "Total Aligned Reads (Calculated)", "calculated_aligned_reads", None, None), ("TARGETS_HIT", "Targets Hit", "targets_hit", "PERCENT_TARGETS_HIT", "pct_targets_hit"),
    ("TARGET_BUFFERS_HIT", "Target Buffers Hit", "target_buffers_hit", "PER_TARGET_BUFFERS_HITS", "pct_target_buffers_hit"), ("TOTAL_TARGETS", "Total Targets", "total_targets", None, None), ("HIGH_COVERAGE_NON_TARGET_HITS", "Non Target Hits", "non_target_hits", None, None), ("BASES_ON_TARGET", "Bases on Target", "target_bases", None, None), ("BASES_ON_BUFFER", "Buffer Bases", "buffer_bases", None, None),
    *[(f"{w}_COVERAGE_BASES", f"Bases with {k}+ Coverage", f"bases_{k}x", f"PER_{w}_COVERAGE_BASES", f"pct_bases_{k}x") for w, k in (("ONE", 1), ("FOUR", 4), ("TEN", 10), ("TWENTY", 20), ("FORTY", 40))],
]


def plain(c: str | Column) -> Column:
    """A number without a needless fraction; 0 for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("0")), r"\.0$", "")


def lane_result_string(analysed: str | Column = "analysed") -> Column:
    """` KEY value` pairs of a (lane, read); the alignment part only if analysed, paths and uniqueness only for read 1."""
    done = F.col(analysed) if isinstance(analysed, str) else analysed
    first = done & (F.col("read_no") == 1)
    pair = lambda key, value: F.concat(F.lit(f" {key} "), value)
    base = [pair(k, plain(c)) for k, c in LANE_FIELDS]
    align = [F.when(done, pair(k, plain(c))).otherwise("") for k, c in ALIGN_FIELDS]
    paths = [F.when(first, pair(k, F.coalesce(F.col(c), F.lit("")))).otherwise("") for k, c in FIRST_READ_FIELDS]
    unique = F.when(first & F.col("pct_unique").isNotNull(), pair("UNIQUE_PERCENT", plain("pct_unique"))).otherwise("")
    return F.concat(*base, *align, *paths, unique)


def capture_result_string() -> Column:
    return F.concat_ws(" ", *[x for key, _, c, pct, p in CAPTURE_FIELDS for x in ([F.lit(key), plain(c)] + ([F.lit(pct), plain(p)] if pct else []))])


def capture_text() -> Column:
    return F.concat(*[F.concat(F.lit(f"{label} = "), plain(c), *([F.lit(" ("), plain(p), F.lit(")%")] if p else []), F.lit(END)) for _, label, c, _, p in CAPTURE_FIELDS])


def metrics_text(metrics: DataFrame) -> DataFrame:
    """One row `text` of flat metrics (path array, at, key, value): blank line, name, `key : value` lines, children below, in the order of `at`."""
    parts = metrics.groupBy("path").agg(F.min("at").alias("at"), F.sort_array(F.collect_list(F.struct("at", "key", "value"))).alias("kv"))
    lines = F.array_join(F.transform(F.filter("kv", lambda e: e["key"].isNotNull()), lambda e: F.concat(e["key"], F.lit(" : "), F.coalesce(e["value"], F.lit("")), F.lit(END))), "")
    block = F.concat(F.lit(END), F.element_at("path", -1), F.lit(END), lines)
    return parts.select("at", block.alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "block"))), lambda e: e["block"]), "").alias("text"))


def _xml_name(name: Column) -> Column:
    """The name itself; an error if it is none of XML's plain names."""
    return F.when(name.rlike("^[A-Za-z_][A-Za-z0-9_.-]*$"), name).otherwise(F.raise_error(F.concat(F.lit("not an XML name: "), F.coalesce(name, F.lit("null")))).cast("string"))


def metrics_xml(metrics: DataFrame, root: str = "AnalysisMetrics") -> DataFrame:
    """One row `xml` of flat metrics (path, at, key, value): a metric is an element, its pairs are attributes, children are nested to any depth.

    Elements are put together level by level from the deepest. A path whose parents have no rows of their own has them as elements
    without attributes. Siblings stand in the order of `at`. Names that XML does not allow are an error; values are escaped.
    """
    escaped = F.coalesce("value", F.lit(""))
    for letter, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot"), ("\n", "#10"), ("\r", "#13"), ("\t", "#9")):
        escaped = F.replace(escaped, F.lit(letter), F.lit(f"&{name};"))
    attribute = F.when(F.col("key").isNotNull(), F.concat(F.lit(" "), _xml_name(F.col("key")), F.lit('="'), escaped, F.lit('"')))
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", c))), lambda e: e[c]), "")
    own = metrics.withColumn("attribute", attribute).groupBy("path").agg(F.min("at").alias("own_at"), joined("attribute").alias("attributes"))
    above = metrics.select("at", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", 1, n))).alias("path"))
    nodes = above.groupBy("path").agg(F.min("at").alias("some_at")).join(own, "path", "left")
    nodes = nodes.select("path", F.coalesce("own_at", "some_at").alias("at"), F.coalesce("attributes", F.lit("")).alias("attributes"), F.size("path").alias("depth"))
    kids = None
    for depth in range(nodes.agg(F.max("depth")).first()[0] or 0, 0, -1):  # as many steps as the deepest path has names
        level = nodes.where(F.col("depth") == depth)
        level = level.withColumn("kids", F.lit(None).cast("string")) if kids is None else level.join(kids, F.col("path") == F.col("parent"), "left")
        name = _xml_name(F.element_at("path", -1))
        inner = F.when(F.col("kids").isNull(), F.lit("/>")).otherwise(F.concat(F.lit(">"), "kids", F.lit("</"), name, F.lit(">")))
        elements = level.select(F.slice("path", 1, depth - 1).alias("parent"), "at", F.concat(F.lit("<"), name, "attributes", inner).alias("element"))
        kids = elements.groupBy("parent").agg(joined("element").alias("kids"))
    whole = F.coalesce(F.max("kids"), F.lit("")) if kids is not None else F.lit("")
    return (metrics if kids is None else kids).agg(F.concat(F.lit(f"<{root}>"), whole, F.lit(f"</{root}>")).alias("xml"))


def write_histogram_csv(histogram: DataFrame, path: str) -> None:
    """`size,count` ascending, a folder for each orientation."""
    histogram.select("orientation", "size", F.col("pairs").alias("count")).repartition("orientation").sortWithinPartitions("orientation", "size").write.partitionBy("orientation").csv(path)


def quality_lines(quality: DataFrame) -> DataFrame:
    """(position, value): `position,mean1,mean2,`; the second mean only where there is a second series."""
    wide = quality.groupBy("position").agg(*[F.max(F.when(F.col("series") == k, F.col("mean_quality"))).alias(f"m{k}") for k in (1, 2)])
    return wide.select("position", F.concat(F.col("position").cast("string"), F.lit(","), F.concat_ws(",", F.col("m1").cast("string"), F.col("m2").cast("string")), F.lit(",")).alias("value"))


def write_quality_csv(quality: DataFrame, path: str) -> None:
    quality_lines(quality).orderBy("position").select("value").write.text(path)


def write_sample_sheet(sheet: DataFrame, path: str, operator: str) -> None:
    sheet.withColumn("operator", F.lit(operator)).orderBy("lane", "tag").select(F.concat_ws(",", "flowcell", "lane", "library", "sample", "seq", "tag", "control", "recipe", "operator").alias("value")).write.option("lineSep", END).text(path)


def write_barcode_definition(padded: DataFrame, path: str) -> None:
    padded.orderBy("tag").select(F.concat_ws(",", "tag", "seq").alias("value")).write.text(path)


def write_run_params(lines: DataFrame, path: str, by_file: bool = False) -> None:
    """Lines of sources.tables.run_params_lines, in order; `by_file` writes one file for each `file`, in folders file=..."""
    if by_file:
        lines.select("file", "at", "value").repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(path)
    else:
        lines.orderBy("file", "at").select("value").write.text(path)
