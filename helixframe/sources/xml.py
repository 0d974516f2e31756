"""Flowcell definitions, lane summaries and metric trees as XML; old summaries as HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_DEFINITION = "_Name string, _NumCycles string, _Type string, LaneBarcodeList struct<LaneBarcode: array<struct<_Name: string>>>, LaneBarcodeInfo struct<LaneBarcode: array<struct<_ID: string, _ReferencePath: string, _Sample: string, _Library: string, _ChipDesign: string>>>"
_MEAN = "struct<mean: string>"
_LANES = "struct<Read: array<struct<readNumber: string, Lane: array<struct<laneNumber: string, laneYield: string, errorPF: {m}, clusterCountRaw: {m}, clusterCountPF: {m}, averageAlignScorePF: {m}, percentClustersPF: {m}, signal20AsPctOf1: {m}, percentUniquelyAlignedPF: {m}, oneSig: {m}, phasingApplied: string, prephasingApplied: string>>>>>"
#: Column -> element of the summary.
_MEANS = {"error_pf": "errorPF", "clusters_raw": "clusterCountRaw", "clusters_pf": "clusterCountPF", "align_score_pf": "averageAlignScorePF", "pct_pf": "percentClustersPF", "int20": "signal20AsPctOf1", "pct_align_pf": "percentUniquelyAlignedPF", "first_cycle_int": "oneSig"}


def read_flowcell_definition(spark: SparkSession, path: str) -> DataFrame:
    """(name, num_cycles, type, read_length, lane_barcodes, info); empty attributes are null, a missing reference is `sequence`."""
    raw = spark.read.format("xml").option("rowTag", "FCInfo").schema(_DEFINITION).load(path)
    given = lambda v: F.nullif(v, F.lit(""))
    one = lambda b: F.struct(b["_ID"].alias("id"), F.coalesce(given(b["_ReferencePath"]), F.lit("sequence")).alias("reference_path"), given(b["_Sample"]).alias("sample"), given(b["_Library"]).alias("library"), given(b["_ChipDesign"]).alias("chip_design"))
    return raw.select(
        F.col("_Name").alias("name"), F.col("_NumCycles").alias("num_cycles"), F.col("_Type").alias("type"), (F.regexp_extract("_NumCycles", r"(\d+)", 1).try_cast("int") - 1).alias("read_length"),
        F.filter(F.transform("LaneBarcodeList.LaneBarcode", lambda b: b["_Name"]), lambda n: F.length(n) > 0).alias("lane_barcodes"), F.transform("LaneBarcodeInfo.LaneBarcode", one).alias("info"),
    )


def write_flowcell_definition(definition: DataFrame, path: str) -> None:
    rows = definition.select(
        F.col("name").alias("_Name"), F.col("num_cycles").alias("_NumCycles"), F.col("type").alias("_Type"), F.struct(F.transform("lane_barcodes", lambda n: F.struct(n.alias("_Name"))).alias("LaneBarcode")).alias("LaneBarcodeList"),
        F.struct(F.transform("info", lambda b: F.struct(b["id"].alias("_ID"), b["reference_path"].alias("_ReferencePath"), b["sample"].alias("_Sample"), b["library"].alias("_Library"), b["chip_design"].alias("_ChipDesign"))).alias("LaneBarcode")).alias("LaneBarcodeInfo"),
    )
    rows.write.format("xml").option("rootTag", "FCInfos").option("rowTag", "FCInfo").save(path)


def read_lane_summary(spark: SparkSession, path: str) -> DataFrame:
    """A row for each (run, read, lane): numbers as doubles, blank or missing as 0."""
    schema = f"ChipSummary struct<RunFolder: string>, LaneResultsSummary {_LANES.format(m=_MEAN)}, ExpandedLaneSummary {_LANES.format(m=_MEAN)}"
    raw = spark.read.format("xml").option("rowTag", "Summary").schema(schema).load(path).withColumn("run", F.col("ChipSummary.RunFolder"))
    number = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")).try_cast("double"), F.lit(0.0))
    def lanes(part: str) -> DataFrame:
        reads = raw.select("run", F.explode(f"{part}.Read").alias("r"))
        return reads.select("run", F.col("r.readNumber").cast("int").alias("read_no"), F.explode("r.Lane").alias("l")).withColumn("lane", F.col("l.laneNumber").cast("int"))

    main = lanes("LaneResultsSummary").select("run", "read_no", "lane", F.col("l.laneYield").alias("yield_kb_text"), number(F.col("l.laneYield")).alias("yield_kb"), *[number(F.col(f"l.{e}.mean")).alias(c) for c, e in _MEANS.items()])
    more = lanes("ExpandedLaneSummary").select("run", "read_no", "lane", number(F.col("l.phasingApplied")).alias("phasing"), number(F.col("l.prephasingApplied")).alias("prephasing"))
    return main.join(more, ["run", "read_no", "lane"], "left").na.fill(0.0, ["phasing", "prephasing"])


def read_html_summary(spark: SparkSession, path: str) -> DataFrame:
    """(file, read_no, values): key -> value of the lane tables; of the expanded table only the phasing columns."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    section = lambda title: F.regexp_extract("value", rf"(?s){title}(.*?)(?:</table>|\z)", 1)
    cells = lambda row: F.transform(F.regexp_extract_all(row, F.lit(r"(?s)<td>\s*(.*?)\s*</td>"), F.lit(1)), lambda c: F.trim(c))
    rows = lambda text: F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"(?s)<tr>(.*?)</tr>"), F.lit(1)), cells), lambda r: F.size(r) > 0)
    def values(title: str, keep: str) -> Column:
        found = rows(section(title))
        keys, vals = F.coalesce(F.get(found, F.lit(0)), F.array().cast("array<string>")), F.coalesce(F.get(found, F.lit(1)), F.array().cast("array<string>"))
        return F.filter(F.arrays_zip(keys.alias("key"), vals.alias("value")), lambda e: e["key"].rlike(keep))

    out = None
    for n, tail in ((1, r"(?! : Read 2)"), (2, " : Read 2")):
        both = F.concat(values(f"Lane Results Summary{tail}", "."), values(f"Expanded Lane Summary{tail}", "[Pp]hasing"))
        unique = F.map_from_entries(F.array_distinct(both))
        part = pages.select("file", F.lit(n).alias("read_no"), F.when(F.size(both) > 0, unique).alias("values")).where(F.col("values").isNotNull())
        out = part if out is None else out.unionByName(part)
    return out
