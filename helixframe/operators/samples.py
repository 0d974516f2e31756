"""Barcodes, sample sheets and flowcell definitions. These tables have a row a sample or a barcode."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..sources.shared import small, stored


def barcode_distance(barcodes: DataFrame, less_than: int = 2) -> DataFrame:
    """(tag1, tag2, distance) of pairs of rows of a barcode map that are closer than `less_than`, each row with all later ones.

    Rows are in the order of `line_no`, or of (tag, seq) without such a column; rows may repeat a tag or a sequence. Two
    sequences with fewer than `less_than` differences agree on one of as many pieces, so rows meet by an equi-join on pieces.
    Where the shortest sequence has fewer letters than that, every pair is in question and the map (a few hundred rows, what
    one machine can tell apart) is one piece.
    """
    order = ["line_no"] if "line_no" in barcodes.columns else ["tag", "seq"]
    rows = barcodes.select("tag", "seq", F.row_number().over(Window.orderBy(*order)).alias("at"))
    width = (barcodes.agg(F.min(F.length("seq"))).first()[0] or 0) // max(1, less_than)
    piece = F.array(*[F.struct(F.lit(k).alias("k"), F.substring("seq", k * width + 1, width).alias("s")) for k in range(max(1, less_than if width else 1))])
    cut = rows.select("at", "tag", "seq", F.explode(piece).alias("piece"))
    side = lambda k: cut.select("piece", F.col("at").alias(f"at{k}"), F.col("tag").alias(f"tag{k}"), F.col("seq").alias(f"seq{k}"))
    near = side(1).join(side(2), "piece").where(F.col("at1") < F.col("at2")).withColumn("distance", N.hamming_distance("seq1", "seq2")).where(F.col("distance") < less_than)
    return near.groupBy("at1", "at2", "tag1", "tag2").agg(F.max("distance").alias("distance")).select("tag1", "tag2", "distance")


def pad_barcodes(barcodes: DataFrame, keys: list[str] | None = None, pad: str = "CTC") -> DataFrame:
    """Sequences of the least length get `pad` where the flowcell's lengths differ by 3; `keys` name the flowcell."""
    lengths = barcodes.groupBy(*(keys or [])).agg(F.min(F.length("seq")).alias("least"), F.max(F.length("seq")).alias("most"))
    both = barcodes.join(lengths, keys) if keys else barcodes.crossJoin(F.broadcast(lengths))  # one row
    short = (F.col("most") - F.col("least") == len(pad)) & (F.length("seq") == F.col("least"))
    return both.withColumn("seq", F.when(short, F.concat("seq", F.lit(pad))).otherwise(F.col("seq"))).select(*barcodes.columns)


def build_sample_sheet(lane_barcodes: DataFrame, barcodes: DataFrame, flowcell: str, strict: bool = True) -> DataFrame:
    """M11 rows of the lane barcodes that have a tag; an unknown tag is an error, or left out with strict=False."""
    lane, tag = N.split_lane_barcode("lane_barcode")
    rows = lane_barcodes.select("lane_barcode", lane.alias("lane"), tag.alias("tag")).where(F.col("tag") != "")
    both = rows.join(small(barcodes.select("tag", "seq")), "tag", "left" if strict else "inner")
    seq = F.when(F.col("seq").isNull(), F.raise_error(F.concat(F.lit("no sequence for barcode "), "tag")).cast("string")).otherwise(F.col("seq")) if strict else F.col("seq")
    return both.select(F.lit(flowcell).alias("flowcell"), "lane", F.lit("dummy_library").alias("library"), F.lit("dummy_sample").alias("sample"), seq.alias("seq"), "tag", F.lit("n").alias("control"), F.lit("r1").alias("recipe"))


def demultiplex(reads: DataFrame, sheet: DataFrame, mismatches: int = 1, keys: tuple[str, ...] = ("flowcell", "lane")) -> DataFrame:
    """tag and corrected barcode of each read (id, keys, barcode): the only sheet row of its lane within `mismatches`, else `unknown`.

    Every sequence within `mismatches` is written out beside the sheet's own, so that reads meet it by an equi-join.
    """
    near = sheet.select(*keys, "tag", "seq", F.col("seq").alias("observed"))
    for _ in range(mismatches):
        spots = near.select("*", F.explode(F.sequence(F.lit(1), F.length("seq"))).alias("i")).select("*", F.explode(F.array(*map(F.lit, "ACGTN"))).alias("b"))
        put = F.concat(F.expr("left(observed, i - 1)"), F.col("b"), F.expr("substr(observed, i + 1)"))
        near = spots.select(*keys, "tag", "seq", put.alias("observed")).unionByName(near).distinct()
    distance = N.hamming_distance("observed", "seq")
    best = near.groupBy(*keys, "observed").agg(F.min(distance).alias("d"), F.min_by(F.struct("tag", "seq"), distance).alias("hit"), F.sort_array(F.collect_list(distance)).alias("all"))
    single = best.where((F.size("all") == 1) | (F.get("all", F.lit(1)) > F.col("d"))).select(*keys, F.col("observed").alias("barcode"), F.col("hit.tag").alias("tag"), F.col("hit.seq").alias("corrected"))
    # a table: broadcast where it is small, and beyond that Spark can split a barcode that very many reads have
    return reads.join(stored(single), [*keys, "barcode"], "left").withColumn("tag", F.coalesce("tag", F.lit("unknown")))


def missing_barcode(sheet: DataFrame, dirs: DataFrame) -> DataFrame:
    """(flowcell, lane, seq): of each lane the first sequence of the sheet (by line_no) without a row in `dirs`."""
    left = sheet.join(dirs.select("flowcell", "lane", "seq").distinct(), ["flowcell", "lane", "seq"], "left_anti")
    return left.groupBy("flowcell", "lane").agg(F.min_by("seq", "line_no").alias("seq"))


def directory_bin(lane_tags: DataFrame, dirs: DataFrame) -> DataFrame:
    """The bin of each (flowcell, lane, tag): the first by line_no, or `unknown`."""
    first = dirs.groupBy("flowcell", "lane", "tag").agg(F.min_by("bin", "line_no").alias("bin"))
    return lane_tags.join(first, ["flowcell", "lane", "tag"], "left").withColumn("bin", F.coalesce("bin", F.lit("unknown")))


def validate_lane_barcode(lane_barcodes: DataFrame, sheet: DataFrame, multiplexed: bool = True) -> DataFrame:
    """valid: well-formed, and in the sheet by (lane, tag), or without a tag in a lane that the sheet does not have."""
    lane, tag = N.split_lane_barcode("lane_barcode")
    rows = lane_barcodes.withColumns({"lane": lane, "tag": tag})
    tags = sheet.select(F.col("lane").cast("string").alias("lane"), "tag", F.lit(True).alias("in_sheet")).distinct()
    lanes = sheet.select(F.col("lane").cast("string").alias("lane"), F.lit(True).alias("lane_there")).distinct()
    both = rows.join(small(tags), ["lane", "tag"], "left").join(small(lanes), "lane", "left")
    ok = F.when(F.col("tag") == "", F.col("lane_there").isNull()).otherwise(F.col("in_sheet").isNotNull())
    return both.select(*lane_barcodes.columns, "lane", "tag", (N.lane_barcode_valid("lane_barcode", multiplexed) & ok).alias("valid"))


def tag_lookup(rows: DataFrame, barcodes: DataFrame, by: str = "tag", strict: bool = True) -> DataFrame:
    """`rows` with the other column of the map: seq by tag or tag by seq. The map's last match (by line_no) wins; unknown keys are an error if `strict`."""
    other = "seq" if by == "tag" else "tag"
    last = barcodes.groupBy(by).agg(F.max_by(other, "line_no").alias(other))
    both = rows.join(small(last), by, "left")
    if not strict:
        return both
    return both.withColumn(other, F.when(F.col(other).isNull(), F.raise_error(F.concat(F.lit(f"unknown {by}: "), F.col(by))).cast("string")).otherwise(F.col(other)))


def lane_info_lookup(definition: DataFrame, lane_barcodes: DataFrame) -> DataFrame:
    """The attributes of each lane barcode in a flowcell definition; an unknown one is an error."""
    info = definition.select("name", "type", "read_length", F.explode("info").alias("i")).select("name", "type", "read_length", "i.*")
    both = lane_barcodes.join(info, lane_barcodes["lane_barcode"] == info["id"], "left")
    known = F.when(F.col("id").isNull(), F.raise_error(F.concat(F.lit("no such lane barcode in the definition: "), "lane_barcode")).cast("string")).otherwise(F.col("id"))
    return both.withColumn("id", known)


def is_multiplexed(lane_barcodes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return lane_barcodes.groupBy(*(keys or [])).agg(F.coalesce(F.bool_or(N.is_multiplexed_name("lane_barcode")), F.lit(False)).alias("multiplexed"))
