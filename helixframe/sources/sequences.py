"""FASTQ and SAM text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import small, stored


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line_no, value) of text files, numbered from 0 in each file.

    Lines are numbered inside each file split and split counts give the offsets, so a file is as parallel as its splits.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seen"))
    sizes = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("file", "block", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("seen")) - 1
    return lines.withColumn("inside", inside).join(offsets, ["file", "block"]).select("file", (F.col("offset") + F.col("inside")).alias("line_no"), "value")


def _split_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(value, file, block) of text files, in order inside each file split (file, block)."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The batch's lines by split: ((file, block), values)."""
    blocks, files = batch.column(2).to_numpy(), batch.column(1)
    if not len(blocks):
        return
    coded = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (coded[1:] != coded[:-1])])).tolist()
    for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
        yield (files[a].as_py(), int(blocks[a])), batch.column(0).slice(a, b - a)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, n, head, tail): the number of lines of each split, its first lines and its last ones, three of each at most."""
    key, n, head, tail = None, 0, [], []

    def row() -> pa.RecordBatch:
        lists = [pa.array([v], pa.list_(pa.string())) for v in (head, tail)]
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([n], pa.int64()), *lists], ["file", "block", "n", "head", "tail"])

    for batch in batches:
        for at, lines in _runs(batch):
            if at != key:
                if key is not None:
                    yield row()
                key, n, head, tail = at, 0, [], []
            if len(head) < 3:
                head += lines.slice(0, 3 - len(head)).to_pylist()
            tail = (tail + lines.slice(max(0, len(lines) - 3)).to_pylist())[-3:]
            n += len(lines)
    if key is not None:
        yield row()


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, file, block, offset) to the records that lie inside one split; offset: lines of the file before the split."""
    names = ["file", "rec_no", "header", "seq", "qual_header", "qual"]
    key, line, kept = None, 0, None
    for batch in batches:
        done = 0
        for at, lines in _runs(batch):
            if at != key:
                key, line = at, batch.column(3)[done].as_py()
                kept = None
            done += len(lines)
            if kept is None and line % 4:  # the first lines of the split end a record of the split before
                skip = min(len(lines), 4 - line % 4)
                lines, line = lines.slice(skip), line + skip
            if kept is not None and len(kept):
                lines = pa.concat_arrays([kept, lines])
            if line % 4 == 0:
                n = len(lines) // 4
                kept = lines.slice(4 * n)
                if n:
                    part = [lines.take(pa.array(np.arange(k, 4 * n, 4))) for k in range(4)]
                    yield pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array(line // 4 + np.arange(n), pa.int64()), *part], names)
                line += 4 * n


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, rec_no, header, seq, qual_header, qual): four lines a record, whatever they start with; a cut-off last record is left out.

    No line is shuffled, unless there are too many splits to broadcast a row for each. A first pass leaves of each file split its number of lines and its outermost ones; their sums over a file say
    which line of which record each split begins with. A second pass puts together the records inside each split where they are,
    and the few that a split's edge cuts are put together from the outermost lines.
    """
    lines = _split_lines(spark, paths)
    edges = stored(lines.mapInArrow(_edges, "file string, block long, n long, head array<string>, tail array<string>"), "splits")
    offset = (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("offset")  # a row for each split of a file
    splits = stored(edges.select("file", "block", "n", "head", "tail", offset), "splits")
    table = splits.select("file", "block", "offset")
    hinted = small(table)
    if hinted is table:  # millions of files: too many splits to broadcast, so that lines are dealt out by split, in their order
        seen = lines.withColumn("seen", F.monotonically_increasing_id()).join(table, ["file", "block"])
        whole = seen.repartition("file", "block").sortWithinPartitions("file", "block", "seen").select("value", "file", "block", "offset")
    else:
        whole = lines.join(hinted, ["file", "block"]).select("value", "file", "block", "offset")
    records = "file string, rec_no long, header string, seq string, qual_header string, qual string"
    loose = lambda c, first: F.posexplode(F.transform(c, lambda x, k: F.struct((F.col("offset") + first + k).alias("line"), x.alias("value")))).alias("k", "e")
    ends = splits.select("file", "offset", "n", loose("head", F.lit(0))).unionByName(splits.select("file", "offset", "n", loose("tail", F.col("n") - F.size("tail"))))
    rec = F.floor(F.col("e.line") / 4)
    cut = ends.where((rec * 4 < F.col("offset")) | (rec * 4 + 4 > F.col("offset") + F.col("n")))
    part = lambda k, name: F.max(F.when(F.col("e.line") % 4 == k, F.col("e.value"))).alias(name)
    joined = cut.groupBy("file", rec.alias("rec_no")).agg(part(0, "header"), part(1, "seq"), part(2, "qual_header"), part(3, "qual"))
    return whole.mapInArrow(_whole_records, records).unionByName(joined.where(F.col("qual").isNotNull()))


def _field(tag: str) -> Column:
    return F.nullif(F.regexp_extract("value", rf"\t{tag}:([^\t]*)", 1), F.lit(""))


#: Header fields that have columns of their own; what else a line holds is kept in `rest`.
HEADER_COLUMNS = {"SQ": [("SN", "sn"), ("LN", "ln"), ("UR", "ur"), ("AS", "assembly"), ("SP", "species")], "RG": [("ID", "id"), ("SM", "sm"), ("LB", "lb"), ("PU", "pu"), ("PL", "pl"), ("CN", "cn"), ("DT", "dt")], "PG": [("ID", "id"), ("VN", "vn")]}


def _rest(kind: str) -> Column:
    """The header fields without a column (a DT that is no time among them) as they stand, or null."""
    known = [f"{t}:" for t, _ in HEADER_COLUMNS[kind] if t != "DT"]
    plain_time = lambda x: F.substr(x, F.lit(4)).try_cast("timestamp").isNotNull()
    own = lambda x: F.substring(x, 1, 3).isin(known) | (x.startswith("DT:") & plain_time(x) if kind == "RG" else F.lit(False))
    return F.nullif(F.array_join(F.filter(F.slice(F.split("value", "\t"), 2, 1_000_000), lambda x: ~own(x)), "\t"), F.lit(""))


def _header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file, block, seen) of header lines; seen ascends inside a split. Records are left out before anything is moved."""
    return _split_lines(spark, path).where(F.col("value").startswith("@")).withColumn("seen", F.monotonically_increasing_id())


def sam_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The header lines as a stored table, for read_sam() and read_sam_other(), which else look through all lines for each table that is used."""
    return stored(_header(spark, path), "header")


def read_sam_other(spark: SparkSession, path: str | list[str], header: DataFrame | None = None) -> DataFrame:
    """(at, value): the header lines that read_sam() makes no tables of (@HD, @CO and unknown ones), in order from 0."""
    head = (_header(spark, path) if header is None else header).where(~F.col("value").rlike("^@(SQ|RG|PG)\t"))
    return head.select((F.row_number().over(Window.orderBy("file", "block", "seen")) - 1).cast("long").alias("at"), "value")  # header lines only


def read_sam(spark: SparkSession, path: str | list[str], header: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(records, sq, rg, pg) of SAM text. No row is rejected: fields that are missing or no numbers are null.

    read_no is 1 for fragments, and 0 for paired reads that are neither first nor second (or both: 1).
    `tags` has each tag's value by name (the first, if it repeats), `tag_text` all tags as they stand, with their types, for
    write_sam(). Header fields without a column are in `rest`.
    """
    lines = spark.read.text(path)
    head = _header(spark, path) if header is None else header
    order = Window.orderBy("file", "block", "seen")  # header lines only: a contig or a group each
    sq = head.where(F.col("value").startswith("@SQ\t")).select((F.row_number().over(order) - 1).alias("idx"), _field("SN").alias("sn"), _field("LN").cast("long").alias("ln"), _field("UR").alias("ur"), _field("AS").alias("assembly"), _field("SP").alias("species"), _rest("SQ").alias("rest"))
    rg = head.where(F.col("value").startswith("@RG\t")).select(_field("ID").alias("id"), _field("SM").alias("sm"), _field("LB").alias("lb"), _field("PU").alias("pu"), _field("PL").alias("pl"), _field("CN").alias("cn"), _field("DT").try_cast("timestamp").alias("dt"), _rest("RG").alias("rest"))
    pg = head.where(F.col("value").startswith("@PG\t")).select(_field("ID").alias("id"), _field("VN").alias("vn"), _rest("PG").alias("rest"))
    f = F.split("value", "\t")
    at = lambda k, kind="string": F.get(f, F.lit(k)).try_cast(kind)
    tags = F.transform(F.filter(F.slice(f, 12, 1_000_000), lambda t: F.length(t) >= 5), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substr(t, F.lit(6)).alias("v")))
    flag = at(1, "int")
    bit = lambda n: F.coalesce(flag.bitwiseAND(F.lit(n)) != 0, F.lit(False))
    one = F.aggregate(tags, F.array().cast("array<struct<k:string,v:string>>"), lambda a, t: F.when(F.exists(a, lambda o: o["k"] == t["k"]), a).otherwise(F.concat(a, F.array(t))))
    records = lines.where(~F.col("value").startswith("@") & (F.length("value") > 0)).select(
        at(0).alias("qname"), flag.alias("flag"), F.when(~bit(1) | bit(64), 1).when(bit(128), 2).otherwise(0).alias("read_no"), bit(1).alias("paired"), bit(4).alias("unmapped"), bit(8).alias("mate_unmapped"),
        bit(16).alias("neg"), bit(32).alias("mate_neg"), bit(256).alias("not_primary"), bit(2048).alias("supplementary"), bit(1024).alias("dup"), at(2).alias("rname"), at(3, "long").alias("pos"), at(4, "int").alias("mapq"), at(5).alias("cigar"),
        at(6).alias("rnext"), at(7, "long").alias("pnext"), at(8, "long").alias("tlen"), at(9).alias("seq"), at(10).alias("qual"), F.map_from_entries(one).alias("tags"), F.slice(f, 12, 1_000_000).alias("tag_text"),
    ).withColumns({"md": F.col("tags")["MD"], "rg": F.col("tags")["RG"]})
    return records, sq, rg, pg


def flag_of(records: DataFrame) -> Column:
    """The SAM flag of the boolean columns; bits without a column are kept from `flag`, if there is one."""
    bits = {"paired": 1, "unmapped": 4, "mate_unmapped": 8, "neg": 16, "mate_neg": 32, "not_primary": 256, "dup": 1024}
    out = F.when(F.col("paired"), F.when(F.col("read_no") == 1, 64).when(F.col("read_no") == 2, 128).otherwise(0)).otherwise(0)
    for name, n in bits.items():
        out = out + F.when(F.col(name), n).otherwise(0)
    return out + F.coalesce(F.col("flag").bitwiseAND(F.lit(2 | 512 | 2048)), F.lit(0)) if "flag" in records.columns else out


def sam_lines(records: DataFrame) -> Column:
    """A record's line. Tags are those of `tag_text` as they stand, MD and RG in it with the values that `md` and `rg` have now
    (none where these are null); without `tag_text`, md and rg and the other `tags`, as strings.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("*"))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("0"))
    tag = lambda c, name: F.concat(F.lit(f"{name}:Z:"), F.col(c)) if c in records.columns else F.lit(None).cast("string")
    own = F.array_compact(F.array(tag("md", "MD"), tag("rg", "RG")))
    rest = F.array().cast("array<string>")
    if "tag_text" in records.columns:
        there = lambda name: F.exists("tag_text", lambda x: x.startswith(f"{name}:"))
        rest = F.array_compact(F.transform("tag_text", lambda x: F.when(x.startswith("MD:"), tag("md", "MD")).when(x.startswith("RG:"), tag("rg", "RG")).otherwise(x)))
        own, rest = rest, F.array_compact(F.array(F.when(~there("MD"), tag("md", "MD")), F.when(~there("RG"), tag("rg", "RG"))))
    elif "tags" in records.columns:
        rest = F.transform(F.array_sort(F.filter(F.map_entries("tags"), lambda e: ~e["key"].isin("MD", "RG"))), lambda e: F.concat(e["key"], F.lit(":Z:"), e["value"]))
    none = F.array().cast("array<string>")
    return F.concat_ws("\t", text("qname"), flag_of(records).cast("string"), text("rname"), number("pos"), number("mapq"), text("cigar"), text("rnext"), number("pnext"), number("tlen"), text("seq"), text("qual"), F.coalesce(own, none), F.coalesce(rest, none))


def header_lines(sq: DataFrame, rg: DataFrame, pg: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """(kind, at, value) of the header lines, in order: @HD first, then the tables', then the rest of `other`; null fields are left out."""

    def lines(df: DataFrame, tag: str, kind: int, at: Column) -> DataFrame:
        fields = [F.concat(F.lit(f"{t}:"), F.col(c).cast("string")) for t, c in HEADER_COLUMNS[tag]]
        return df.select(F.lit(kind).alias("kind"), at.cast("long").alias("at"), F.concat_ws("\t", F.lit(f"@{tag}"), *fields, *[F.col(c) for c in df.columns if c == "rest"]).alias("value"))

    out = lines(sq, "SQ", 0, F.col("idx")).unionByName(lines(rg.withColumn("dt", F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ssXXX")), "RG", 1, F.lit(0))).unionByName(lines(pg, "PG", 2, F.lit(0)))
    if other is not None:
        out = out.unionByName(other.select(F.when(F.col("value").startswith("@HD"), -1).otherwise(3).alias("kind"), F.col("at").cast("long").alias("at"), "value"))
    return out


def write_fastq(records: DataFrame, path: str, order: tuple[str, ...] = ("file", "rec_no")) -> None:
    """Four lines a record, in input order over the part files."""
    records.orderBy(*order).select(F.concat_ws("\n", "header", "seq", "qual_header", "qual").alias("value")).write.text(path)


def write_sam(records: DataFrame, sq: DataFrame, rg: DataFrame, pg: DataFrame, path: str, other: DataFrame | None = None) -> None:
    """Header lines (with those of read_sam_other() in `other`), then the records by coordinate, over the part files in order.

    Header lines are one partition: beside many that are nearly empty Spark would take those of the records for uneven ones, and sample them twice.
    """
    idx = small(sq.select(F.col("sn").alias("rname"), F.col("idx").cast("long").alias("ref_at")))  # else all reads of a contig would go to one task
    body = records.join(idx, "rname", "left").select(
        F.when(F.col("unmapped") | F.col("ref_at").isNull(), 5).otherwise(4).alias("kind"), F.coalesce("ref_at", F.lit(-1).cast("long")).alias("at"), F.coalesce("pos", F.lit(0)).cast("long").alias("pos"), F.col("qname").alias("name"), sam_lines(records).alias("value"))
    head = header_lines(sq, rg, pg, other).select("kind", "at", F.lit(0).cast("long").alias("pos"), F.lit("").alias("name"), "value")
    head.coalesce(1).unionByName(body).orderBy("kind", "at", "pos", "name", "value").select("value").write.text(path)
