"""Reads in, reads out: contaminants, headers, mates, duplicates, order, pairing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import reads as R
from ..sources.shared import is_small, small, stored
from .keyed import occurrences, ranked, with_best

#: Fixed value: the control genome's contig.
CONTAMINANT = "gi|9626372|ref|NC_001422.1|"
#: Records of a name, at most, that one task takes together.
CROWDED = 10_000
#: Records of a task, and as many tasks as are written without being sorted for them (Spark's default); beyond, tasks get up to MOST_RECORDS.
TASK_RECORDS, MANY_TASKS, MOST_RECORDS = 50_000, 200, 1_000_000
#: Names that repeat are few if there are this many records to one of them; the choice goes by their share, so that larger inputs do as smaller ones.
FEW = 20


def contaminant_names(reads: DataFrame, contig: str = CONTAMINANT) -> DataFrame:
    return reads.where(~F.col("unmapped") & (F.lower("rname") == contig.lower())).select("qname").distinct()


def filter_contaminant(reads: DataFrame, contig: str = CONTAMINANT) -> DataFrame:
    """Without every record of a name that is mapped to the contig, mates included."""
    return reads.join(contaminant_names(reads, contig), "qname", "left_anti")


def contaminant_reads(reads: DataFrame, contig: str = CONTAMINANT) -> DataFrame:
    return reads.join(contaminant_names(reads, contig), "qname", "left_semi")


def contaminant_summary(reads: DataFrame, contig: str = CONTAMINANT) -> DataFrame:
    total = reads.agg(F.count(F.lit(1)).alias("total_reads"))
    gone = contaminant_reads(reads, contig).agg(F.count(F.lit(1)).alias("removed_reads"))
    return total.crossJoin(gone).withColumn("pct_removed", F.when(F.col("total_reads") == 0, 0.0).otherwise(100.0 * F.col("removed_reads") / F.col("total_reads")))  # one row each


def drop_contig(sq: DataFrame, contig: str = CONTAMINANT) -> DataFrame:
    """The dictionary without the contig, numbered anew in its order; a dictionary has one row a contig of the genome."""
    return sq.where(F.col("sn") != contig).withColumn("idx", F.row_number().over(Window.orderBy("idx")) - 1)


def reindex_reference(reads: DataFrame, sq: DataFrame) -> DataFrame:
    """ref_idx and mate_ref_idx of `reads` by name in `sq`; -1 where there is none."""
    names = small(sq.select("sn", "idx"))
    mate = F.when(F.col("rnext") == "=", F.col("rname")).otherwise(F.col("rnext"))
    out = reads.join(names.withColumnsRenamed({"sn": "rname", "idx": "ref_idx"}), "rname", "left").withColumn("mate_name", mate)
    out = out.join(names.withColumnsRenamed({"sn": "mate_name", "idx": "mate_ref_idx"}), "mate_name", "left")
    return out.drop("mate_name").withColumns({"ref_idx": F.coalesce("ref_idx", F.lit(-1)), "mate_ref_idx": F.coalesce("mate_ref_idx", F.lit(-1))})


def fastq_trim(records: DataFrame, start: int, n: int, length: int | None = None) -> DataFrame:
    """Without bases start..start+n-1. `length` is the first record's; it is looked up if not given."""
    if length is None:
        first = records.orderBy("file", "rec_no").select(F.length("seq")).first()
        length = first[0] if first else start + 1
    if start < 1 or n < 1 or start >= length:
        raise ValueError(f"cannot trim {n} bases from {start} on in reads of {length}")
    return records.withColumns({"seq": R.trimmed("seq", start, n), "qual": R.trimmed("qual", start, n)})


def fastq_search(records: DataFrame, prefix: str) -> DataFrame:
    """The first record whose header starts with the prefix; no row if there is none."""
    return records.where(F.col("header").startswith(prefix)).orderBy("file", "rec_no").limit(1)


def stop_after(reads: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    """The first n + 1 reads, or all if n is 0."""
    return reads.orderBy(*order).limit(n + 1) if n > 0 else reads


def add_read_group(reads: DataFrame, rg: DataFrame, id: str = "0", sample: str = "unknown", library: str = "", platform: str = "", unit: str = "", center: str | None = None, date=None) -> tuple[DataFrame, DataFrame]:
    """Every read gets the group, whose header row is added; empty fields are left out (null)."""
    given = lambda v: F.lit(v or None).cast("string")
    row = rg.sparkSession.range(1).select(F.lit(id).alias("id"), given(sample).alias("sm"), given(library).alias("lb"), given(unit).alias("pu"), given(platform).alias("pl"), given(center).alias("cn"), F.lit(date).cast("timestamp").alias("dt"))
    return reads.withColumn("rg", F.lit(id)), rg.unionByName(row)


def add_program(pg: DataFrame, id: str, version: str) -> DataFrame:
    return pg.unionByName(pg.sparkSession.range(1).select(F.lit(id).alias("id"), F.lit(version).alias("vn"))) if id and version else pg


def fix_read_group(reads: DataFrame, rg: DataFrame, sample: str | None = None, library: str | None = None, unit: str | None = None, center: str | None = None, platform: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One group: given fields are replaced. None: one with id 0 is made, which needs a sample. Several: an error if any field is given."""
    fields = {"sm": sample, "lb": library, "pu": unit, "cn": center, "pl": platform}
    if not any(fields.values()):
        return reads, rg
    groups = rg.limit(2).count()
    if groups > 1:
        raise ValueError("read group fields cannot be set for several read groups")
    if groups == 0:
        if not sample:
            raise ValueError("a new read group needs a sample")
        return add_read_group(reads, rg, "0", sample, library or "", platform or "", unit or "", center)
    return reads, rg.withColumns({c: F.coalesce(F.lit(v or None).cast("string"), c) for c, v in fields.items()})


def fix_sequence_dict(sq: DataFrame, ur: str | None = None, assembly: str | None = None, species: str | None = None) -> DataFrame:
    return sq.withColumns({c: F.coalesce(F.lit(v or None).cast("string"), c) for c, v in (("ur", ur), ("assembly", assembly), ("species", species))})


def pair_fastq(first: DataFrame, second: DataFrame) -> DataFrame:
    """(pair_no, rec_no, header1, seq1, header2, seq2) of records with equal (pair_no, rec_no); the longer file's rest is left out.

    Headers must agree but for case and the last character.
    """
    stem = lambda h: F.lower(F.expr(f"left({h}, length({h}) - 1)"))
    a = first.select("pair_no", "rec_no", F.col("header").alias("header1"), F.col("seq").alias("seq1"))
    b = second.select("pair_no", "rec_no", F.col("header").alias("header2"), F.col("seq").alias("seq2"))
    both = a.join(b, ["pair_no", "rec_no"])
    wrong = F.raise_error(F.concat(F.lit("headers do not pair: "), "header1", F.lit(" and "), "header2")).cast("string")
    return both.withColumn("seq1", F.when(stem("header1") == stem("header2"), F.col("seq1")).otherwise(wrong))


def fix_mate_information(reads: DataFrame) -> DataFrame:
    """Mate position, strand, reference, mapping and template length from the other read of the pair; a row out for each row in.

    Template length: from the leftmost to the rightmost base, positive for the leftmost read; 0 unless both are mapped to one reference.
    The k-th primary record of a name and read number belongs to the k-th one of its mate, in the order of reference, position
    and the rest; secondary and supplementary records take the first. Records without a counterpart, without a name (null or
    `*`), of fragments, or that are neither first nor second stay as they are.

    Records are dealt out by name once, and the mates of a name found in the task that has it; only names of more than CROWDED
    records are ranked and joined over the cluster. Bases and qualities go along, to order by, only where records differ in nothing else.
    """
    named = F.col("paired") & F.coalesce(F.col("qname") != "*", F.lit(False)) & F.col("read_no").isin(1, 2)
    named = F.coalesce(named, F.lit(False))
    rows = reads.where(named).withColumns({"_primary": R.primary(reads), "_end": R.alignment_end()})
    order = [c for c in ("rname", "pos", "neg", "cigar", "mapq", "unmapped", "seq", "qual") if c in reads.columns]
    several, n = _repeated_names(rows)
    crowded = several.where(F.col("n") > CROWDED).select("qname")
    out = None
    if not crowded.isEmpty():
        crowded = small(crowded)  # a row for every CROWDED records at most
        out = _mates_over_names(rows.join(crowded, "qname", "left_semi"), order)
        rows = rows.join(crowded, "qname", "left_anti")
    within = _mates_within_names(rows, order, several, n)
    out = within if out is None else out.unionByName(within)
    there, mate = F.col("_mate").isNotNull(), F.col("_mate")
    span = F.greatest("_end", mate["end"]) - F.least(F.col("pos"), mate["pos"]) + 1
    left = (F.col("pos") < mate["pos"]) | ((F.col("pos") == mate["pos"]) & (F.col("read_no") == 1))
    length = F.when(F.col("unmapped") | mate["unmapped"] | (F.col("rname") != mate["rname"]), F.lit(0)).when(left, span).otherwise(-span)
    new = {"rnext": mate["rname"], "pnext": mate["pos"], "mate_neg": mate["neg"], "mate_unmapped": mate["unmapped"], "tlen": length}
    fixed = out.withColumns({c: F.when(there, v.cast(reads.schema[c].dataType)).otherwise(F.col(c)) for c, v in new.items()}).select(*reads.columns)
    return fixed.unionByName(reads.where(~named))


def _of_mate() -> Column:
    """What a read takes over from its mate."""
    return F.struct("rname", "pos", F.col("_end").alias("end"), "neg", "unmapped")


def _repeated_names(rows: DataFrame) -> tuple[DataFrame, int]:
    """(qname, n) of the names that have several primary records of a read number, or more than CROWDED records; and how many rows there are."""
    seen = Observation()
    of = lambda k: F.count_if(F.col("_primary") & (F.col("read_no") == k)) > 1
    names = rows.groupBy("qname").agg(F.count(F.lit(1)).alias("n"), (of(1) | of(2)).alias("again")).observe(seen, F.sum("n").alias("rows"))
    return stored(names.where(F.col("again") | (F.col("n") > CROWDED)).select("qname", "n")), seen.get["rows"] or 0


def _names_told_by_text(rows: DataFrame, several: DataFrame | None, ties: list[str], texts: list[str], tasks: int) -> DataFrame:
    """The names with primary records of a read number that agree in `ties` but differ in `texts`.

    What agrees is found by 64-bit hashes, which can but add names; what differs by two of the texts. No text is shuffled. Only
    the names in `several`, if given, are looked at; it is broadcast. A name has at most CROWDED records here, so that records
    are dealt out as they are: nearly all are alone, and adding them up before would take memory for each.
    """
    ours = rows.where("_primary")
    ours = ours if several is None else ours.join(F.broadcast(several), "qname", "left_semi")
    ours = ours.select("qname", F.xxhash64("qname", "read_no", *ties).alias("_alike"), F.xxhash64(*texts).alias("_text"), F.xxhash64(F.lit(1), *reversed(texts)).alias("_text2"))
    differ = (F.min("_text") < F.max("_text")) | (F.min("_text2") < F.max("_text2"))
    alike = stored(ours.drop("qname").repartition(tasks, "_alike").groupBy("_alike").agg(differ.alias("differ")).where("differ").select("_alike"))
    return stored(ours.join(small(alike), "_alike", "left_semi").select("qname").distinct())


def _mates_within_names(rows: DataFrame, order: list[str], several: DataFrame, n: int) -> DataFrame:
    """`rows` with `_mate`; the records of a name are together in a task. `several` has the names that repeat, `n` is about the number of rows."""
    tasks = min(n // TASK_RECORDS + 1, max(MANY_TASKS, n // MOST_RECORDS + 1))
    nth = F.lit(1)
    if not several.isEmpty():
        texts = [c for c in order if c in ("seq", "qual")]
        order = [c for c in order if c not in texts]
        few = several.count() * FEW < n and is_small(several)
        told = _names_told_by_text(rows, several if few else None, order, texts, tasks) if texts else several.limit(0)
        if told.isEmpty():
            pass
        elif is_small(told):
            rows = rows.join(F.broadcast(told.withColumn("_told", F.lit(True))), "qname", "left")
            rows = rows.withColumns({f"_{c}": F.when(F.col("_told"), F.col(c)) for c in texts}).drop("_told")
            order += [f"_{c}" for c in texts]
        else:
            order += texts
        nth = F.when(F.col("_primary"), F.row_number().over(Window.partitionBy("qname", "read_no", "_primary").orderBy(*order))).otherwise(1)
    name = Window.partitionBy("qname", "_nth")
    read = lambda k: F.max(F.when(F.col("_primary") & (F.col("read_no") == k), _of_mate())).over(name)
    placed = rows.repartition(tasks, "qname").withColumn("_nth", nth).withColumns({"_first": read(1), "_second": read(2)})
    return placed.withColumn("_mate", F.when(F.col("read_no") == 1, F.col("_second")).otherwise(F.col("_first"))).select(*[c for c in rows.columns if c not in ("_seq", "_qual")], "_mate")


def _mates_over_names(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `_mate`, for names of any number of records: primary ones are ranked over the cluster and joined by place."""
    placed = stored(occurrences(rows.where("_primary"), ["qname", "read_no"], order))
    mate = placed.select("qname", (3 - F.col("read_no")).cast(rows.schema["read_no"].dataType).alias("read_no"), "occurrence", _of_mate().alias("_mate"))
    first = small(mate.where("occurrence = 1").drop("occurrence"))  # two rows a name at most
    paired = placed.join(mate, ["qname", "read_no", "occurrence"], "left").drop("occurrence")
    return paired.unionByName(rows.where("NOT _primary").join(first, ["qname", "read_no"], "left"))


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Of the primary mapped reads with equal reference, unclipped 5' end, strand and mate's end, the one with the highest base-quality sum stays.

    Both reads of a pair are judged by the pair: its key is both ends in order (of a name with more primary records its least and
    greatest end and their number), its score the sum of all. Ties go to the smallest name. Secondary and supplementary records
    are not marked and mark no others; nor do reads without a name (null or `*`), which belong to no pair.
    """
    five = F.when(F.col("neg"), R.unclipped_end()).otherwise(R.unclipped_start())
    ok = ~F.col("unmapped") & R.primary(reads) & F.coalesce(F.col("qname") != "*", F.lit(False))
    end = F.struct("rname", five.alias("at"), "neg")
    ends = stored(reads.where(ok).select("qname", end.alias("end"), R.quality_sum().alias("score")).groupBy("qname").agg(F.min("end").alias("low"), F.max("end").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("score").alias("score")))
    judged = with_best(ends, ["low", "high", "n"], F.struct(F.col("score").isNull(), -F.col("score"), "qname"))
    again = judged.where(F.col("qname") != F.col("best.qname")).select("qname", F.lit(True).alias("again"))
    return reads.join(again, "qname", "left").withColumn("dup", ok & F.coalesce("again", F.lit(False))).select(*reads.columns)


def clip_to_contig(reads: DataFrame, sq: DataFrame) -> DataFrame:
    """Mapped reads that reach over the end of their contig get the bases from there on soft-clipped; apply it where wanted, nothing else does.

    The bases kept are as many as there are positions left on the contig before its last one; MD is left as it is. Reads that
    start behind the end, and reads on contigs that `sq` does not have, stay as they are.
    """
    named = reads.join(small(sq.select(F.col("sn").alias("rname"), F.col("ln").alias("_ln"))), "rname", "left")
    over = ~F.col("unmapped") & (R.alignment_end() > F.col("_ln")) & (F.col("pos") <= F.col("_ln"))
    clipped = R.soft_clipped(F.col("cigar"), F.col("_ln") - F.col("pos"))
    return named.withColumn("cigar", F.when(F.coalesce(over, F.lit(False)), clipped).otherwise(F.col("cigar"))).select(*reads.columns)


def coordinate_sort(reads: DataFrame, sq: DataFrame) -> DataFrame:
    """By dictionary index and position, unmapped reads last; a range partitioning over the cluster."""
    found = reads.join(small(sq.select(F.col("sn").alias("rname"), "idx")), "rname", "left")
    return found.orderBy(F.col("unmapped"), F.col("idx").asc_nulls_last(), "pos", "qname", "read_no").select(*reads.columns)


def coordinate_places(reads: DataFrame, sq: DataFrame) -> DataFrame:
    """The columns qname, read_no, rname and pos of every read, with its `place` in coordinate order, from 1.

    Only what the order needs is sorted and stored, and the range partitions are numbered by their sizes, so no task gets all rows.
    """
    slim = reads.select("qname", "read_no", "rname", "pos", "unmapped").join(small(sq.select(F.col("sn").alias("rname"), "idx")), "rname", "left")
    placed = ranked(slim, F.col("unmapped"), F.col("idx").asc_nulls_last(), "pos", "qname", "read_no")
    return placed.select("qname", "read_no", "rname", "pos", (F.col("rank") + 1).alias("place"))


def order_pair_files(files: DataFrame) -> DataFrame:
    """(file, lane, read_no) of sequence files, first read before second; other names are an error."""
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    lane = F.regexp_extract(name, r"^s_(\d)_", 1)
    read = F.when(name.rlike(r"^s_\d_1_"), 1).when(name.rlike(r"^s_\d_2_"), 2).when(name.rlike(r"^s_\d_sequence"), 1).otherwise(F.raise_error(F.concat(F.lit("not a sequence file: "), "file")).cast("int"))
    return files.select("file", lane.try_cast("int").alias("lane"), read.alias("read_no")).orderBy("lane", "read_no", "file")
