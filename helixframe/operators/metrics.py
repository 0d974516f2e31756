"""Quality metrics of reads. Groups are few, so partial sums leave nothing large to shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import reads as R
from ..sources.shared import stored
from .intervals import FINEST, interval_join, merged

count_if = lambda c: F.coalesce(F.count_if(c), F.lit(0))


def share(part: Column, whole: Column, none: float = 0.0) -> Column:
    return F.when(whole == 0, F.lit(none)).otherwise(100.0 * part / F.nullif(whole, F.lit(0)))


def alignment_metrics(reads: DataFrame, missing_md: str = "error") -> DataFrame:
    """By read type; paired reads that are neither first nor second have none and count nowhere."""
    mapped = ~F.col("unmapped")
    miss = F.when(mapped, R.mismatches(missing_md=missing_md))
    bases = F.length("seq").cast("long")
    got = reads.select(R.read_type().alias("read_type"), "unmapped", "dup", miss.alias("miss"), bases.alias("bases"), (bases - R.n_count()).alias("valid")).where(F.col("read_type").isNotNull()).groupBy("read_type").agg(
        F.count(F.lit(1)).alias("total_reads"), count_if(mapped).alias("mapped_reads"), count_if(F.col("unmapped")).alias("unmapped_reads"),
        count_if(mapped & F.col("dup")).alias("dup_reads"), count_if(F.col("miss") == 0).alias("exact_reads"), F.sum("bases").alias("total_bases"), F.sum("valid").alias("valid_bases"),
        F.coalesce(F.sum("miss"), F.lit(0)).alias("mismatches"), F.coalesce(F.sum(F.when(mapped, F.col("bases"))), F.lit(0)).alias("mapped_bases"),
    )
    return with_alignment_shares(got)


def with_alignment_shares(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "pct_mapped": share(F.col("mapped_reads"), F.col("total_reads")), "pct_dup": share(F.col("dup_reads"), F.col("mapped_reads")),
        "pct_exact": share(F.col("exact_reads"), F.col("mapped_reads")), "pct_mismatch": share(F.col("mismatches"), F.col("mapped_bases"), 100.0),
    })


def pair_metrics(reads: DataFrame) -> DataFrame:
    um, mm = F.col("unmapped"), F.col("mate_unmapped")
    got = reads.where(F.col("paired") & (F.col("read_no") != 1)).agg(
        F.count(F.lit(1)).alias("pairs"), count_if(um & mm).alias("both_unmapped"), count_if(~um & ~mm).alias("both_mapped"), count_if(~um & ~mm & R.same_chr_pair()).alias("both_mapped_same_chr"),
        count_if(~um & mm).alias("only_read2_mapped"), count_if(um & ~mm).alias("only_read1_mapped"),
    )
    return with_pair_shares(got)


def with_pair_shares(counts: DataFrame) -> DataFrame:
    return counts.withColumns({f"pct_{c}": share(F.col(c), F.col("pairs")) for c in counts.columns[1:]})


def insert_size_histogram(reads: DataFrame) -> DataFrame:
    sizes = reads.where(R.insert_size_eligible()).select(R.pair_orientation().alias("orientation"), F.abs("tlen").cast("long").alias("size"))
    return sizes.groupBy("orientation", "size").agg(F.count(F.lit(1)).alias("pairs"))


def insert_size_metrics(histogram: DataFrame, more_than_pct: float = 10.0) -> DataFrame:
    """Median is the element at 0-based index n div 2; orientations of `more_than_pct` percent or less are left out."""
    running = Window.partitionBy("orientation").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("orientation")
    cum = histogram.withColumns({"cum": F.sum("pairs").over(running), "n": F.sum("pairs").over(whole)})
    per = cum.groupBy("orientation").agg(
        F.max("n").alias("total_pairs"), F.min(F.when(F.col("cum") > F.floor(F.col("n") / 2), F.col("size"))).alias("median_size"), F.max_by("size", F.struct("pairs", -F.col("size"))).alias("mode_size"),
    )
    every = histogram.agg(F.sum("pairs").alias("eligible"))
    out = per.crossJoin(F.broadcast(every)).withColumn("pct_pairs", share(F.col("total_pairs"), F.col("eligible")))  # one row
    return out.where(F.col("total_pairs") * 100.0 > more_than_pct * F.col("eligible")).select("orientation", "total_pairs", "pct_pairs", "median_size", "mode_size")


def _mode(histogram: DataFrame, fraction: float) -> DataFrame:
    mode = histogram.groupBy("orientation").agg(F.max_by(F.struct(F.col("size").alias("m"), F.col("pairs").alias("c")), F.struct("pairs", -F.col("size"))).alias("top"))
    return histogram.join(F.broadcast(mode), "orientation").withColumn("often", F.col("pairs") >= F.floor(F.lit(fraction) * F.col("top.c")))  # three rows


def trim_tail(histogram: DataFrame, fraction: float = 0.01) -> DataFrame:
    """Without the sizes right of the last one that is frequent enough or not right of the mode."""
    marked = _mode(histogram, fraction)
    last = marked.groupBy("orientation").agg(F.max(F.when((F.col("size") <= F.col("top.m")) | F.col("often"), F.col("size"))).alias("last"))
    return marked.join(F.broadcast(last), "orientation").where(F.col("size") <= F.col("last")).select(*histogram.columns)


def trim_sparse(histogram: DataFrame, fraction: float = 0.01) -> DataFrame:
    """Without any size right of the mode that is too rare."""
    return _mode(histogram, fraction).where((F.col("size") <= F.col("top.m")) | F.col("often")).select(*histogram.columns)


def quality_by_position(reads: DataFrame) -> DataFrame:
    """Mean quality by series (1: fragments and first reads) and cycle; reads without qualities (`*`) are left out.

    Positions of the second read are filled up with zeros to the longest read, as the first's are.
    """
    chars = F.when(F.col("neg"), F.reverse("qual")).otherwise(F.col("qual"))
    series = F.when(F.col("paired") & (F.col("read_no") == 2), 2).otherwise(1)
    bases = reads.where(F.col("qual") != "*").select(series.alias("series"), F.posexplode(F.split(chars, "")).alias("p", "c"))
    got = bases.groupBy("series", (F.col("p") + 1).alias("position")).agg(F.sum(F.ascii("c") - 33).alias("quality_sum"), F.count(F.lit(1)).alias("n"))
    return quality_grid(got)


def quality_grid(got: DataFrame) -> DataFrame:
    """Every position up to the longest, with means, of sums by (series, position)."""
    there = got.groupBy("series").agg(F.lit(1).alias("one")).crossJoin(F.broadcast(got.agg(F.max("position").alias("longest"))))  # two rows by one
    grid = there.select("series", F.explode(F.sequence(F.lit(1), "longest")).alias("position"))
    return grid.join(got, ["series", "position"], "left").select(
        "series", "position", F.coalesce("quality_sum", F.lit(0)).alias("quality_sum"), F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce(F.col("quality_sum") / F.col("n"), F.lit(0.0)).alias("mean_quality"),
    )


def uniqueness(seeds: DataFrame, key: str = "seed") -> DataFrame:
    got = seeds.agg(F.count(F.lit(1)).alias("total_reads"), F.count_distinct(key).alias("unique_reads"))
    return got.withColumn("pct_unique", share(F.col("unique_reads"), F.col("total_reads")))


def uniqueness_fragment(reads: DataFrame, strict: bool = False) -> DataFrame:
    return uniqueness(reads.select(R.seed(strict=strict).alias("seed")))


def uniqueness_paired(pairs: DataFrame, strict: bool = False) -> DataFrame:
    """Over rows (seq1, seq2), as operators.reads.pair_fastq gives them."""
    return uniqueness(pairs.select(F.concat(R.seed("seq1", strict=strict), R.seed("seq2", strict=strict)).alias("seed")))


def adaptor_counts(reads: DataFrame, adaptor: str = R.ADAPTOR) -> DataFrame:
    got = reads.groupBy("read_no").agg(F.count(F.lit(1)).alias("total_reads"), count_if(R.adaptor_position(adaptor=adaptor) >= 0).alias("adaptor_reads"))
    return got.withColumn("pct_adaptor", share(F.col("adaptor_reads"), F.col("total_reads")))


def _grid(reads: DataFrame) -> DataFrame:
    return reads.agg(F.max(F.length("seq")).alias("n")).where(F.col("n") > 0).select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("start"))


def adaptor_start_histogram(reads: DataFrame, adaptor: str = R.ADAPTOR) -> DataFrame:
    """Counts by 0-based start, zero-filled to the read length."""
    found = reads.select(R.adaptor_position(adaptor=adaptor).alias("start")).where(F.col("start") >= 0).groupBy("start").agg(F.count(F.lit(1)).alias("n"))
    return _grid(reads).join(found, "start", "left").select("start", F.coalesce("n", F.lit(0)).alias("reads"))


def bad_read_counts(reads: DataFrame, least: float = R.BAD_SHARE) -> DataFrame:
    got = reads.groupBy("read_no").agg(F.count(F.lit(1)).alias("total_reads"), count_if(R.is_bad_read(share=least)).alias("bad_reads"))
    return got.withColumn("pct_bad", share(F.col("bad_reads"), F.col("total_reads")))


def n_distribution(reads: DataFrame) -> DataFrame:
    """Percentage of all reads with an N at each 0-based position."""
    bases = reads.select("read_no", F.posexplode(F.split(F.upper("seq"), "")).alias("start", "b")).where(F.col("b") == "N").groupBy("read_no", "start").agg(F.count(F.lit(1)).alias("n"))
    total = reads.groupBy("read_no").agg(F.count(F.lit(1)).alias("total"))
    return n_grid(total, bases, _grid(reads))


def n_grid(total: DataFrame, bases: DataFrame, starts: DataFrame) -> DataFrame:
    """Every position of `starts` for each read number, with the share of its reads that have an N there."""
    grid = total.crossJoin(F.broadcast(starts))  # read numbers by read length
    return grid.join(bases, ["read_no", "start"], "left").select("read_no", F.col("start").alias("position"), F.coalesce("n", F.lit(0)).alias("n_count"), share(F.coalesce("n", F.lit(0)), F.col("total")).alias("pct_n"))


def capture_overlap(reads: DataFrame, targets: DataFrame, buffer: int = 100, bin_size: int = FINEST) -> DataFrame:
    """(qname, read_no, r_start, r_end, chr, start_pos, end_pos, on_target): each mapped read with each target it or whose buffer it overlaps. `bin_size` is that of the finest bins."""
    ends = reads.where(~F.col("unmapped")).select("qname", "read_no", F.col("rname").alias("chr"), F.col("pos").alias("r_start"), R.alignment_end().alias("r_end"))
    wide = targets.distinct().select("chr", "start_pos", "end_pos", (F.col("start_pos") - buffer).alias("low"), (F.col("end_pos") + buffer).alias("high"))
    both = interval_join(ends, wide, "chr", ("r_start", "r_end"), ("low", "high"), bin_size)
    on = (F.col("r_start") <= F.col("end_pos")) & (F.col("r_end") >= F.col("start_pos"))
    return both.select("qname", "read_no", "r_start", "r_end", "chr", "start_pos", "end_pos", on.alias("on_target"))


def target_depth(reads: DataFrame, targets: DataFrame, bin_size: int = 1024) -> DataFrame:
    """(chr, depth, bases): target bases (of the union of targets) by read depth.

    An interval is two events, whatever its length: it opens at its start and closes behind its end. Events are summed by position;
    inside a bin of positions depths are running sums, on top of what the sums of all bins before it on the contig leave open. The
    stretch from the last position of a bin goes on to the first one of the next bin that has any. The window over a contig's bins
    has a row for each bin_size bases of it at most.
    """
    opened = lambda df, a, b, r, t: df.select("chr", F.explode(F.array(F.struct(a.alias("at"), F.lit(r).alias("r"), F.lit(t).alias("t")), F.struct((b + 1).alias("at"), F.lit(-r).alias("r"), F.lit(-t).alias("t")))).alias("e"))
    aligned = reads.where(~F.col("unmapped")).select(F.col("rname").alias("chr"), F.col("pos").cast("long").alias("s"), R.alignment_end().cast("long").alias("e"))
    wanted = targets.select("chr", F.col("start_pos").cast("long").alias("s"), F.col("end_pos").cast("long").alias("e"))
    events = opened(aligned, F.col("s"), F.col("e"), 1, 0).unionByName(opened(wanted, F.col("s"), F.col("e"), 0, 1))
    steps = events.groupBy("chr", F.floor(F.col("e.at") / bin_size).alias("bin"), F.col("e.at").alias("at")).agg(F.sum("e.r").alias("r"), F.sum("e.t").alias("t"))
    bins = steps.groupBy("chr", "bin").agg(F.sum("r").alias("bin_r"), F.sum("t").alias("bin_t"), F.min("at").alias("first"))
    along = Window.partitionBy("chr").orderBy("bin")
    before = lambda c: F.coalesce(F.sum(c).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.select("chr", "bin", before("bin_r").alias("open_r"), before("bin_t").alias("open_t"), F.lead("first").over(along).alias("next"))
    order = Window.partitionBy("chr", "bin").orderBy("at")
    up = order.rowsBetween(Window.unboundedPreceding, 0)
    inside = steps.select("chr", "bin", F.sum("r").over(up).alias("r"), F.sum("t").over(up).alias("t"), "at", F.lead("at").over(order).alias("until"))
    runs = inside.join(bins, ["chr", "bin"]).select("chr", (F.col("r") + F.col("open_r")).alias("depth"), (F.col("t") + F.col("open_t")).alias("in_target"), (F.coalesce("until", "next") - F.col("at")).alias("n"))
    return runs.where((F.col("in_target") > 0) & F.col("n").isNotNull()).groupBy("chr", "depth").agg(F.sum("n").alias("bases"))


def _hits(reads: DataFrame, targets: DataFrame, buffer: int) -> tuple[DataFrame, DataFrame]:
    """Reads (qname, read_no, on) and targets (chr, start_pos, end_pos, on) that capture_overlap() has, once each; on: one of their rows is on target.

    A read overlaps some target if it overlaps their union, and a target some read likewise, so no pair of the two is made. Targets
    that end before they start are no part of a union and are paired as they are.
    """
    ends = reads.where(~F.col("unmapped")).select("qname", "read_no", F.col("rname").alias("chr"), F.col("pos").alias("r_start"), R.alignment_end().alias("r_end"))
    wanted = targets.select("chr", "start_pos", "end_pos").distinct()
    both = F.array(F.struct(F.lit(True).alias("on"), F.col("start_pos").alias("low"), F.col("end_pos").alias("high")), F.struct(F.lit(False).alias("on"), (F.col("start_pos") - buffer).alias("low"), (F.col("end_pos") + buffer).alias("high")))
    wide = wanted.select("*", F.explode(both).alias("w")).select("chr", "start_pos", "end_pos", "w.*")
    odd = wanted.where(F.col("start_pos") > F.col("end_pos"))
    right = wide.where(F.col("start_pos") <= F.col("end_pos"))
    pieces = stored(merged(right.where("on"), "chr", "low", "high").withColumn("on", F.lit(True)).unionByName(merged(right.where("NOT on"), "chr", "low", "high").withColumn("on", F.lit(False))), "pieces")
    covered = stored(merged(ends, "chr", "r_start", "r_end"), "pieces")
    of_reads = interval_join(ends, pieces, "chr", ("r_start", "r_end"), ("low", "high")).select("qname", "read_no", "on")
    of_targets = interval_join(right, covered, "chr", ("low", "high"), ("r_start", "r_end")).select("chr", "start_pos", "end_pos", "on")
    if not odd.isEmpty():
        pairs = capture_overlap(reads, odd, buffer).withColumnRenamed("on_target", "on")
        of_reads, of_targets = of_reads.unionByName(pairs.select(*of_reads.columns)), of_targets.unionByName(pairs.select(*of_targets.columns))
    return tuple(df.groupBy(*df.columns[:-1]).agg(F.max("on").alias("on")) for df in (of_reads, of_targets))


def capture_metrics(reads: DataFrame, targets: DataFrame, buffer: int = 100) -> DataFrame:
    """One row: reads, duplicates, aligned, on target, on buffer, hits, mean coverage and bases by least depth."""
    reads_hit, targets_hit = _hits(reads, targets, buffer)
    count = lambda df, on, any_: df.agg(count_if(F.col("on")).alias(on), F.count(F.lit(1)).alias(any_))
    hits = count(reads_hit, "target_reads", "target_or_buffer_reads").crossJoin(count(targets_hit, "targets_hit", "target_buffers_hit"))  # one row each
    totals = reads.agg(F.count(F.lit(1)).alias("total_reads"), count_if(~F.col("unmapped")).alias("aligned_reads"), count_if(~F.col("unmapped") & F.col("dup")).alias("duplicate_reads"))
    depth = target_depth(reads, targets)
    bases = depth.agg(F.sum("bases").alias("target_bases"), (F.sum(F.col("bases") * F.col("depth")) / F.sum("bases")).alias("mean_coverage"),
                      *[F.coalesce(F.sum(F.when(F.col("depth") >= k, F.col("bases"))), F.lit(0)).alias(f"bases_{k}x") for k in (1, 4, 10, 20, 40)])
    out = totals.crossJoin(hits).crossJoin(targets.distinct().agg(F.count(F.lit(1)).alias("total_targets"))).crossJoin(bases)  # one row each
    return out.withColumn("buffer_reads", F.col("target_or_buffer_reads") - F.col("target_reads"))
