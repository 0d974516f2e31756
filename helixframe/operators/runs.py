"""Runs: arrivals, readiness, dates, transfers, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored

#: Marker files of a run folder.
FINISHED = ".rsync_finished"
COMPLETE = "RTAComplete.txt"
NETCOPY = "Basecalling_Netcopy_complete.txt"
NETCOPIES = [NETCOPY, "Basecalling_Netcopy_complete_READ1.txt", "Basecalling_Netcopy_complete_READ2.txt"]
#: The version whose runs are judged by their copy markers, and the machine that is started by hand.
NETCOPY_VERSION = "1.9"
BY_HAND = "SN601"
SETTLE_S = 3600


def new_runs(listing: DataFrame, done: DataFrame) -> DataFrame:
    """Listed (instrument, flowcell) that are not in the done list."""
    return listing.select("instrument", "flowcell").distinct().join(done.select("flowcell").distinct(), "flowcell", "left_anti").select("instrument", "flowcell")


def run_state(files: DataFrame) -> DataFrame:
    """A row a run: its markers, whether each of the copy markers is there, the first one's time, and its `version` if listed.

    Sums and maxima only, so that a stream can keep it as its state.
    """
    has = lambda name: F.coalesce(F.bool_or(F.col("file") == name), F.lit(False))
    time = lambda name: F.max(F.when(F.col("file") == name, F.col("mtime")))
    copied = has(NETCOPIES[0])
    for name in NETCOPIES[1:]:
        copied = copied & has(name)
    version = [F.max("version").alias("version")] if "version" in files.columns else []
    return files.groupBy("instrument", "flowcell").agg(has(FINISHED).alias("finished"), has(COMPLETE).alias("complete"), copied.alias("copied"), time(NETCOPY).alias("netcopy_time"), time(COMPLETE).alias("complete_time"), *version)


def ready(now: Column, settle_s: int = SETTLE_S) -> tuple[Column, Column]:
    """(ready, mark) over run_state() with `version`: ready now; to be marked as finished for the next poll.

    A run of NETCOPY_VERSION is ready when all its copy markers are there and the first is `settle_s` old. Runs of other or
    unknown versions wait for their completion or finished marker.
    """
    old = F.unix_timestamp(now) - F.unix_timestamp("netcopy_time") >= settle_s
    gated = F.col("flowcell").contains(BY_HAND)
    copied = F.col("copied") & F.coalesce(F.col("version").contains(NETCOPY_VERSION), F.lit(False))
    is_ready = F.when(F.col("finished"), True).when(gated | F.col("complete"), False).otherwise(copied & F.coalesce(old, F.lit(False)))
    return is_ready, ~F.col("finished") & ~gated & F.col("complete")


def run_ready(files: DataFrame, now: Column, versions: DataFrame | None = None, settle_s: int = SETTLE_S) -> DataFrame:
    """(instrument, flowcell, ready, mark); `versions` (instrument, flowcell, version), a row a run, or a `version` column of `files`."""
    is_ready, mark = ready(now, settle_s)
    state = run_state(files)
    if versions is not None:
        state = state.drop("version").join(versions.select("instrument", "flowcell", "version"), ["instrument", "flowcell"], "left")
    elif "version" not in files.columns:
        state = state.withColumn("version", F.lit(None).cast("string"))
    return state.select("instrument", "flowcell", is_ready.alias("ready"), mark.alias("mark"))


#: Letters of the pieces by which wanted names find directories.
GRAM = 4


def _grams(name: str, sizes: list[int]) -> Column:
    """The distinct pieces of a name, of all given sizes."""
    c = F.col(name)
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substr(c, i, F.lit(n)))
    return F.array_distinct(F.flatten(F.array(*[F.when(F.length(c) >= n, cut(n)).otherwise(F.array().cast("array<string>")) for n in sizes])))


def run_finished_date(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """(instrument, flowcell, finished): date of the completion marker in a directory whose name contains `flowcell`; NONE without a marker, INVALID_FLOWCELL without a directory.

    A directory that contains a name contains each piece of GRAM letters of it (all of it, if it is shorter). Of these the piece
    that stands in the fewest directories of the instrument is looked up among the directories' pieces, so names meet
    candidates by equality, and few of them. An empty name is in every directory of its instrument.
    """
    names = wanted.select("instrument", "flowcell").distinct()
    state = stored(run_state(files).select("instrument", F.col("flowcell").alias("directory"), "complete_time"))
    known = F.coalesce(F.least(F.length("flowcell"), F.lit(GRAM)), F.lit(GRAM))
    sizes = sorted(r[0] for r in names.select(known.alias("n")).distinct().collect())  # GRAM + 1 values at most
    pieces = stored(state.select("instrument", "directory", "complete_time", F.explode(_grams("directory", sizes or [GRAM])).alias("piece")))
    often = pieces.groupBy("instrument", "piece").agg(F.count(F.lit(1)).alias("directories"))
    own = F.explode(F.when(known == 0, F.array(F.lit(""))).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("flowcell") - known + 1), lambda i: F.substr("flowcell", i, known)))))
    rated = names.where(F.col("flowcell").isNotNull()).select("instrument", "flowcell", own.alias("piece")).join(often, ["instrument", "piece"])
    rarest = rated.groupBy("instrument", "flowcell").agg(F.min_by("piece", F.struct("directories", "piece")).alias("piece"))
    found = rarest.join(pieces, ["instrument", "piece"]).where(F.col("directory").contains(F.col("flowcell")))
    dates = found.groupBy("instrument", "flowcell").agg(F.coalesce(F.date_format(F.max("complete_time"), "yyyy-MM-dd"), F.lit("NONE")).alias("finished"))
    same = F.col("n.instrument").eqNullSafe(F.col("d.instrument")) & F.col("n.flowcell").eqNullSafe(F.col("d.flowcell"))
    return names.alias("n").join(dates.alias("d"), same, "left").select("n.instrument", "n.flowcell", F.coalesce("finished", F.lit("INVALID_FLOWCELL")).alias("finished"))


def cycles_per_lane(cycles: DataFrame) -> DataFrame:
    """(lane, cycles, last_cycle) of (lane, cycle): digits of the name, without a 1 at its end."""
    number = F.regexp_replace("cycle", r"\D|1$", "").try_cast("int")
    return cycles.groupBy("lane").agg(F.count_distinct("cycle").alias("cycles"), F.max(F.coalesce(number, F.lit(0))).alias("last_cycle"))


def transfer_progress(instrument: DataFrame, destination: DataFrame) -> DataFrame:
    shape = lambda df, p: cycles_per_lane(df).select("lane", F.col("cycles").alias(f"{p}_cycles"), F.col("last_cycle").alias(f"{p}_last_cycle"))
    both = shape(instrument, "inst").join(shape(destination, "dest"), "lane", "full_outer")
    return both.select("lane", F.coalesce("inst_cycles", F.lit(0)).alias("inst_cycles"), "inst_last_cycle", F.coalesce("dest_cycles", F.lit(0)).alias("dest_cycles"), "dest_last_cycle")


def lanes_with_yield(summary: DataFrame) -> DataFrame:
    """(flowcell, label): `Summary` and the lanes of reads other than 2 whose yield is not empty; there are eight lanes."""
    lanes = F.array_sort(F.collect_set(F.when((F.col("read_no") != 2) & (F.col("yield_kb") != ""), F.col("lane"))))
    return summary.groupBy("flowcell").agg(F.concat(F.lit("Summary"), F.array_join(F.transform(lanes, lambda x: F.concat(F.lit("_"), x.cast("string"))), ""), F.lit(".htm")).alias("label"))


def lane_summary(summary: DataFrame) -> DataFrame:
    """Sums and means by (flowcell, read, lane), blank yields counted as 0."""
    blank = F.coalesce(F.nullif("yield_kb", F.lit("")), F.lit("0")).cast("long")
    return summary.groupBy("flowcell", "read_no", "lane").agg(F.sum(blank).alias("yield_kb"), F.sum("clusters_raw").alias("clusters_raw"), F.sum("clusters_pf").alias("clusters_pf"))


def is_paired_run(summary: DataFrame, files: DataFrame) -> DataFrame:
    """(flowcell, paired): a second read in the summary and at least two sequence files."""
    two = summary.groupBy("flowcell").agg(F.bool_or(F.col("read_no") == 2).alias("second"))
    n = files.groupBy("flowcell").agg(F.count_distinct("file").alias("n"))
    return two.join(n, "flowcell", "left").select("flowcell", (F.col("second") & (F.coalesce("n", F.lit(0)) >= 2)).alias("paired"))


def archive_candidates(rows: DataFrame, today: Column, days: int = 2) -> DataFrame:
    """(directory): the second `;` field of the rows of `today` less `days`."""
    return rows.where(F.col("run_date") == F.date_sub(today, days)).select(F.get(F.split("line", ";"), F.lit(1)).alias("directory"))
