"""New runs as a stream: each flowcell once, when its markers say so.

The file source's checkpoint takes the place of a ledger of what was seen. What was started is a table with a folder for each
micro-batch, written over when a batch is run again after a failure, so that a run is started once whatever fails between
the write and the commit.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import runs as U
from ..operators.runs import BY_HAND, COMPLETE, FINISHED, NETCOPIES, NETCOPY, NETCOPY_VERSION, SETTLE_S

LISTING = "instrument string, flowcell string, file string, mtime timestamp, version string"


def listing_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Listings of marker files (Parquet, as sources.tables.list_runs gives them, with the run's RTA `version` if it is known) as they arrive."""
    return spark.readStream.schema(LISTING).options(**options).parquet(path)


def finished_runs(listing: DataFrame, keep: str = "7 days") -> DataFrame:
    """Each (instrument, flowcell) once, at the first finished marker, for streams whose markers come within `keep` of each other.

    State is bounded by `keep`: a marker that comes later than that is dropped, and a run whose marker comes again after it
    is started again. Use exactly_once() without `keep`, or new_ready_runs(), where that must not be.
    """
    seen = listing.where(F.col("file") == FINISHED).withWatermark("mtime", keep)
    return seen.dropDuplicatesWithinWatermark(["instrument", "flowcell"]).select("instrument", "flowcell", "mtime")


def exactly_once(listing: DataFrame, keep: str | None = None) -> DataFrame:
    """Each flowcell once. Without `keep` its state is a key for each flowcell ever seen; `keep` bounds it as in finished_runs()."""
    if keep:
        return listing.withWatermark("mtime", keep).dropDuplicatesWithinWatermark(["flowcell"]).select("instrument", "flowcell")
    return listing.dropDuplicates(["flowcell"]).select("instrument", "flowcell")


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """The batch's rows in a folder of its own, which the same batch writes over when it is run again."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def new_run_stream(runs: DataFrame, done: str, checkpoint: str):
    """Adds each new run to the `done` table and ends when nothing is left to read; returns the query."""
    return runs.writeStream.foreachBatch(lambda batch, n: write_batch(batch, n, done)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_ready_runs(listing: DataFrame, done: str, checkpoint: str, now: Column | None = None, settle_s: int = SETTLE_S, **trigger):
    """Adds each run to the `done` table at the first poll that finds it ready (operators.runs.ready); returns the query.

    The state is a row a run (operators.runs.run_state), and every poll judges all of them, since a run can become ready by
    age alone. A completion marker counts as a finished one from the next poll on, as one that was put there would.
    The runs of earlier batches are left out; those of the batch's own folder are not, so a repeated batch writes the same.
    """
    state = U.run_state(listing)

    def poll(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        is_ready, mark = U.ready(F.current_timestamp() if now is None else now, settle_s)
        judged = batch.select("instrument", "flowcell", is_ready.alias("ready"), mark.alias("mark"))
        schema = "instrument string, flowcell string, ready boolean, batch long"
        # a folder for each batch holds what it started (ready) and what it marked for the next one (not ready)
        before = spark.read.schema(schema).parquet(done).where(F.col("batch") < n) if n and _exists(spark, done) else spark.createDataFrame([], schema)
        started = before.where("ready").select("instrument", "flowcell").distinct()
        marked = before.where("NOT ready").select("instrument", "flowcell", F.lit(True).alias("was_marked")).distinct()
        new = judged.join(started, ["instrument", "flowcell"], "left_anti").join(marked, ["instrument", "flowcell"], "left")
        new = new.select("instrument", "flowcell", (F.col("ready") | F.coalesce("was_marked", F.lit(False))).alias("ready"), "mark", "was_marked")
        write_batch(new.where("ready OR (mark AND was_marked IS NULL)").select("instrument", "flowcell", "ready"), n, done)

    return state.writeStream.outputMode("complete").foreachBatch(poll).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class Settle(StatefulProcessor):
    """Emits a run once: when it is finished, at the next timer after it is complete, or, for NETCOPY_VERSION, SETTLE_S seconds after its first copy marker if all of them are there."""

    def __init__(self, settle_s: int = SETTLE_S):
        self.settle_ms = settle_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.copies = handle.getMapState("copies", "file string", "at long")
        self.emitted = handle.getValueState("emitted", "done boolean")
        self.complete = handle.getValueState("complete", "seen boolean")
        self.version = handle.getValueState("version", "version string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, finished = timerValues.getCurrentProcessingTimeInMs(), False
        for pdf in rows:
            for file, at, version in zip(pdf["file"], pdf["at"].tolist(), pdf["version"], strict=True):
                finished |= file == FINISHED
                if version is not None and version == version:
                    self.version.update((version,))
                if file == COMPLETE:
                    self.complete.update((True,))
                if file in NETCOPIES:
                    self.copies.updateValue((file,), (at,))
        if self.emitted.exists():
            return
        if finished:
            yield self._emit(key)
        elif (at := self._due(key, now)) is not None:
            self.handle.registerTimer(max(at, now + 1))

    def _due(self, key, now: int) -> int | None:
        """When the run will be ready as things stand, in milliseconds."""
        if BY_HAND in key[1]:
            return None
        if self.complete.exists():
            return now
        copies = {k[0]: v[0] for k, v in self.copies.iterator()}
        version = self.version.get()[0] if self.version.exists() else ""
        return copies[NETCOPY] + self.settle_ms if NETCOPY_VERSION in version and set(copies) >= set(NETCOPIES) else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        at = self._due(key, now)
        if not self.emitted.exists() and at is not None and at <= now:
            yield self._emit(key)

    def _emit(self, key) -> pd.DataFrame:
        self.emitted.update((True,))
        return pd.DataFrame({"instrument": [key[0]], "flowcell": [key[1]], "ready_at": [dt.datetime.now(dt.UTC).replace(tzinfo=None)]})

    def close(self) -> None:
        pass


def settled_runs(listing: DataFrame, settle_s: int = SETTLE_S) -> DataFrame:
    """(instrument, flowcell, ready_at) through a processing-time timer; needs the RocksDB state store. `version` may be missing from the listing."""
    if "version" not in listing.columns:
        listing = listing.withColumn("version", F.lit(None).cast("string"))
    return listing.withColumn("at", F.unix_millis("mtime")).groupBy("instrument", "flowcell").transformWithStateInPandas(Settle(settle_s), "instrument string, flowcell string, ready_at timestamp", "Append", "processingTime")


class Timed(StatefulProcessor):
    """State of a key with one event-time timer at most."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "at long")

    def at_time(self, ms: int | None) -> None:
        """Sets the key's timer, or none."""
        before = self.timer.get()[0] if self.timer.exists() else None
        if before == ms:
            return
        if before is not None:
            self.handle.deleteTimer(before)
        if ms is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def close(self) -> None:
        pass


#: A time that no marker has, in milliseconds.
NEVER = 1 << 62
#: The columns of a run's first marker times.
FIRST = {"finished": FINISHED, "complete": COMPLETE, **{f"copy{k}": f for k, f in enumerate((NETCOPY, *(f for f in NETCOPIES if f != NETCOPY)))}}


class SettleByEventTime(Timed):
    """Emits a run once, when the watermark passes the time at which it is ready; forgets it `keep_s` later.

    That time follows from the first arrival of each marker alone, so it is the same however markers are dealt to micro-batches.
    A key is a bucket of runs, whose state is one table with a row a run and whose timer is that of the run that is next, so that
    each call works on columns; state calls for each run cost many times as much.
    """

    def __init__(self, settle_s: int, keep_s: int):
        self.settle_ms, self.keep_ms = settle_s * 1000, keep_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.runs = handle.getValueState("runs", "runs binary")

    def _read(self) -> pd.DataFrame | None:
        return pa.ipc.open_stream(self.runs.get()[0]).read_pandas() if self.runs.exists() else None

    def _write(self, runs: pd.DataFrame) -> None:
        """The bucket's runs, and its timer: when the next of them is ready or to be forgotten."""
        if len(runs):
            batch, sink = pa.RecordBatch.from_pandas(runs, preserve_index=False), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            self.runs.update((sink.getvalue().to_pybytes(),))
        else:
            self.runs.clear()
        at = min((self._due(runs).where(runs["done"] == NEVER, runs["done"] + self.keep_ms)).tolist(), default=NEVER)
        self.at_time(at if at < NEVER else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([pdf[["instrument", "flowcell", "version", *FIRST]].assign(done=NEVER) for pdf in rows])
        before = self._read()
        both = new if before is None else pd.concat([before, new])
        least = {c: "min" for c in (*FIRST, "done")}
        self._write(both.groupby(["instrument", "flowcell"], as_index=False, dropna=False, sort=False).agg({"version": "max"} | least))
        return iter(())

    def _due(self, runs: pd.DataFrame) -> pd.Series:
        """When each run is ready, in milliseconds; NEVER as things stand."""
        copies = [runs[c] for c in FIRST if c.startswith("copy")]
        copied = pd.concat([copies[0] + self.settle_ms, *copies[1:]], axis=1).max(axis=1)
        judged = runs["version"].str.contains(NETCOPY_VERSION, regex=False) & (pd.concat(copies, axis=1).max(axis=1) < NEVER)
        machine = pd.concat([runs["complete"], copied.where(judged, NEVER)], axis=1).min(axis=1)
        by_hand = runs["flowcell"].str.contains(BY_HAND, regex=False).fillna(False).astype(bool)
        return pd.concat([runs["finished"], machine.where(~by_hand, NEVER)], axis=1).min(axis=1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        runs = self._read()
        if runs is None:
            return
        past = lambda t: (t < now) | (t <= at)
        runs = runs[(runs["done"] == NEVER) | ~past(runs["done"] + self.keep_ms)].reset_index(drop=True)
        due = self._due(runs)
        ready = (runs["done"] == NEVER) & past(due)
        runs["done"] = runs["done"].where(~ready, due)
        self._write(runs)
        if ready.any():
            yield runs.loc[ready, ["instrument", "flowcell"]].assign(ready=due[ready])


class Ledger(Timed):
    """Emits a key at its first marker, and again at a marker that comes more than `keep_s` after the one before it; keeps it no longer than that."""

    def __init__(self, keep_s: int):
        self.keep_ms = keep_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, started = self.last.get()[0] if self.last.exists() else None, []
        for at in sorted(t for pdf in rows for t in pdf["at"].tolist()):
            if last is None or at - last > self.keep_ms:
                started.append(at)
            last = at if last is None else max(last, at)
        self.last.update((last,))
        self.at_time(last + self.keep_ms)
        if started:
            yield pd.DataFrame({"instrument": [key[0]] * len(started), "flowcell": [key[1]] * len(started), "start": started})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        self.last.clear()
        return iter(())


def _timed(listing: DataFrame, late: str):
    """Runs with their markers' times in milliseconds: pandas would show timestamps in the session's time zone, while timers are in UTC."""
    return listing.withWatermark("mtime", late).withColumn("at", F.unix_millis("mtime")).groupBy("instrument", "flowcell")


def settled_by_event_time(listing: DataFrame, settle_s: int = SETTLE_S, late: str = "1 hour", keep_s: int = 30 * 86_400, buckets: int = 2048) -> DataFrame:
    """(instrument, flowcell, ready_at): each run once, at the event time at which its markers make it ready, for markers at most `late` behind the newest.

    Needs the RocksDB state store. A replay of the same markers gives the same rows; of several versions of a run the greatest
    counts. State is bounded: a run is forgotten `keep_s` after it was ready. It is kept by `buckets` of runs, and a micro-batch
    writes anew those it has markers for; the number must stay as it is for a checkpoint.
    """
    times = {c: F.when(F.col("file") == name, F.unix_millis("mtime")).otherwise(NEVER) for c, name in FIRST.items()}
    marks = listing.withWatermark("mtime", late).select("instrument", "flowcell", "mtime", F.coalesce("version", F.lit("")).alias("version"), *(v.alias(c) for c, v in times.items()), F.pmod(F.xxhash64("instrument", "flowcell"), F.lit(buckets)).alias("bucket"))
    found = marks.groupBy("bucket").transformWithStateInPandas(SettleByEventTime(settle_s, keep_s), "instrument string, flowcell string, ready long", "Append", "eventTime")
    return found.select("instrument", "flowcell", F.timestamp_millis("ready").alias("ready_at"))


def ledger(listing: DataFrame, late: str = "1 hour", keep_s: int = 7 * 86_400) -> DataFrame:
    """(instrument, flowcell, started): each run at its first finished marker, and again after more than `keep_s` without one; later markers than `late` are dropped.

    Needs the RocksDB state store. A key is kept until the watermark is `keep_s` past its last marker, so state does not grow with time.
    """
    found = _timed(listing.where(F.col("file") == FINISHED), late).transformWithStateInPandas(Ledger(keep_s), "instrument string, flowcell string, start long", "Append", "eventTime")
    return found.select("instrument", "flowcell", F.timestamp_millis("start").alias("started"))


def marker_stream(spark: SparkSession, root: str, archive: str | None = None, **options: str) -> DataFrame:
    """(instrument, flowcell, file, mtime) of marker files root/instrument/flowcell/file as they arrive; contents are not read.

    The driver looks for the runs' folders, and Spark jobs list what they hold. These and the stream have a few tasks a core, however
    many files there are: by Spark's defaults a listing has up to 10,000, and each 32 files are a task and a part file of what is written.

    With `archive`, a folder outside of `root`, files that a finished micro-batch has read are moved there, so that listing the root
    does not slow down as runs pile up. Names that begin with a dot or an underscore are hidden from Spark's sources.
    """
    if archive:
        options = options | {"cleanSource": "archive", "sourceArchiveDir": archive}
    schema = "path string, modificationTime timestamp, length long, content binary"
    with _with_settings(spark, _few_listing_tasks(spark)):
        found = spark.readStream.format("binaryFile").schema(schema).options(**options).load(f"{root}/*/*").select("path", "modificationTime")
    found = found.coalesce(CORE_TASKS * spark.sparkContext.defaultParallelism)
    parts = F.split("path", "/")
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    depth = len(at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().getPath().rstrip("/").split("/"))
    found = found.where(F.size(F.split(F.regexp_replace("path", "^[a-z0-9]+:(//[^/]*)?/", "/"), "/")) == depth + 3)  # not what lies beside the runs' folders
    return found.select(*(F.element_at(parts, -k).alias(c) for k, c in ((3, "instrument"), (2, "flowcell"), (1, "file"))), F.col("modificationTime").alias("mtime"))


ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Tasks for each core that list folders or read files which are nothing but names.
CORE_TASKS, LISTING_TASKS = 4, "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _few_listing_tasks(spark: SparkSession) -> dict[str, str]:
    return {LISTING_TASKS: str(min(int(spark.conf.get(LISTING_TASKS)), CORE_TASKS * spark.sparkContext.defaultParallelism))}


@contextlib.contextmanager
def _with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def run_to_end(out: DataFrame, path: str, checkpoint: str) -> None:
    """Appends what the stream gives to the Parquet folder `path` until nothing is left to read; a later call with the same checkpoint goes on from there."""
    spark = out.sparkSession
    with _with_settings(spark, dict([ROCKS]) | _few_listing_tasks(spark)):
        out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
