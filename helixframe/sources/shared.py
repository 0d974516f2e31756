"""The folder that driver and executors share."""

from __future__ import annotations

import itertools
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which is also made Spark's checkpoint folder. In local mode, and only there, a new local folder if it is unset."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="spark-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    """The name of a new folder there."""
    return f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"


#: Bytes of a header or sample table, at most, that are broadcast; they are added up first.
BROADCAST_BYTES = 32 << 20


def stored(df: DataFrame, kind: str = "stored") -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared folder, whose size the planner knows and which outlives any executor."""
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of `df` take at most `most` bytes (text, and 16 a column)."""
    width = lambda c, kind: F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) + 16 if kind == "string" else F.lit(16)
    size = df.agg(F.sum(sum((width(c, k) for c, k in df.dtypes), F.lit(0)).cast("long"))).first()[0]
    return (size or 0) <= most


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if `df` is small, else `df` as it is."""
    return F.broadcast(df) if is_small(df, most) else df


#: Files that a task writes, where each key has a file of its own, and a setting by which tasks put files in place, which the driver would else do one by one at the end.
TASK_FILES, BY_TASKS = 250, {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
#: What Spark writes as %XX in the name of a key's folder, and the name where the key is null or empty.
ESCAPED, NO_KEY = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]"""), "__HIVE_DEFAULT_PARTITION__"


def local_path(spark: SparkSession, path: str) -> str | None:
    """`path` as a path of the file system that all machines mount, or None if it is in another store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def write_folders(df: DataFrame, path: str, *keys: str) -> None:
    """Appends text files, one for each value of the keys, to folders of their names.

    Tasks are as many as the files need: by their size in bytes, as Spark would join partitions, one task would write all of them.
    On a mounted file system tasks write the files themselves, to the same folders: Hadoop's local one starts two processes a file.
    """
    tasks = df.select(*keys).distinct().count() // TASK_FILES + 1
    root = local_path(df.sparkSession, path)
    if root is None:
        df.repartition(tasks, *keys).write.mode("append").options(**BY_TASKS).partitionBy(*keys).text(path)
        return
    (value,) = (c for c in df.columns if c not in keys)
    rows = df.select(*(F.nullif(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys), value).repartition(tasks, *keys).sortWithinPartitions(*keys)
    os.makedirs(root, exist_ok=True)
    rows.foreachPartition(_folder_writer(root, keys, uuid.uuid4().hex))


def _folder_writer(root: str, keys: tuple[str, ...], call: str) -> Callable[[Iterable], None]:
    """Writes a task's rows (keys, value), which are in order of the keys. A task that is run again writes the same files over."""

    def folder(key: tuple[str | None, ...]) -> str:
        named = (f"{k}={ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', v) if v is not None else NO_KEY}" for k, v in zip(keys, key, strict=True))
        return "/".join((root, *named))

    def write(rows: Iterable) -> None:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{call}.txt"
        for key, lines in itertools.groupby(rows, key=lambda r: tuple(r[:-1])):
            at = folder(key)
            os.makedirs(at, exist_ok=True)
            draft = f"{at}/.{name}.{task.taskAttemptId()}"
            with open(draft, "w", encoding="utf-8", newline="") as out:
                out.writelines(f"{'' if r[-1] is None else r[-1]}\n" for r in lines)
            os.replace(draft, f"{at}/{name}")  # whole or not at all, for a stream that looks meanwhile

    return write
