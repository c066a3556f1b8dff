"""Session settings, and how tables are written and staged."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


PARTITION_BYTES = 128 << 20


def build_session(
    app: str = "lociweave", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the operators count on.

    Skewed joins are split and small partitions merged at run time; join
    sides are broadcast only below the size threshold Spark measures.
    ``shuffle_bytes`` is the largest shuffle to expect, roughly the calls a
    run adds: it sets how many partitions a shuffle starts with, so that
    none outgrows an executor, and what is too many is merged again.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PARTITION_BYTES))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    if shuffle_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffle_bytes)))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions of about 128 MB, 200 at least."""
    return max(200, -(-shuffle_bytes // PARTITION_BYTES))


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of a key together before a write, with even partitions.

    Unlike a plain repartition this lets run-time statistics split a hot key
    over several tasks and merge small ones.
    """
    return df.hint("rebalance", *keys)


def replacing(df: DataFrame) -> DataFrameWriter:
    """Writer that replaces the whole target, whatever the session's partition overwrite mode."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table once and read it back: later uses start from its files.

    ``path`` is on the storage all executors share, so nothing is recomputed
    from the start when some of them are lost.
    """
    replacing(df).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _target(spark: SparkSession, path: str) -> tuple:
    """A path and the filesystem its scheme names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever filesystem its scheme names."""
    target, system = _target(spark, path)
    return system.exists(target)


def table_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table write at ``path`` ran to its end."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def create_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Writes a small file unless there is one; False where another writer was first.

    Rests on the filesystem's own exclusive create. Its local form only looks
    before it writes, so local files are linked into place instead.
    """
    target, system = _target(spark, path)
    if system.getUri().getScheme() == "file":
        local = target.toUri().getPath()
        folder, name = os.path.split(local)
        os.makedirs(folder, exist_ok=True)
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with open(draft, "w") as file:
            file.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        out = system.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def claimed(spark: SparkSession, folder: str) -> list[int]:
    """Numbers that were given in a folder."""
    target, system = _target(spark, folder)
    names = [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []
    return [int(n) for n in names if n.isdigit()]


def next_claim(spark: SparkSession, folder: str) -> int:
    """A number that nobody else was given, one above the highest so far; the first is 0."""
    number = max(claimed(spark, folder), default=-1) + 1
    while not create_once(spark, f"{folder.rstrip('/')}/{number:012d}"):
        number += 1
    return number
