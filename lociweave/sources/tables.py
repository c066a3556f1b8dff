"""Cohort store, keyed tables, metadata and run log.

Store layout: all tables are partitioned by the run that added their rows. A
version is its run and the runs before it, so a merge writes new entries only and
earlier versions stay as they are. A run's ``sites`` are the loci it touched, with
their allele lists as of then; of a locus the latest row holds. From time to
time ``sites_full`` holds a version's whole list, so that a reader has few runs to
lay over each other.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave import schemas
from lociweave.operators.annotate import first_per_key
from lociweave.operators.combine import Cohort, latest_sites
from lociweave.session import balanced, create_once, path_exists, replacing, table_complete

CLUSTER_BITS = 20
#: Runs whose touched sites are laid over each other before a whole list is written again.
COMPACT_AFTER = 8


def clustered(df: DataFrame, contig: str = "contig") -> DataFrame:
    """Rows of a megabase together and in order, so that files cover narrow position ranges.

    A crowded megabase is split over several files, each in order.
    """
    near = df.withColumn("_near", F.shiftright("pos", CLUSTER_BITS))
    return balanced(near, contig, "_near").sortWithinPartitions(contig, "pos").drop("_near")


def write_cohort_run(entries: Cohort, base: str, run_id: str) -> None:
    """Add one run's entries and the sites it touched under ``base``.

    A repeated write of the same run replaces its own folders only, so a
    crashed run can be done again.
    """
    parts = {"calls": clustered(entries.calls), "ref_blocks": clustered(entries.ref_blocks), "sites": clustered(entries.sites)}
    for name, df in parts.items():
        replacing(df).partitionBy("contig").parquet(f"{base}/{name}/run_id={run_id}")
    replacing(entries.samples).parquet(f"{base}/samples/run_id={run_id}")


def _full_until(spark: SparkSession, base: str, run_ids: list[str]) -> int:
    """How many of the runs the latest whole site list covers, 0 where there is none."""
    for n in range(len(run_ids), 0, -1):
        if table_complete(spark, f"{base}/sites_full/run_id={run_ids[n - 1]}"):
            return n
    return 0


def _sites(spark: SparkSession, base: str, run_ids: list[str]) -> DataFrame:
    """The whole list of a version: its last full one and the runs since, the latest row of each locus."""
    covered = _full_until(spark, base, run_ids)
    lists = [f"{base}/sites_full/run_id={run_ids[covered - 1]}"] if covered else []
    lists += [f"{base}/sites/run_id={r}" for r in run_ids[covered:]]
    read = [spark.read.schema(schemas.SITES).parquet(path).withColumn("nth", F.lit(n)) for n, path in enumerate(lists)]
    return read[0].drop("nth") if len(read) == 1 else latest_sites(reduce(DataFrame.unionByName, read), "nth")


def compact_sites(spark: SparkSession, base: str, run_ids: list[str], after: int = COMPACT_AFTER) -> bool:
    """Writes the whole site list of the latest version once ``after`` runs have come since the last; tells whether it did."""
    if len(run_ids) - _full_until(spark, base, run_ids) < after:
        return False
    replacing(clustered(_sites(spark, base, run_ids))).partitionBy("contig").parquet(f"{base}/sites_full/run_id={run_ids[-1]}")
    return True


def read_cohort(spark: SparkSession, base: str, run_ids: list[str]) -> Cohort:
    """The version of the last of ``run_ids``; the list names every run it builds on, in order."""

    def entries(name: str, ddl: str) -> DataFrame:
        folders = [f"{base}/{name}/run_id={r}" for r in run_ids]
        reader = spark.read.schema(f"{ddl}, run_id string").option("basePath", f"{base}/{name}")
        return reader.parquet(*folders).drop("run_id")

    return Cohort(
        sites=_sites(spark, base, run_ids),
        calls=entries("calls", schemas.CALLS),
        ref_blocks=entries("ref_blocks", schemas.REF_BLOCKS),
        samples=entries("samples", schemas.SAMPLES),
    )


def write_standalone(cohort: Cohort, path: str) -> None:
    """One self-contained cohort folder; refuses to replace an existing one."""
    for name in ("calls", "ref_blocks", "sites"):
        clustered(getattr(cohort, name)).write.mode("errorifexists").partitionBy("contig").parquet(f"{path}/{name}")
    cohort.samples.write.mode("errorifexists").parquet(f"{path}/samples")


def read_standalone(spark: SparkSession, path: str) -> Cohort:
    """A folder of :func:`write_standalone`."""
    return Cohort(
        sites=spark.read.schema(schemas.SITES).parquet(f"{path}/sites"),
        calls=spark.read.schema(schemas.CALLS).parquet(f"{path}/calls"),
        ref_blocks=spark.read.schema(schemas.REF_BLOCKS).parquet(f"{path}/ref_blocks"),
        samples=spark.read.parquet(f"{path}/samples"),
    )


def sample_count(cohort: Cohort) -> int:
    """Number of samples of a store."""
    return cohort.samples.count()


def write_annotated(variants: DataFrame, path: str, overwrite: bool = False) -> None:
    """Annotated variants, by contig and in position order."""
    near = clustered(variants)
    writer = replacing(near) if overwrite else near.write.mode("errorifexists")
    writer.partitionBy("contig").parquet(path)


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """Annotated variants; contig names stay text although some look like numbers."""
    stored = spark.read.parquet(path)
    return stored.withColumn("contig", F.col("contig").cast("string"))


def materialize_once(
    spark: SparkSession, path: str, source: str | None, build: Callable[[], DataFrame], keys: list[str]
) -> DataFrame:
    """The table at ``path``, built from ``source`` on first use with one row per key.

    A write that did not finish does not count as the table.
    """
    if not table_complete(spark, path):
        if source is None or not path_exists(spark, source):
            raise FileNotFoundError(f"neither the table {path} nor its source {source} exists")
        replacing(clustered(first_per_key(build(), keys))).parquet(path)
    return spark.read.parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Sample metadata CSV: every column text, the empty field missing.

    Columns come from the header line, so extra ones pass through.
    """
    return spark.read.csv(path, header=True, sep=",", nullValue="", emptyValue="", inferSchema=False)


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A JSON run manifest as ``(runs, run_files)``; both empty when there is none.

    ``seq`` is the position in the manifest's list.
    """
    if path_exists(spark, path):
        manifest = spark.read.schema(schemas.MANIFEST).json(path, multiLine=True)
    else:
        manifest = spark.createDataFrame([], schemas.MANIFEST)
    listed = manifest.select(F.posexplode("runs").alias("seq", "r"))
    runs = listed.select(
        "r.run_id", F.col("seq").cast("long").alias("seq"), "r.status",
        F.col("r.vds_path").alias("cohort_path"), "r.temp_path",
        F.expr("try_cast(coalesce(r.completed_at, r.started_at) as timestamp)").alias("event_at"), "r.n_samples",
    )
    return runs, listed.select("r.run_id", F.explode("r.gvcfs").alias("gvcf"))


class RunLogConflict(RuntimeError):
    """Another writer was first."""


def append_run_event(
    spark: SparkSession, log: str, run_id: str, seq: int, status: str,
    cohort_path: str | None = None, temp_path: str | None = None, n_samples: int | None = None,
) -> None:
    """One event under its number; refused where that number is taken."""
    event = {
        "run_id": run_id, "seq": seq, "status": status, "cohort_path": cohort_path, "temp_path": temp_path,
        "event_at": datetime.now(timezone.utc).isoformat(), "n_samples": n_samples,
    }
    if not create_once(spark, f"{log}/events/{seq:012d}.json", json.dumps(event) + "\n"):
        raise RunLogConflict(f"event {seq} of {log} is taken")


def publish_run_event(spark: SparkSession, log: str, decide: Callable[[DataFrame, DataFrame], dict], attempts: int = 1000) -> dict:
    """The next event, decided from the log as it stands just before.

    ``decide`` gets ``(run_events, run_files)`` and returns the event's fields.
    Where another event came in between, it decides again on the longer log.
    """
    for _ in range(attempts):
        events, files = read_run_log(spark, log)
        seq = events.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("n")).first().n + 1
        fields = decide(events, files)
        try:
            append_run_event(spark, log, seq=seq, **fields)
        except RunLogConflict:
            continue
        return fields
    raise RunLogConflict(f"{log}: {attempts} attempts")


def read_run_log(spark: SparkSession, log: str) -> tuple[DataFrame, DataFrame]:
    """``(run_events, run_files)`` of a log folder, empty when it does not exist."""
    events, files = f"{log}/events", f"{log}/files"
    return (
        spark.read.schema(schemas.RUN_EVENTS).json(events) if path_exists(spark, events)
        else spark.createDataFrame([], schemas.RUN_EVENTS),
        spark.read.schema(schemas.RUN_FILES).parquet(files) if path_exists(spark, files)
        else spark.createDataFrame([], schemas.RUN_FILES),
    )
