"""Run log queries and the ingest summary.

The log is append-only: ``run_events`` (one row per event, ``seq`` orders
them) and ``run_files`` (one row per run and file). The last event of a run
is its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPLETED, IN_PROGRESS, FAILED = "completed", "in_progress", "failed"
#: A run that has its id but not yet its list of files.
CLAIMED = "claimed"


def run_states(events: DataFrame) -> DataFrame:
    """One row per run: its last event, with ``seq`` of its first.

    Runs keep the order they were started in, whatever happened to them later.
    """
    state = F.struct("seq", *[c for c in events.columns if c not in ("run_id", "seq")])
    return (
        events.groupBy("run_id").agg(F.min("seq").alias("first_seq"), F.max(state).alias("s"))
        .select("run_id", F.col("first_seq").alias("seq"), *[f"s.{c}" for c in events.columns if c not in ("run_id", "seq")])
    )


def ingested_files(runs: DataFrame, run_files: DataFrame) -> DataFrame:
    """Files of completed runs; files of failed runs stay open for a retry."""
    done = runs.filter(F.col("status") == COMPLETED).select("run_id")
    return run_files.join(done, "run_id", "left_semi").select("gvcf").distinct()


def new_files(listed: DataFrame, runs: DataFrame, run_files: DataFrame, taken_by: tuple[str, ...] = ()) -> DataFrame:
    """Listed files that no completed run holds, nor one of a status in ``taken_by``."""
    held = ingested_files(runs, run_files)
    if taken_by:
        others = runs.filter(F.col("status").isin(*taken_by)).select("run_id")
        held = held.unionByName(run_files.join(others, "run_id", "left_semi").select("gvcf"))
    return listed.select("gvcf").distinct().join(held, "gvcf", "left_anti")


def files_begun_before(events: DataFrame, run_files: DataFrame, run_id: str) -> DataFrame:
    """Files of a run that another run, completed or still in progress, began to ingest before it."""
    begun = events.filter(F.col("status") == IN_PROGRESS).groupBy("run_id").agg(F.min("seq").alias("begun"))
    live = run_states(events).filter(F.col("status").isin(COMPLETED, IN_PROGRESS)).select("run_id")
    held = run_files.join(begun, "run_id").join(live, "run_id", "left_semi")
    mine = held.filter(F.col("run_id") == run_id).select("gvcf", F.col("begun").alias("mine"))
    return held.filter(F.col("run_id") != run_id).join(mine, "gvcf").filter(F.col("begun") < F.col("mine")).select("gvcf").distinct()


def latest_run(runs: DataFrame, status: str) -> DataFrame:
    """The most recently started run with a status; no row when there is none."""
    return runs.filter(F.col("status") == status).orderBy(F.desc("seq")).limit(1)


def next_run_id(runs: DataFrame, date: str) -> DataFrame:
    """One row ``run_id``: the date's highest numeric suffix plus one, three digits or more."""
    prefix = f"{date}_run"
    suffix = F.substring("run_id", len(prefix) + 1, 64)
    number = F.when(
        F.col("run_id").startswith(prefix) & suffix.rlike("^[0-9]+$"), suffix.try_cast("bigint")
    )
    return runs.agg(F.coalesce(F.max(number), F.lit(0)).alias("n")).select(
        F.concat(F.lit(prefix), F.format_string("%03d", F.col("n") + 1)).alias("run_id")
    )


def next_run_ids(runs: DataFrame) -> DataFrame:
    """The same for every date in the log: ``run_date, run_id``."""
    date = F.regexp_extract("run_id", "^(.+)_run", 1)
    number = F.regexp_extract("run_id", "_run([0-9]+)$", 1).try_cast("bigint")
    return (
        runs.groupBy(date.alias("run_date")).agg(F.coalesce(F.max(number), F.lit(0)).alias("n"))
        .filter(F.col("run_date") != "")
        .select(
            "run_date",
            F.concat(F.col("run_date"), F.lit("_run"), F.format_string("%03d", F.col("n") + 1)).alias("run_id"),
        )
    )


def ingest_summary(file_status: DataFrame) -> DataFrame:
    """Counts over per-file status; skipped files count as successful, the mean is over new ones."""
    status = F.col("status")
    new = status == "done"
    return file_status.agg(
        F.count("*").alias("total"),
        F.count_if(status.isin("done", "skipped")).alias("successful"),
        F.count_if(new).alias("new"),
        F.count_if(status == "skipped").alias("skipped"),
        F.count_if(status == "failed").alias("failed"),
        F.avg(F.when(new, F.col("seconds"))).alias("mean_seconds"),
    )


def first_failures(file_status: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` failed files with their shortened error."""
    return (
        file_status.filter(F.col("status") == "failed").orderBy("gvcf").limit(n)
        .select("gvcf", F.substring("error", 1, 100).alias("error"))
    )
