"""gVCF folder to the next cohort version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.operators import runs as run_ops
from lociweave.operators.combine import Cohort, duplicate_loci, filter_records, new_entries, shared_samples, variant_records
from lociweave.session import replacing, staged
from lociweave.sources import tables
from lociweave.sources.vcf import good_records, sample_of
from lociweave.streaming.file_ingest import file_status, ingest_new_files, staged_records


#: How often a run starts over where others came first.
ATTEMPTS = 10


@dataclass
class IngestFolders:
    """Where an ingest keeps its tables; one root on shared storage."""

    root: str

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def claims(self) -> str:
        return f"{self.root}/batch_claims"

    @property
    def cohort(self) -> str:
        return f"{self.root}/cohort"

    @property
    def temp(self) -> str:
        return f"{self.root}/temp"

    @property
    def duplicates(self) -> str:
        return f"{self.root}/duplicate_records"

    @property
    def log(self) -> str:
        return f"{self.root}/run_log"


def completed_runs(spark: SparkSession, folders: IngestFolders) -> list[str]:
    """Ids of the completed runs in order: a handful of short names."""
    return _completed(tables.read_run_log(spark, folders.log)[0])


def _completed(events: DataFrame) -> list[str]:
    """In the order they came out: each builds on all before it, whenever it was begun."""
    last = events.groupBy("run_id").agg(F.max(F.struct("seq", "status")).alias("last"))
    done = last.filter(F.col("last.status") == run_ops.COMPLETED).orderBy("last.seq")
    return [row.run_id for row in done.select("run_id").collect()]


def latest_cohort(spark: SparkSession, folders: IngestFolders) -> Cohort | None:
    """The cohort of the latest completed run, None before the first."""
    done = completed_runs(spark, folders)
    return tables.read_cohort(spark, folders.cohort, done) if done else None


def _start_or_resume(spark: SparkSession, folders: IngestFolders, date: str, resume: bool) -> tuple[str, DataFrame] | None:
    """``(run_id, files)`` of the run to do; None when every finished file is in a completed run.

    Without ``resume`` files of runs in progress are left to whoever does them.
    """
    events, files = tables.read_run_log(spark, folders.log)
    runs = run_ops.run_states(events)
    pending = run_ops.latest_run(runs, run_ops.IN_PROGRESS).select("run_id").collect() if resume else []
    if pending:
        run_id = pending[0].run_id
        return run_id, files.filter(F.col("run_id") == run_id).select("gvcf")
    finished = file_status(spark, folders.staging).filter(F.col("status") == "done").select("gvcf")

    def open_files(events: DataFrame, files: DataFrame) -> DataFrame:
        runs = run_ops.run_states(events)
        return run_ops.new_files(finished, runs, files, () if resume else (run_ops.IN_PROGRESS,))

    def claim(events: DataFrame, files: DataFrame) -> dict:
        run_id = run_ops.next_run_id(run_ops.run_states(events), date).first().run_id
        return {"run_id": run_id, "status": run_ops.CLAIMED, "cohort_path": folders.cohort}

    for _ in range(ATTEMPTS):
        if open_files(*tables.read_run_log(spark, folders.log)).isEmpty():
            return None
        run_id = tables.publish_run_event(spark, folders.log, claim)["run_id"]
        # Files before the event: a run without its files is never seen as started.
        fresh = open_files(*tables.read_run_log(spark, folders.log))
        fresh.select(F.lit(run_id).alias("run_id"), "gvcf").write.mode("append").parquet(f"{folders.log}/files")
        _record(spark, folders, run_id, run_ops.IN_PROGRESS)
        events, files = tables.read_run_log(spark, folders.log)
        mine = files.filter(F.col("run_id") == run_id).select("gvcf").distinct()
        if resume or run_ops.files_begun_before(events, files, run_id).isEmpty():
            return run_id, mine
        # Another ingest began some of these files first: all of them are open again.
        _record(spark, folders, run_id, run_ops.FAILED)
    raise tables.RunLogConflict(f"no files of its own after {ATTEMPTS} attempts")


def _record(spark: SparkSession, folders: IngestFolders, run_id: str, status: str) -> None:
    tables.publish_run_event(
        spark, folders.log, lambda *_: {"run_id": run_id, "status": status, "cohort_path": folders.cohort}
    )


def _complete(spark: SparkSession, folders: IngestFolders, run_id: str, earlier: list[str], n_samples: int) -> None:
    """Publishes a version, unless another one came out since it was begun."""

    def decide(events: DataFrame, _: DataFrame) -> dict:
        if _completed(events) != earlier:
            raise tables.RunLogConflict(f"{run_id} does not follow the latest version")
        return {"run_id": run_id, "status": run_ops.COMPLETED, "cohort_path": folders.cohort, "n_samples": n_samples}

    tables.publish_run_event(spark, folders.log, decide)


def _merge(spark: SparkSession, folders: IngestFolders, run_id: str, files: DataFrame) -> None:
    """One attempt: the run's entries on top of the latest version, written and published."""
    earlier = completed_runs(spark, folders)
    previous = tables.read_cohort(spark, folders.cohort, earlier) if earlier else None
    records = good_records(staged_records(spark, folders.staging, files))
    samples = files.select(sample_of(F.col("gvcf")).alias("sample_id"))
    if previous is not None:
        repeated = shared_samples(previous.samples, samples)
        if not repeated.isEmpty():
            raise ValueError(f"samples already in the cohort, e.g. {repeated.first().sample_id}")
    added = new_entries(
        records, previous.sites if previous else None, samples,
        stage=lambda df, name: staged(df, f"{folders.temp}/{run_id}/{name}"),
    )
    tables.write_cohort_run(added, folders.cohort, run_id)
    # Records that a better one of the same sample and locus stood for: one row per sample that has some.
    replacing(duplicate_loci(variant_records(filter_records(records)))).parquet(f"{folders.duplicates}/run_id={run_id}")
    n_samples = tables.sample_count(tables.read_cohort(spark, folders.cohort, [*earlier, run_id]))
    _complete(spark, folders, run_id, earlier, n_samples)
    tables.compact_sites(spark, folders.cohort, [*earlier, run_id])


def ingest(
    spark: SparkSession, gvcf_dir: str, root: str, date: str, max_files_per_batch: int = 10000,
    resume: bool = True,
) -> str | None:
    """Stage new files, merge those no completed run holds, write the version, log it.

    Returns the run id, or None when there is nothing to do. A run left in
    progress is done again with its recorded files; any failure is logged
    and its files stay open. Ingests that run side by side pass ``resume=False``:
    each then does a run of its own over the files nobody else has begun, and one
    that another version overtook is merged again on top of it.
    """
    folders = IngestFolders(root)
    ingest_new_files(spark, gvcf_dir, folders.staging, folders.claims, max_files_per_batch)
    started = _start_or_resume(spark, folders, date, resume)
    if started is None:
        return None
    run_id, files = started
    try:
        for attempt in range(ATTEMPTS):
            try:
                _merge(spark, folders, run_id, files)
                return run_id
            except tables.RunLogConflict:
                if attempt + 1 == ATTEMPTS:
                    raise
    except BaseException:
        _record(spark, folders, run_id, run_ops.FAILED)
        raise
