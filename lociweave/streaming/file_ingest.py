"""Each version of a gVCF file once: new files into staged records and a per-file status log.

A file is known by its name, length and time of change, so one that was
repaired under its old name is new, and one that nobody touched is not read
again. Files are read in batches; every batch takes a number of its own, and what
it staged counts only through the status rows written after it. A batch that was
interrupted, or that another ingest did at the same time, therefore neither loses
nor doubles anything. A file that cannot be decoded fails alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.session import next_claim, path_exists, replacing
from lociweave.sources.gzip_lines import File, gzip_lines, listed_files
from lociweave.sources.vcf import GVCF_GLOB, named_lines, parse_gvcf

LISTED = "gvcf string, length long, modified timestamp"
STATUS = f"n_records long, status string, seconds double, error string, batch_id long, {LISTED}"
#: What the log keeps of an error.
ERROR_CHARS = 200


def unseen_files(listing: DataFrame, status_log: DataFrame) -> DataFrame:
    """Files of a listing (``gvcf, length, modified``) that were never read as they are now."""
    return listing.join(status_log.select("gvcf", "length", "modified"), ["gvcf", "length", "modified"], "left_anti")


def _stage_batch(spark: SparkSession, files: list, out: str, batch_id: int) -> None:
    """Reads some files; records and closing rows are written first, then the status of each file."""
    lines = gzip_lines(spark, [File(f.path, f.length) for f in files], errors="report")
    staged = f"{out}/records/batch_id={batch_id}"
    # One pass over the compressed text; everything else reads the staged table.
    replacing(parse_gvcf(named_lines(lines))).parquet(staged)
    counts = spark.read.parquet(staged).groupBy("gvcf").agg(
        F.count_if(~F.col("is_header") & ~F.col("is_end")).alias("n_records"), F.count_if("malformed").alias("n_malformed"),
        F.sum("seconds").alias("seconds"), F.min("error").alias("wrong"),
    )
    malformed = F.when(F.col("n_malformed") > 0, F.format_string("%d malformed lines", "n_malformed"))
    error = F.substring(F.coalesce("wrong", malformed), 1, ERROR_CHARS)
    batch = spark.createDataFrame([(f.gvcf, f.length, f.modified) for f in files], LISTED)
    status = counts.join(F.broadcast(batch), "gvcf").select(
        "n_records", F.when(error.isNotNull(), "failed").otherwise("done").alias("status"), "seconds", error.alias("error"),
        F.lit(batch_id).cast("long").alias("batch_id"), "gvcf", "length", "modified",
    )
    replacing(status.drop("batch_id")).parquet(f"{out}/status/batch_id={batch_id}")


def ingest_new_files(spark: SparkSession, gvcf_dir: str, out: str, claims: str, max_files_per_batch: int = 10000) -> None:
    """Read every file that is new or has changed, at most ``max_files_per_batch`` at once, then stop.

    ``claims`` is the folder where batches take their numbers.
    """
    listing = listed_files(spark, gvcf_dir, GVCF_GLOB).withColumnRenamed("name", "gvcf")
    # Names and sizes only, as any reader lists them.
    todo = unseen_files(listing, status_log(spark, out)).orderBy("gvcf").collect()
    for first in range(0, len(todo), max_files_per_batch):
        _stage_batch(spark, todo[first:first + max_files_per_batch], out, next_claim(spark, claims))


def status_log(spark: SparkSession, out: str) -> DataFrame:
    """One row for each reading of a file."""
    if not path_exists(spark, f"{out}/status"):
        return spark.createDataFrame([], STATUS)
    return spark.read.schema(STATUS).parquet(f"{out}/status")


def file_status(spark: SparkSession, out: str) -> DataFrame:
    """Per-file status; a file read again shows its last batch."""
    latest = status_log(spark, out).groupBy("gvcf").agg(
        F.max(F.struct("batch_id", "n_records", "status", "seconds", "error")).alias("s")
    )
    return latest.select("gvcf", "s.n_records", "s.status", "s.seconds", "s.error", "s.batch_id")


def status_with_skipped(status: DataFrame, since_batch: int) -> DataFrame:
    """The log as one run sees it: files finished before ``since_batch`` were skipped."""
    early = (F.col("batch_id") < since_batch) & (F.col("status") == "done")
    return status.withColumn("status", F.when(early, "skipped").otherwise(F.col("status")))


def staged_records(spark: SparkSession, out: str, gvcfs: DataFrame) -> DataFrame:
    """Staged rows of the given files, from the batch that finished each of them."""
    finished = file_status(spark, out).filter(F.col("status") == "done").select("gvcf", "batch_id")
    wanted = finished.join(gvcfs.select("gvcf").distinct(), "gvcf", "left_semi")
    return spark.read.parquet(f"{out}/records").join(wanted, ["gvcf", "batch_id"], "left_semi").drop("batch_id")
