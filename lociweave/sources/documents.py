"""Document table, bulk text and stored lookup results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lociweave.operators.combine import SPAN_BITS
from lociweave.operators.documents import DOC_COLUMNS, as_declared, bulk_lines, one_per_id, upsert_documents
from lociweave.operators.lookup import rsid_index
from lociweave.schemas import RSID_INDEX, VARIANT_DOCS
from lociweave.session import balanced, create_once, next_claim, path_exists, replacing, staged, table_complete
from lociweave.sources.tables import clustered


def write_documents(docs: DataFrame, path: str, in_order: bool = False) -> int:
    """Documents by chrom and in position order; returns how many were written.

    The count is taken by the write itself, not by a second run of the plan.
    ``in_order`` says that ``docs`` come from a table already written that
    way: each task then keeps its rows and nothing is shuffled.
    """
    seen = Observation()
    declared = as_declared(docs)
    ordered = declared.sortWithinPartitions("chrom", "pos") if in_order else clustered(declared, "chrom")
    declared = ordered.observe(seen, F.count(F.lit(1)).alias("n"))
    replacing(declared).partitionBy("chrom").parquet(path)
    return seen.get["n"]


def ensure_documents(spark: SparkSession, path: str) -> None:
    """An empty document table with the declared fields when there is none."""
    if not path_exists(spark, path):
        spark.createDataFrame([], VARIANT_DOCS).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VARIANT_DOCS).parquet(path).select(*DOC_COLUMNS)


def upsert_into(spark: SparkSession, current: str, incoming: DataFrame, target: str) -> int:
    """Write the upserted table as a new version at ``target``; ``current`` is kept."""
    if current.rstrip("/") == target.rstrip("/"):
        raise ValueError("an upsert is written beside the table it reads")
    return write_documents(upsert_documents(read_documents(spark, current), as_declared(incoming)), target)


# -- versioned store ---------------------------------------------------------
#
# ``rows/v=N/chrom=C/part=P`` holds the documents of one megabase as version N left
# them, ``parts/v=N`` which megabases that version wrote. ``commits/K`` names the
# K-th version that counts; it was made on the K before it, so their numbers rise.
# Of each megabase the latest version that wrote it holds.


def _parted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("part", F.shiftright("pos", SPAN_BITS))


def committed(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions that count: one short line for each."""
    path = f"{base}/commits"
    return sorted(int(r.value) for r in spark.read.text(path).collect()) if path_exists(spark, path) else []


def live_parts(spark: SparkSession, base: str) -> DataFrame:
    """``v, chrom, part``: one row per megabase of the genome at most."""
    parts = spark.read.schema("chrom string, part int, v int").parquet(f"{base}/parts")
    done = parts.filter(F.col("v").isin(committed(spark, base)))
    return done.groupBy("chrom", "part").agg(F.max("v").alias("v"))


def stored_rows(spark: SparkSession, base: str) -> DataFrame:
    """Live rows with their ``part``; folders of older versions are pruned at run time."""
    rows = spark.read.schema(f"{VARIANT_DOCS}, part int, v int").parquet(f"{base}/rows")
    return rows.join(F.broadcast(live_parts(spark, base)), ["v", "chrom", "part"], "left_semi").drop("v")


def read_store(spark: SparkSession, base: str) -> DataFrame:
    """The documents of the latest version; empty where nothing was stored."""
    if not committed(spark, base):
        return spark.createDataFrame([], VARIANT_DOCS).select(*DOC_COLUMNS)
    return stored_rows(spark, base).select(*DOC_COLUMNS)


def upsert_store(spark: SparkSession, base: str, incoming: DataFrame, order: str | None = None, attempts: int = 10) -> int:
    """Documents written over the stored ones; returns the number of the new version.

    Only megabases that ``incoming`` has documents of are read and written, as a
    new version beside the earlier ones; the first call stores the table. Of
    several incoming documents of one id the last by ``order`` holds. A writer
    that another one overtook does its version again on top of the other's.
    """
    by = [] if order is None else [F.col(order).alias("_order")]
    latest = one_per_id(_parted(as_declared(incoming, *by)), "_order" if by else None)
    fresh = staged(latest, f"{base}/incoming/{uuid.uuid4().hex}")
    # Megabases that are written: bounded by the genome.
    touched = fresh.select("chrom", "part").distinct()
    for _ in range(attempts):
        done = committed(spark, base)
        version = next_claim(spark, f"{base}/versions")
        rows = fresh
        if done:
            stored = stored_rows(spark, base).join(F.broadcast(touched), ["chrom", "part"], "left_semi")
            rows = stored.join(fresh.select("variant_id"), "variant_id", "left_anti").unionByName(fresh)
        ordered = balanced(rows, "chrom", "part").sortWithinPartitions("chrom", "part", "pos")
        replacing(ordered).partitionBy("chrom", "part").parquet(f"{base}/rows/v={version}")
        replacing(touched.coalesce(1)).parquet(f"{base}/parts/v={version}")
        # The place after the versions seen is taken once: whoever takes it is next.
        if create_once(spark, f"{base}/commits/{len(done):012d}", str(version)):
            return version
    raise RuntimeError(f"{base}: overtaken {attempts} times")


def write_rsid_index(spark: SparkSession, documents: str, path: str) -> None:
    """The rsids of a stored document table with their places, in rsid order over all files.

    Written with the documents; a lookup opens the row groups whose range holds its rsid.
    """
    listed = rsid_index(read_documents(spark, documents))
    replacing(listed.repartitionByRange("rsid").sortWithinPartitions("rsid", "chrom", "pos")).parquet(path)


def read_rsid_index(spark: SparkSession, path: str) -> DataFrame:
    if not table_complete(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(RSID_INDEX).parquet(path)


def write_bulk_text(docs: DataFrame, index: str, path: str) -> None:
    """Bulk-load text files, an action and a document line per document.

    Every task writes its own file; nothing passes through the driver.
    """
    replacing(bulk_lines(docs, index)).text(path)


def write_by_interval(results: DataFrame, interval_id: str, path: str) -> None:
    """Stored batch lookup, ordered by interval so that one id reads a narrow range."""
    replacing(balanced(results, interval_id).sortWithinPartitions(interval_id, "rank")).parquet(path)


def read_interval(spark: SparkSession, path: str, interval_id: str, value: str) -> DataFrame:
    """The stored result of one gene or transcript."""
    if not table_complete(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path).filter(F.col(interval_id) == value).orderBy("rank")
