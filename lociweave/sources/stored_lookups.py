"""Stored answers per gene or transcript, kept up with the document store by what it touched.

An interval's home is the megabase it begins in. ``rows/v=N/chrom=C/part=P`` holds
the answers of the intervals at home there as version N left them, and ``parts``,
``versions`` and ``commits`` mean what they do in the document store.
``intervals/v=N`` is the interval table of a version, ``upto/N`` how many versions of the
documents it knows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lociweave.operators.combine import SPAN_BITS
from lociweave.operators.intervals import clipped
from lociweave.operators.lookup import variants_by_interval
from lociweave.schemas import VARIANT_DOCS
from lociweave.session import balanced, create_once, next_claim, replacing, staged
from lociweave.sources.documents import committed, live_parts, stored_rows

HOME = ["chrom", "part"]


def _homes(intervals: DataFrame) -> DataFrame:
    """Intervals with the megabase each begins in as ``part`` and the last it reaches as ``_last``."""
    span = {"part": F.shiftright("start", SPAN_BITS), "_last": F.shiftright("stop", SPAN_BITS)}
    return clipped(intervals).withColumns(span)


def _reached(homed: DataFrame) -> DataFrame:
    """``chrom, part`` of every megabase the intervals reach: bounded by the genome once distinct."""
    return homed.select("chrom", F.explode(F.sequence("part", "_last")).alias("part"), F.col("part").alias("_home"))


def _stale_homes(
    spark: SparkSession, store: str, base: str, intervals: DataFrame, interval_id: str, version: int, since: list[int]
) -> DataFrame:
    """Homes whose answers can have changed: an interval reaches a megabase written since, or is new, other or gone."""
    written = spark.read.schema("chrom string, part int, v int").parquet(f"{store}/parts").filter(F.col("v").isin(since))
    touched = written.select(*HOME).distinct()
    near = _reached(_homes(intervals)).join(F.broadcast(touched), HOME, "left_semi").select("chrom", F.col("_home").alias("part"))
    fields = [interval_id, "chrom", "start", "stop"]
    earlier = spark.read.schema(intervals.schema).parquet(f"{base}/intervals/v={version}").select(*fields)
    other = intervals.select(*fields).exceptAll(earlier).unionByName(earlier.exceptAll(intervals.select(*fields)))
    return near.unionByName(_homes(other).select(*HOME)).distinct()


def refresh_lookups(spark: SparkSession, store: str, intervals: DataFrame, interval_id: str, base: str, attempts: int = 10) -> int | None:
    """Brings the answers up to the document store; returns the new version, None where nothing had to be done.

    ``intervals`` has ``interval_id`` (unique), ``chrom, start, stop``. Answers of
    homes that no changed megabase reaches are neither computed nor written, and
    documents are read of the megabases that the others reach. A writer that
    another one overtook does its work again.
    """
    given = staged(
        intervals.select(interval_id, "chrom", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")),
        f"{base}/given/{uuid.uuid4().hex}",
    )
    for _ in range(attempts):
        done, documents = committed(spark, base), committed(spark, store)
        homed = _homes(given)
        if done:
            known = int(spark.read.text(f"{base}/upto/{done[-1]:012d}").first().value)
            stale = _stale_homes(spark, store, base, given, interval_id, done[-1], documents[known:])
        else:
            stale = homed.select(*HOME).distinct()
        version = next_claim(spark, f"{base}/versions")
        # One row per megabase of the genome at most.
        parts = staged(stale.coalesce(1), f"{base}/parts/v={version}")
        if done and parts.isEmpty() and known == len(documents):
            return None
        again = homed.join(F.broadcast(parts), HOME, "left_semi")
        docs = spark.createDataFrame([], VARIANT_DOCS)
        if documents:
            docs = stored_rows(spark, store).join(F.broadcast(_reached(again).select(*HOME).distinct()), HOME, "left_semi").drop("part")
        answers = variants_by_interval(docs, again.drop("part", "_last"), interval_id)
        answers = answers.drop("chrom").join(again.select(interval_id, *HOME), interval_id)
        ordered = balanced(answers, *HOME).sortWithinPartitions(*HOME, interval_id, "rank")
        replacing(ordered).partitionBy(*HOME).parquet(f"{base}/rows/v={version}")
        replacing(given).parquet(f"{base}/intervals/v={version}")
        create_once(spark, f"{base}/upto/{version:012d}", str(len(documents)))
        if create_once(spark, f"{base}/commits/{len(done):012d}", str(version)):
            return version
    raise RuntimeError(f"{base}: overtaken {attempts} times")


def read_lookups(spark: SparkSession, base: str, interval_id: str, homes: list[Row] | None = None) -> DataFrame:
    """Stored answers of the latest version, all or those of some homes: ``interval_id, rank`` and the response shape."""
    if not committed(spark, base):
        raise FileNotFoundError(base)
    none = spark.createDataFrame([], f"{interval_id} string, chrom string, start long, stop long")
    shape = variants_by_interval(spark.createDataFrame([], VARIANT_DOCS), none, interval_id)
    schema = shape.withColumns({"part": F.lit(0), "v": F.lit(0)}).schema
    rows = spark.read.schema(schema).parquet(f"{base}/rows")
    if homes is not None:
        rows = rows.filter(F.col("chrom").isin([h.chrom for h in homes]) & F.col("part").isin([h.part for h in homes]))
    return rows.join(F.broadcast(live_parts(spark, base)), ["v", *HOME], "left_semi").select(*shape.columns)


def read_lookup(spark: SparkSession, base: str, interval_id: str, value: str) -> DataFrame:
    """The stored answer of one gene or transcript, read from the folder of its home alone."""
    done = committed(spark, base)
    if not done:
        raise FileNotFoundError(base)
    listed = spark.read.parquet(f"{base}/intervals/v={done[-1]}").filter(F.col(interval_id) == value)
    homes = _homes(listed).select(*HOME).collect()
    return read_lookups(spark, base, interval_id, homes).filter(F.col(interval_id) == value).orderBy("rank")
