"""What several operators share: staging on shared storage, folds, row keys, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.session import staged

#: Rows that a Python worker gets at once.
BATCH_ROWS = 1000
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``, or one of our own where it is unset."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None) or spark.conf.get("lociweave.stage.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("lociweave.stage.dir", base)
    return base


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written once under a name of its own on shared storage and read back.

    Later uses start from the files, so lost executors cost no recomputation
    of what came before. Files stay until the folder is cleaned.
    """
    return staged(df, f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)).cast("int")


def small_batches(spark: SparkSession) -> None:
    """Python workers get a thousand rows at a time, so that whole texts of long documents fit their memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def sheltered(docs: DataFrame) -> DataFrame:
    """All columns inside one struct ``row``, so that no name clashes with a working column."""
    small_batches(docs.sparkSession)
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def text_key(text: Column) -> Column:
    """64-bit key that tells apart the texts of rows with one id."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def rest_key(docs: DataFrame) -> Column:
    """64-bit key of all columns of ``row`` but the text, whatever their types; tells apart rows of one id and text."""
    return F.xxhash64(F.to_json(F.struct(F.lit(0).alias("_"), *[F.col("row")[c].alias(c) for c in docs.columns if c != "text"])))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step on edges ``u > v``: what hangs together hangs on a smaller node afterwards."""
    seen = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
    low = stage(seen.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), "low")
    moved = seen.join(low, "u").filter(F.col("v") > F.col("u") if large else F.col("v") != F.col("low"))
    moved = moved.select(F.col("v").alias("u"), F.col("low").alias("v"))
    if not large:
        moved = moved.union(low.select("u", F.col("low").alias("v")))
    return moved.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of an edge list ``a, b`` by alternating star steps.

    The component is its smallest node. Nulls and loops are left out; a node
    without an edge has no row. Nodes, edges and components stay distributed;
    each step is a written table, and its hub nodes are split by the adaptive
    join since both sides are shuffled for it.
    """
    pairs = stage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(pairs)
    while before[0]:
        pairs = stage(_star(stage(_star(pairs, True), "large"), False), "small")
        after = state(pairs)
        if after == before:
            break
        before = after
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(pairs.select("v", "v").distinct())
