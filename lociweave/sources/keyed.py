"""Annotation tables stored by variant key, so that joins take them as they lie.

A table is bucketed and sorted by ``contig, pos, ref, alt`` with one row per key.
Tables of equally many buckets join each other, and variants exchanged once to
as many partitions, without an exchange of their own. Each write has a folder of
its own; a small file created once names it, which publishes the table whole
and lets another session open it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave import schemas
from lociweave.genome import rename_contig, valid_locus
from lociweave.operators.annotate import VARIANT_KEY, first_per_key
from lociweave.session import create_once, path_exists
from lociweave.sources.gzip_lines import RANGE_BYTES, File, gzip_lines, listed_files
from lociweave.sources.vcf import read_sites

#: Partitions of every join with the tables, some 60 MB each of a genome-wide score table.
BUCKETS = 1024
SPEC = "table.json"


def write_keyed(df: DataFrame, path: str, ddl: str, buckets: int = BUCKETS, also: list[str] | None = None) -> DataFrame:
    """``df`` as the table at ``path``: the smallest row of each key, which ``also`` can widen.

    Rows without a whole variant key match nothing and are left out. One
    exchange; equal keys then follow each other in their partition. Of two
    writers at once the first to end stays, and both read that one.
    """
    spark = df.sparkSession
    columns = spark.createDataFrame([], ddl).columns
    whole = df.select(*columns).dropna(subset=VARIANT_KEY).repartition(buckets, *VARIANT_KEY)
    unique = first_per_key(whole, [*VARIANT_KEY, *(also or [])]).select(*columns)
    name = f"keyed_{uuid.uuid4().hex}"
    writer = unique.write.format("parquet").bucketBy(buckets, *VARIANT_KEY).sortBy(*VARIANT_KEY)
    writer.option("path", f"{path}/{name}").saveAsTable(name)
    create_once(spark, f"{path}/{SPEC}", json.dumps({"name": name, "buckets": buckets, "schema": ddl}))
    return read_keyed(spark, path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, known to this session's catalog from then on."""
    spec = json.loads(spark.read.text(f"{path}/{SPEC}", wholetext=True).first().value)
    keys, folder = ", ".join(VARIANT_KEY), f"{path}/{spec['name']}".replace("'", "\\'")
    spark.sql(
        f"create table if not exists {spec['name']} ({spec['schema']}) using parquet "
        f"clustered by ({keys}) sorted by ({keys}) into {spec['buckets']} buckets location '{folder}'"
    )
    return spark.table(spec["name"])


def keyed_once(
    spark: SparkSession, path: str, build: Callable[[], DataFrame] | None, ddl: str,
    buckets: int = BUCKETS, also: list[str] | None = None,
) -> DataFrame:
    """The table at ``path``, written from ``build`` on first use."""
    if path_exists(spark, f"{path}/{SPEC}"):
        return read_keyed(spark, path)
    if build is None:
        raise FileNotFoundError(f"neither the table {path} nor a source of it exists")
    return write_keyed(build(), path, ddl, buckets, also)


def _placed(df: DataFrame) -> DataFrame:
    """Bare contig names, and loci of the genome only."""
    renamed = df.withColumn("contig", rename_contig(F.col("contig")))
    return renamed.filter(valid_locus(F.col("contig"), F.col("pos")))


def clinical_rows(sites: DataFrame) -> DataFrame:
    """Site lines with ``CLNSIG`` and ``CLNREVSTAT`` lists to one row per alternate allele.

    The two are whole texts in which commas belong to the value. A site
    without an alternate allele gives no row.
    """
    each = sites.select(
        "contig", "pos", F.get("alleles", F.lit(0)).alias("ref"), F.explode(F.slice("alleles", 2, F.size("alleles"))).alias("alt"),
        F.array_join("CLNSIG", ",").alias("clnsig"), F.array_join("CLNREVSTAT", ",").alias("clnrevstat"),
    )
    return _placed(each.filter(~F.col("alt").isin(".", "")))


def read_clinical(spark: SparkSession, vcf: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Clinical significance of a sites VCF."""
    return clinical_rows(read_sites(spark, vcf, ["CLNSIG", "CLNREVSTAT"], skip_invalid_loci=False, range_bytes=range_bytes))


def score_rows(lines: DataFrame, header: str) -> DataFrame:
    """Tab-separated score lines, with columns found by their names in ``header``.

    Lines that begin with ``#`` are comments; one without a position is left
    out, a score that is no number is null.
    """
    names = header.lstrip("#").split("\t")
    missing = {"Chrom", "Pos", "Ref", "Alt", "RawScore", "PHRED"} - set(names)
    if missing:
        raise ValueError(f"no column {', '.join(sorted(missing))} in a score file")
    fields = F.split("value", "\t")

    def field(name: str) -> Column:
        return F.get(fields, F.lit(names.index(name)))

    rows = lines.filter(~F.col("value").startswith("#") & (F.col("value") != "")).select(
        field("Chrom").alias("contig"), field("Pos").try_cast("int").alias("pos"),
        field("Ref").alias("ref"), field("Alt").alias("alt"),
        field("PHRED").try_cast("double").alias("cadd_phred"), field("RawScore").try_cast("double").alias("cadd_raw"),
    )
    return _placed(rows)


def read_scores(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One score file, read in byte ranges; its column line is looked up first, in its first range."""
    (found,) = listed_files(spark, path).select("path", "length").collect()
    lines = gzip_lines(spark, [File(found.path, found.length)], range_bytes=range_bytes).filter(F.col("value").isNotNull())
    header = lines.filter(F.col("value").startswith("#Chrom")).first()
    if header is None:
        raise ValueError(f"{path} has no line of column names")
    return score_rows(lines, header.value)


def consequence_rows(lines: DataFrame) -> DataFrame:
    """JSON records of the external annotator, one a line, keyed by the input line each carries.

    A line that is no record, or whose input names no locus and alleles, is left out.
    """
    told = lines.select(F.from_json("value", schemas.CONSEQUENCE).alias("vep"))
    given = F.split("vep.input", r"\s+")
    rows = told.select(
        F.get(given, F.lit(0)).alias("contig"), F.get(given, F.lit(1)).try_cast("int").alias("pos"),
        F.get(given, F.lit(3)).alias("ref"), F.get(given, F.lit(4)).alias("alt"), "vep",
    )
    return _placed(rows.dropna(subset=VARIANT_KEY))
