"""gVCF and sites-VCF text, batch and stream, parsed with column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.functions.genotypes import parse_call
from lociweave.genome import valid_locus
from lociweave.sources.gzip_lines import RANGE_BYTES, File, gzip_lines, listed_files

GVCF_SUFFIX = ".gvcf.gz"
GVCF_GLOB = f"*{GVCF_SUFFIX}"


def gvcf_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the ``*.gvcf.gz`` files of a folder: ``value, gvcf``."""
    files = [File(r.path, r.length) for r in listed_files(spark, path, GVCF_GLOB).select("path", "length").collect()]
    return named_lines(gzip_lines(spark, files)).filter(F.col("value").isNotNull()).select("value", "gvcf")


def named_lines(lines: DataFrame) -> DataFrame:
    """Lines with the name of their file as ``gvcf``."""
    return lines.withColumn("gvcf", F.element_at(F.split("path", "/"), -1))


def sample_of(gvcf: Column) -> Column:
    """Sample id of a file name."""
    return F.regexp_replace(gvcf, r"\.gvcf\.gz$", "")


def _info(info: Column, key: str) -> Column:
    """Value of one INFO key, null when absent."""
    found = F.regexp_extract(info, f"(?:^|;){key}=([^;]*)", 1)
    return F.nullif(found, F.lit(""))


def _format_value(keys: Column, values: Column, key: str) -> Column:
    """A sample field by its FORMAT key; trailing fields may be left out."""
    return F.get(values, (F.array_position(keys, key) - 1).cast("int"))


def parse_gvcf(lines: DataFrame) -> DataFrame:
    """Lines to records (see ``schemas.RECORDS``) plus ``gvcf``, ``is_header``, ``malformed``.

    Closing rows of a read, if ``lines`` has them, stay as rows marked ``is_end``
    with their ``seconds`` and ``error``. A data line with fewer than ten columns or without a position is
    malformed. The column header line of a file is kept as one row marked
    ``is_header``, so that a file without records still shows.
    """
    f = F.col("_fields")
    keys, values = F.split(F.get(f, F.lit(8)), ":"), F.split(F.get(f, F.lit(9)), ":")
    ids = F.get(f, F.lit(2))
    pos = F.get(f, F.lit(1)).try_cast("int")
    header = F.coalesce(F.col("value").startswith("#CHROM"), F.lit(False))
    wanted, closing, ended = (~F.col("value").startswith("#") & (F.col("value") != "")) | header, [], F.lit(False)
    if "seconds" in lines.columns:
        ended = F.col("value").isNull()
        wanted, closing = wanted | ended, [ended.alias("is_end"), "seconds", "error"]
    # A generated column is split once a line; as a plain one it would be split anew in every filter on the records.
    data = lines.filter(wanted).select("*", F.explode(F.array(F.split("value", "\t"))).alias("_fields"))
    return data.select(
        "gvcf",
        header.alias("is_header"),
        sample_of(F.col("gvcf")).alias("sample_id"),
        F.get(f, F.lit(0)).alias("raw_contig"),
        pos.alias("pos"),
        _info(F.get(f, F.lit(7)), "END").try_cast("int").alias("end_pos"),
        F.when(ids != ".", F.split(ids, ";")).alias("rsids"),
        F.get(f, F.lit(3)).alias("ref"),
        F.split(F.get(f, F.lit(4)), ",").alias("alts"),
        parse_call(_format_value(keys, values, "GT")).alias("LGT"),
        _format_value(keys, values, "GQ").try_cast("int").alias("gq"),
        _format_value(keys, values, "DP").try_cast("int").alias("dp"),
        (~header & ~ended & (pos.isNull() | (F.size(f) < 10))).alias("malformed"),
        *closing,
    )


def read_gvcf(spark: SparkSession, path: str) -> DataFrame:
    """Records of all gVCF files of a folder. Malformed lines are left to the ingest status log."""
    return good_records(parse_gvcf(gvcf_lines(spark, path)))


def good_records(parsed: DataFrame) -> DataFrame:
    """Parsed rows that are well-formed data lines, without the file bookkeeping."""
    rows = parsed.filter(~F.col("is_header") & ~F.col("malformed"))
    if "is_end" in parsed.columns:
        rows = rows.filter(~F.col("is_end"))
    return rows.drop("gvcf", "is_header", "malformed", "is_end", "seconds", "error")


def parse_sites(lines: DataFrame, info_fields: list[str], skip_invalid_loci: bool = True) -> DataFrame:
    """Site lines to ``contig, pos, alleles, rsids, filters`` and one list of texts per INFO field.

    ``filters`` is empty for a site that passed and null where none was applied.
    ``skip_invalid_loci`` leaves out unknown contigs and positions off their end.
    """
    f = F.split("value", "\t")
    ids, told = F.get(f, F.lit(2)), F.get(f, F.lit(6))
    sites = lines.filter(~F.col("value").startswith("#") & (F.col("value") != "")).select(
        F.get(f, F.lit(0)).alias("contig"),
        F.get(f, F.lit(1)).try_cast("int").alias("pos"),
        F.concat(F.array(F.get(f, F.lit(3))), F.split(F.get(f, F.lit(4)), ",")).alias("alleles"),
        F.when(ids != ".", F.split(ids, ";")).alias("rsids"),
        F.when(told == "PASS", F.array().cast("array<string>")).when(told != ".", F.array_sort(F.array_distinct(F.split(told, ";"))))
        .alias("filters"),
        *[F.split(_info(F.get(f, F.lit(7)), name), ",").alias(name) for name in info_fields],
    )
    return sites.filter(valid_locus(F.col("contig"), F.col("pos"))) if skip_invalid_loci else sites


def read_sites(
    spark: SparkSession, path: str, info_fields: list[str], skip_invalid_loci: bool = True, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Row part of a sites VCF, a file or a folder of them.

    A block-gzipped file is read in ranges of ``range_bytes``, each a task; a
    plain gzip file in one. A file that cannot be decoded raises.
    """
    files = [File(r.path, r.length) for r in listed_files(spark, path).select("path", "length").collect()]
    return parse_sites(gzip_lines(spark, files, range_bytes=range_bytes), info_fields, skip_invalid_loci)
