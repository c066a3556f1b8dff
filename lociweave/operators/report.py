"""Sanity report over annotated variants: one pass, one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.genome import contig_index

FILLED = {
    "consequence": "vep.Consequence",
    "symbol": "vep.SYMBOL",
    "cadd": "vep.CADD_PHRED",
    "gnomad_af": "gnomad_af",
    "gnomad_nonfin": "gnomad_nonfin",
}


def _index1(field: str) -> Column:
    return F.get(f"variant_qc.{field}", F.lit(1))


def frequency_aggregates() -> list[Column]:
    return [
        F.count(_index1("AC")).alias("has_ac"),
        F.avg(_index1("AF")).alias("mean_af"),
        F.sum(_index1("homozygote_count")).alias("n_hom"),
    ]


def fill_aggregates() -> list[Column]:
    counts = [F.count(F.col(c)).alias(f"has_{name}") for name, c in FILLED.items()]
    percents = [
        F.try_divide(100 * F.count(F.col(c)), F.count("*")).alias(f"pct_{name}") for name, c in FILLED.items()
    ]
    return [F.count("*").alias("n_variants"), *counts, *percents]


def clinical_aggregates() -> list[Column]:
    """Significance counts; the plain text match also takes in conflicting records.

    ``has_pathogenic_strict`` leaves those out.
    """
    sig = F.lower(F.col("vep.ClinVar_CLNSIG"))
    pathogenic = sig.contains("pathogenic")
    return [
        F.count(sig).alias("has_clnsig"),
        F.count_if(pathogenic).alias("has_pathogenic"),
        F.count_if(pathogenic & ~sig.contains("conflicting")).alias("has_pathogenic_strict"),
    ]


def frequency_report(variants: DataFrame) -> DataFrame:
    return variants.agg(*frequency_aggregates())


def fill_report(variants: DataFrame) -> DataFrame:
    return variants.agg(*fill_aggregates())


def clinical_report(variants: DataFrame) -> DataFrame:
    return variants.agg(*clinical_aggregates())


def full_report(variants: DataFrame) -> DataFrame:
    """All three in a single scan."""
    return variants.agg(*fill_aggregates(), *frequency_aggregates(), *clinical_aggregates())


def dimensions(variants: DataFrame, samples: DataFrame) -> DataFrame:
    """``n_variants, n_samples`` of written tables, one row."""
    return variants.agg(F.count("*").alias("n_variants")).withColumn(
        "n_samples", samples.select(F.count("*")).scalar()
    )


def preview(variants: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` variants in genome order, four columns and the locus."""
    return (
        variants.orderBy(contig_index(F.col("contig")), "pos", "alleles").limit(n)
        .select("contig", "pos", "alleles", "variant_qc", "gnomad_af", "gnomad_nonfin", "vep")
    )
