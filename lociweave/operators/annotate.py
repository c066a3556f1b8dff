"""Keyed annotation joins onto variants.

All four joins share the equality key (contig, pos, ref, alt), so variants
are exchanged once for the chain; each right side is reduced to one row per
key first, so no join can add rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions.alleles import first_alt
from lociweave.functions.consequences import flatten_consequence
from lociweave.functions.variants import first_double

VARIANT_KEY = ["contig", "pos", "ref", "alt"]


def first_per_key(table: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest under ``order`` (default: the other columns in order).

    A minimum over the row combines map-side, so a key with many copies does
    not gather anywhere.
    """
    rest = [c for c in table.columns if c not in keys]
    if not rest:
        return table.distinct()
    lead = {c: f"_o{i}" for i, c in enumerate(order or [])}
    # A column of the order is carried once: these rows are what a task sorts.
    ranked = F.struct(*[F.col(c).alias(name) for c, name in lead.items()], *[c for c in rest if c not in lead])
    best = table.groupBy(*keys).agg(F.min(ranked).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{lead.get(c, c)}").alias(c) for c in rest])


def unique_rows(table: DataFrame, keys: list[str], unique: bool) -> DataFrame:
    """``table`` as it is when an import already left one row per key, else reduced to that."""
    return table if unique else first_per_key(table, keys)


def with_variant_key(sites: DataFrame) -> DataFrame:
    """Adds ``ref`` and ``alt`` (index 0 and 1 of the allele list)."""
    return sites.withColumn("ref", F.get("alleles", F.lit(0))).withColumn("alt", first_alt(F.col("alleles")))


def frequency_table(sites_file: DataFrame) -> DataFrame:
    """Sites file to the two kept frequencies, keyed by locus and whole allele list.

    Per-allele lists keep element 0 only.
    """
    return sites_file.select(
        "contig", "pos", "alleles",
        first_double(F.col("af")).alias("af"), first_double(F.col("af_nfe")).alias("af_nfe"),
    )


def join_frequency(variants: DataFrame, frequency: DataFrame, unique: bool = False) -> DataFrame:
    """Left join on locus and the whole allele list; adds ``gnomad_af``, ``gnomad_nonfin``.

    The allele list is a residual condition beside the shared key: a site
    with more alleles than the frequency row misses. It is written as two
    bounds, since an equality would become a fifth key and exchange the
    variants again. A frequency table stored by variant key keeps its own ``ref, alt``.
    """
    right = unique_rows(frequency, ["contig", "pos", "alleles"], unique)
    right = right if {"ref", "alt"} <= set(right.columns) else with_variant_key(right)
    right = right.select(
        *VARIANT_KEY, F.col("alleles").alias("_alleles"),
        F.col("af").alias("gnomad_af"), F.col("af_nfe").alias("gnomad_nonfin"),
    ).alias("r")
    left = variants.alias("l")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in VARIANT_KEY]
    alike = [F.col("l.alleles") >= F.col("r._alleles"), F.col("l.alleles") <= F.col("r._alleles")]
    joined = left.join(right, same + alike, "left")
    return joined.select("l.*", "r.gnomad_af", "r.gnomad_nonfin")


def join_clinical(variants: DataFrame, clinical: DataFrame, unique: bool = False) -> DataFrame:
    """Left join of clinical significance on the exact alleles; adds ``clnsig``, ``clnrevstat``."""
    right = unique_rows(clinical.select(*VARIANT_KEY, "clnsig", "clnrevstat"), VARIANT_KEY, unique)
    return variants.join(right, VARIANT_KEY, "left")


def score_table(snvs: DataFrame, indels: DataFrame) -> DataFrame:
    """Both deleteriousness score files as one table."""
    return snvs.unionByName(indels)


def join_scores(variants: DataFrame, scores: DataFrame, unique: bool = False) -> DataFrame:
    """Left join of deleteriousness scores; adds ``cadd_phred``, ``cadd_raw``."""
    right = unique_rows(scores.select(*VARIANT_KEY, "cadd_phred", "cadd_raw"), VARIANT_KEY, unique)
    return variants.join(right, VARIANT_KEY, "left")


def join_consequence(variants: DataFrame, consequences: DataFrame, unique: bool = False) -> DataFrame:
    """Left join of one consequence record per variant; adds the nested ``vep``."""
    right = unique_rows(consequences.select(*VARIANT_KEY, "vep"), VARIANT_KEY, unique)
    return variants.join(right, VARIANT_KEY, "left")


def flat_vep(vep: Column) -> Column:
    """The flat record, with joined scores and significance where the record has none."""
    return flatten_consequence(
        vep,
        scores=(F.col("cadd_phred"), F.col("cadd_raw")),
        clinical=(F.col("clnsig"), F.col("clnrevstat")),
    )


def annotate_variants(
    variants: DataFrame,
    consequences: DataFrame,
    clinical: DataFrame,
    scores: DataFrame,
    frequency: DataFrame,
    unique: bool = False,
) -> DataFrame:
    """``variants`` (sites with statistics) plus flat ``vep``, ``gnomad_af``, ``gnomad_nonfin``.

    ``unique`` says that the four tables hold one row per key, as
    :func:`lociweave.sources.keyed.write_keyed` leaves them.
    """
    joined = join_consequence(with_variant_key(variants), consequences, unique)
    joined = join_clinical(joined, clinical, unique)
    joined = join_scores(joined, scores, unique)
    joined = join_frequency(joined, frequency, unique)
    return joined.withColumn("vep", flat_vep(F.col("vep"))).select(
        *variants.columns, "vep", "gnomad_af", "gnomad_nonfin"
    )
