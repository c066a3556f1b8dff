"""Per-variant call statistics without building the dense grid.

Explicit calls are counted per (site, allele) with map-side combination;
what the reference blocks add at a site is a pure count of covering blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions.genotypes import global_allele, is_het, is_hom, is_non_ref
from lociweave.functions.hardy import het_freq_hwe, hwe_p_values
from lociweave.operators.blocks import (
    block_summary_at_sites,
    carve_blocks,
    clip_to_bins,
    coverage_at_sites,
)

KEY = ["contig", "pos"]
MEASURES = ["gq", "dp"]


def no_rows() -> Column:
    return F.lit(0).cast("long")


def _moment_sums(present: Column | None = None) -> list[Column]:
    """Count, sum, sum of squares, min and max of gq and dp; integers, so exact in any order."""
    out = []
    for name in MEASURES:
        value = F.col(name) if present is None else F.when(present, F.col(name))
        whole = value.cast("long")
        out += [
            F.count(value).alias(f"{name}_n"), F.sum(whole).alias(f"{name}_sum"),
            F.sum(whole * whole).alias(f"{name}_sq"),
            F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max"),
        ]
    return out


def _merged_moments() -> list[Column]:
    out = []
    for name in MEASURES:
        out += [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("n", "sum", "sq")]
        out += [F.min(f"{name}_min").alias(f"{name}_min"), F.max(f"{name}_max").alias(f"{name}_max")]
    return out


def allele_tallies(calls: DataFrame, moments: bool = False) -> DataFrame:
    """Counts per (site, global allele) over the explicit calls.

    A call is one row per allele here; whole-call counts are taken on the row
    of its first allele. No-calls keep one row with a null allele. Local
    calls carry the same homozygous / non-reference facts as global ones, so
    nothing but the allele index is mapped.
    """
    alleles = F.col("LGT.alleles")
    per_allele = calls.select(
        *KEY, "LA", *(MEASURES if moments else []), is_hom(alleles).alias("hom"), is_het(alleles).alias("het"),
        is_non_ref(alleles).alias("non_ref"), F.posexplode_outer(alleles).alias("nth", "local"),
    ).withColumn("allele", global_allele(F.col("LA"), F.col("local")))
    first = F.col("nth") == 0
    return per_allele.groupBy(*KEY, "allele").agg(
        F.count("allele").alias("n"),
        F.count_if(first & F.col("hom")).alias("n_hom"),
        F.count_if(first).alias("n_called"),
        F.count_if(first & F.col("het")).alias("n_het"),
        F.count_if(first & F.col("non_ref")).alias("n_non_ref"),
        *(_moment_sums(F.coalesce(first, F.lit(True))) if moments else []),
    )


def _explicit_totals(calls: DataFrame, moments: bool = False) -> DataFrame:
    """One row per site; the list it gathers has one element per allele."""
    counted = F.struct("allele", F.struct("n", "n_hom").alias("counts"))
    return allele_tallies(calls, moments).groupBy(*KEY).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("allele").isNotNull(), counted))).alias("by_allele"),
        F.sum("n").alias("an"),
        F.sum("n_called").alias("called"),
        F.sum("n_het").alias("het"),
        F.sum("n_non_ref").alias("non_ref"),
        *(_merged_moments() if moments else []),
    )


def _per_allele(alleles: Column, by_allele: Column, n_ref: Column, field: str, per_ref: int) -> Column:
    def one(_: Column, i: Column) -> Column:
        seen = F.coalesce(F.try_element_at(by_allele, i)[field], F.lit(0).cast("long"))
        return seen + F.when(i == 0, n_ref * per_ref).otherwise(F.lit(0).cast("long"))

    return F.transform(alleles, one)


def _counted(joined: DataFrame) -> DataFrame:
    """Explicit totals and ``n_ref`` to per-allele counts and ``_an``."""
    n_ref, by_allele = F.col("n_ref"), F.col("by_allele")
    return joined.withColumns({
        "_ac": _per_allele(F.col("alleles"), by_allele, n_ref, "n", 2),
        "_hom": _per_allele(F.col("alleles"), by_allele, n_ref, "n_hom", 1),
        "_an": F.coalesce(F.col("an"), no_rows()) + 2 * n_ref,
        "_called": F.coalesce(F.col("called"), no_rows()) + n_ref,
    })


def _call_fields() -> list[Column]:
    return [
        F.col("_ac").alias("AC"),
        F.transform("_ac", lambda ac: F.try_divide(ac, F.col("_an"))).alias("AF"),
        F.col("_an").alias("AN"),
        F.col("_hom").alias("homozygote_count"),
        F.col("_called").alias("n_called"),
        F.coalesce(F.col("het"), no_rows()).alias("n_het"),
        F.coalesce(F.col("non_ref"), no_rows()).alias("n_non_ref"),
    ]


def call_statistics(
    sites: DataFrame, calls: DataFrame, blocks: DataFrame, blocks_disjoint: bool = False
) -> DataFrame:
    """``sites`` plus ``variant_qc``: AC, AF, homozygote_count (per allele, 0 = reference), AN and call counts.

    ``calls`` holds one local call per (site, sample); blocks count as
    diploid reference calls. ``AN`` adds ploidy, so haploid calls add one.
    """
    pieces = clip_to_bins(blocks) if blocks_disjoint else carve_blocks(blocks, calls)
    joined = coverage_at_sites(sites, pieces).join(_explicit_totals(calls), KEY, "left")
    return _counted(joined).select(*sites.columns, F.struct(*_call_fields()).alias("variant_qc"))


def _moments(prefix: str) -> Column:
    n, total, squares = (F.col(f"{prefix}_{part}") for part in ("n", "sum", "sq"))
    # n * sum(x^2) - sum(x)^2 in decimal: exact, so never negative by rounding.
    spread = n.cast("decimal(38,0)") * squares - total.cast("decimal(38,0)") * total
    return F.struct(
        F.try_divide(total, n).alias("mean"),
        F.try_divide(F.sqrt(spread.cast("double")), n.cast("double")).alias("stdev"),
        F.col(f"{prefix}_min").alias("min"),
        F.col(f"{prefix}_max").alias("max"),
    )


def _with_blocks_added(joined: DataFrame) -> DataFrame:
    """Explicit moments and those of the covering blocks (prefix ``b_``) as one set."""

    def total(name: str) -> Column:
        return F.coalesce(F.col(name), no_rows()) + F.coalesce(F.col(f"b_{name}"), no_rows())

    merged = {}
    for name in MEASURES:
        merged |= {f"{name}_{part}": total(f"{name}_{part}") for part in ("n", "sum", "sq")}
        merged[f"{name}_min"] = F.least(f"{name}_min", f"b_{name}_min")
        merged[f"{name}_max"] = F.greatest(f"{name}_max", f"b_{name}_max")
    return joined.withColumns({**merged, "n_ref": F.coalesce(F.col("b_n_ref"), no_rows())})


def variant_quality(
    sites: DataFrame,
    calls: DataFrame,
    blocks: DataFrame,
    samples: DataFrame,
    blocks_disjoint: bool = False,
    exact_test: bool = True,
) -> DataFrame:
    """``sites`` plus the whole ``variant_qc``: :func:`call_statistics`, call rate, dp / gq moments, Hardy-Weinberg.

    One pass over the calls and one over the blocks. Moments run over all
    entries present: explicit ones (no-calls included, they carry dp and gq)
    and covering blocks. Without ``exact_test`` the p-values, whose work grows
    with the rare alleles of a site, are left out.
    """
    pieces = clip_to_bins(blocks) if blocks_disjoint else carve_blocks(blocks, calls)
    covered = block_summary_at_sites(sites, pieces)
    covered = covered.withColumnsRenamed({c: f"b_{c}" for c in covered.columns if c not in KEY})
    joined = sites.join(_explicit_totals(calls, moments=True), KEY, "left").join(covered, KEY, "left")
    counted = _counted(_with_blocks_added(joined)).withColumn("_samples", samples.select(F.count("*")).scalar())
    tested = with_hardy_weinberg(counted, F.col("_hom"), F.coalesce(F.col("het"), no_rows()), exact_test)
    qc = F.struct(
        *_call_fields(),
        (F.col("_samples") - F.col("_called")).alias("n_not_called"),
        F.try_divide(F.col("_called"), F.col("_samples")).alias("call_rate"),
        *[_moments(name).alias(f"{name}_stats") for name in ("dp", "gq")],
        "het_freq_hwe", *(["p_value_hwe", "p_value_excess_het"] if exact_test else []),
    )
    return tested.select(*sites.columns, qc.alias("variant_qc"))


def with_hardy_weinberg(df: DataFrame, homozygotes: Column, het: Column, exact_test: bool = True) -> DataFrame:
    """Adds genotype counts and Hardy-Weinberg fields.

    Two-allele sites only; others get nulls. The reference homozygotes
    include the covering blocks, as element 0 of ``homozygotes`` does.
    """
    two = F.size("alleles") == 2
    counted = df.withColumns({
        "n_hom_ref": F.when(two, F.get(homozygotes, F.lit(0))),
        "n_het": F.when(two, het),
        "n_hom_var": F.when(two, F.get(homozygotes, F.lit(1))),
    })
    triple = [F.col(c) for c in ("n_hom_ref", "n_het", "n_hom_var")]
    if not exact_test:
        return counted.withColumn("het_freq_hwe", het_freq_hwe(*triple))
    tested = counted.withColumns({"het_freq_hwe": het_freq_hwe(*triple), "_p": hwe_p_values(*triple)})
    return tested.select("*", "_p.p_value_hwe", "_p.p_value_excess_het").drop("_p")


def hardy_weinberg(stats: DataFrame, exact_test: bool = True) -> DataFrame:
    """The Hardy-Weinberg fields onto the output of :func:`call_statistics`."""
    return with_hardy_weinberg(
        stats, F.col("variant_qc.homozygote_count"), F.col("variant_qc.n_het"), exact_test
    )
