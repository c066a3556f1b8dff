"""Gene-level frequency summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.operators.intervals import summed_in_intervals

IMPACTS = ["HIGH", "MODERATE", "LOW", "MODIFIER"]


def gene_summary(docs: DataFrame, genes: DataFrame) -> DataFrame:
    """Per gene: variants inside it, summed ac, highest af, homozygotes, variants per impact.

    By coordinates. What adds up is merged per aligned range of positions before
    it meets the genes, so there is no row per (gene, variant) and overlapping genes
    share their ranges. Genes without variants get zero counts and a null af.
    """
    counts = {
        "n_variants": F.lit(1), "ac": F.col("ac_total"), "n_hom": F.col("hom_count"),
        **{f"n_{i.lower()}": F.when(F.col("impact") == i, 1).otherwise(0) for i in IMPACTS},
    }
    summed = summed_in_intervals(
        docs, genes.select("gene_id", "chrom", "start", "stop"), "gene_id", counts, {"max_af": F.col("af_total")}
    )
    return genes.select("gene_id", "symbol").join(summed, "gene_id", "left").select(
        "gene_id", "symbol", "max_af", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts]
    )
