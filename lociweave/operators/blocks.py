"""Reference blocks: runs of positions where one sample matches the reference.

Blocks outnumber variant calls by far, so every operator here keeps to one
shuffle of at most one row per block piece and groups that are bounded by
the positions of a bin, never by the number of samples or the length of a
chromosome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators.intervals import dyadic_ancestors, dyadic_nodes, shuffled

# Bins of 2^16 positions: a piece of a block never crosses a bin border.
BIN_BITS = 16


def position_bin(pos: str):
    return F.shiftright(pos, BIN_BITS)


def clip_to_bins(blocks: DataFrame) -> DataFrame:
    """Cut blocks at bin borders; adds ``bin``."""
    first, last = position_bin("pos"), position_bin("end_pos")
    low = F.shiftleft("bin", BIN_BITS)
    return (
        blocks.filter(F.col("pos") <= F.col("end_pos"))
        .withColumn("bin", F.explode(F.sequence(first, last)))
        .withColumn("pos", F.greatest(F.col("pos"), low))
        .withColumn("end_pos", F.least(F.col("end_pos"), low + ((1 << BIN_BITS) - 1)))
    )


def carve_blocks(blocks: DataFrame, calls: DataFrame) -> DataFrame:
    """Take out of each sample's blocks the positions where it has an explicit entry.

    An explicit entry hides the block under it even when it is a no-call.
    Blocks that overlap one another come out disjoint. One ordered pass per
    (sample, contig, bin): a block opens a piece, an entry closes it and
    opens the next one behind itself. Done once when a sample enters the
    cohort, so statistics need no sample-level join afterwards.
    """
    opened = clip_to_bins(blocks).select(
        "sample_id", "contig", "bin", "pos", F.lit(0).alias("kind"),
        F.struct("end_pos", "gq", "dp").alias("block"),
    )
    entries = calls.select(
        "sample_id", "contig", position_bin("pos").alias("bin"), "pos", F.lit(1).alias("kind"),
        F.lit(None).cast("struct<end_pos:int,gq:int,dp:int>").alias("block"),
    )
    order = Window.partitionBy("sample_id", "contig", "bin").orderBy("pos", "kind")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        opened.unionByName(entries)
        .withColumn("open", F.max("block").over(so_far))
        .withColumn("next_pos", F.lead("pos").over(order))
        .filter(F.col("open").isNotNull())
        .select(
            "sample_id", "contig", "bin",
            (F.col("pos") + F.col("kind")).alias("pos"),
            F.least(F.col("open.end_pos"), F.col("next_pos") - 1).alias("end_pos"),
            F.col("open.gq").alias("gq"), F.col("open.dp").alias("dp"),
        )
        .filter(F.col("pos") <= F.col("end_pos"))
    )


def coverage_at_sites(sites: DataFrame, pieces: DataFrame) -> DataFrame:
    """``sites`` with ``n_ref``, the number of pieces over each site.

    Piece borders are added up per position first, which bounds the sweep by
    the positions of a bin whatever the number of samples.
    """
    borders = (
        pieces.select(
            "contig", "bin",
            F.explode(
                F.array(
                    F.struct(F.col("pos").alias("pos"), F.lit(1).alias("step")),
                    F.struct((F.col("end_pos") + 1).alias("pos"), F.lit(-1).alias("step")),
                )
            ).alias("border"),
        )
        .groupBy("contig", "bin", F.col("border.pos").alias("pos"))
        .agg(F.sum("border.step").alias("step"))
        .filter(F.col("step") != 0)
    )
    marked = sites.withColumn("bin", position_bin("pos")).withColumn("is_site", F.lit(True))
    order = (
        Window.partitionBy("contig", "bin").orderBy("pos", "is_site")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        borders.withColumn("is_site", F.lit(False))
        .unionByName(marked, allowMissingColumns=True)
        .withColumn("n_ref", F.coalesce(F.sum("step").over(order), F.lit(0)))
        .filter("is_site")
        .select(*sites.columns, "n_ref")
    )


def block_summary_at_sites(sites: DataFrame, pieces: DataFrame) -> DataFrame:
    """Count, and sum / sum of squares / min / max of gq and dp, of the pieces over each site.

    Minimum and maximum cannot be swept, so pieces are summed up per aligned
    power-of-two range and each site reads the ranges above it. Integers
    only, hence exact in any order.
    """
    totals = [F.count("*").alias("n_ref")]
    merged = [F.sum("n_ref").alias("n_ref")]
    for name in ("gq", "dp"):
        value = F.col(name).cast("long")
        totals += [
            F.count(name).alias(f"{name}_n"), F.sum(value).alias(f"{name}_sum"),
            F.sum(value * value).alias(f"{name}_sq"),
            F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max"),
        ]
        merged += [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("n", "sum", "sq")]
        merged += [F.min(f"{name}_min").alias(f"{name}_min"), F.max(f"{name}_max").alias(f"{name}_max")]
    per_node = (
        dyadic_nodes(pieces.select("contig", "pos", "end_pos", "gq", "dp"), "pos", "end_pos")
        .groupBy("contig", "level", "node").agg(*totals)
    )
    probes = dyadic_ancestors(sites.select("contig", "pos"), "pos", BIN_BITS)
    return shuffled(probes).join(per_node, ["contig", "level", "node"]).groupBy("contig", "pos").agg(*merged)


def reference_entries_at_sites(sites: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row per (site, sample) that a piece covers: ``contig, pos, sample_id, gq, dp``.

    An equality join on aligned ranges whose matches are exactly the result
    rows; a hot range is split by the adaptive skew join.
    """
    nodes = dyadic_nodes(
        pieces.select("sample_id", "contig", "pos", "end_pos", "gq", "dp"), "pos", "end_pos"
    )
    probes = dyadic_ancestors(sites.select("contig", "pos"), "pos", BIN_BITS)
    return nodes.join(shuffled(probes), ["contig", "level", "node"]).select("contig", "pos", "sample_id", "gq", "dp")
