"""Cohort merge: many samples' records, and an earlier cohort, into one store.

The unified allele list of a locus is append-ordered: alleles an earlier
cohort version knew keep their indexes, new ones follow in sorted order. A
local-allele map once written therefore stays valid for good, and an
incremental run reads the earlier site list but neither reads nor rewrites
the earlier calls.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.functions.alleles import pad, without_non_ref
from lociweave.genome import on_cohort_contig, rename_contig
from lociweave.operators.blocks import carve_blocks

LOCUS = ["contig", "pos"]
#: Positions of one span, as a power of two: a megabase.
SPAN_BITS = 20


@dataclass
class Cohort:
    """The star schema: see ``schemas`` for the columns of each table."""

    sites: DataFrame
    calls: DataFrame
    ref_blocks: DataFrame
    samples: DataFrame


def filter_records(records: DataFrame) -> DataFrame:
    """Rename contigs and keep the cohort's (autosomes, X, Y) within their bounds."""
    return (
        records.withColumn("contig", rename_contig(F.col("raw_contig")))
        .drop("raw_contig")
        .filter(on_cohort_contig(F.col("contig"), F.col("pos")))
    )


def variant_records(records: DataFrame) -> DataFrame:
    """Records with a real alternate allele, ``alts`` without the placeholder."""
    return records.withColumn("alts", without_non_ref(F.col("alts"))).filter(F.size("alts") > 0)


def block_records(records: DataFrame) -> DataFrame:
    """Records whose only alternate is the placeholder, as reference blocks.

    A block without a called reference genotype says nothing and is left out.
    """
    return (
        records.filter(F.size(without_non_ref(F.col("alts"))) == 0)
        .filter(F.array_max("LGT.alleles") == 0)
        .select(
            "sample_id", "contig", "pos", F.coalesce(F.col("end_pos"), F.col("pos")).alias("end_pos"), "gq", "dp"
        )
    )


def one_record_per_locus(records: DataFrame) -> DataFrame:
    """One record per sample and locus: highest gq, ties by alleles, then by the rest of the record.

    Records are brought together by locus, as the allele lists and the joins after this
    need them, so nothing after this shuffles them again. Every column that a merge uses
    is part of the order, so its uses need the same shuffled rows and Spark can share some of them.
    """
    best = Window.partitionBy(*LOCUS).orderBy(
        "sample_id", F.desc_nulls_last("gq"), "ref", "alts", "LGT", "dp", "rsids"
    )
    again = (F.row_number().over(best) > 1) & F.lag("sample_id").over(best).eqNullSafe(F.col("sample_id"))
    return records.withColumn("_again", again).filter(~F.col("_again")).drop("_again")


def duplicate_loci(records: DataFrame) -> DataFrame:
    """How many records :func:`one_record_per_locus` leaves out, per sample."""
    return (
        records.groupBy("sample_id", *LOCUS).agg((F.count("*") - 1).alias("extra"))
        .groupBy("sample_id").agg(F.sum("extra").alias("n_dropped"))
        .filter("n_dropped > 0")
    )


def unify_alleles(records: DataFrame, previous_sites: DataFrame | None = None) -> DataFrame:
    """Per locus the allele list: longest reference, then each distinct alternate over it.

    Distinct record shapes are formed before anything is gathered, so a
    locus brings its allele strings to one row, not its samples. ``touched``
    marks the loci that ``records`` has a say in.
    """
    shapes = records.select(*LOCUS, "ref", F.explode("alts").alias("alt"), "rsids").groupBy(*LOCUS, "ref", "alt").agg(
        F.array_distinct(F.flatten(F.collect_set("rsids"))).alias("rsids")
    )
    no_strings = F.array().cast("array<string>")
    gathered = shapes.groupBy(*LOCUS).agg(
        F.max(_sized("ref")).alias("longest"),
        F.collect_list(F.struct("ref", "alt")).alias("shapes"),
        F.flatten(F.collect_list("rsids")).alias("rsids"),
    )
    if previous_sites is None:
        gathered = gathered.withColumns({"known_ref": F.lit(None).cast("string"), "known": no_strings, "known_rsids": no_strings})
    else:
        # One row per locus on either side. A join, not a union: Spark 4.1 takes a union of tables partitioned by locus as such and may fail on it.
        earlier = previous_sites.filter(F.size("alleles") > 1).select(
            *LOCUS, F.get("alleles", F.lit(0)).alias("known_ref"), F.expr("slice(alleles, 2, size(alleles) - 1)").alias("known"),
            F.col("rsids").alias("known_rsids"),
        )
        gathered = gathered.join(earlier, LOCUS, "full")
    merged = gathered.withColumn("ref", F.greatest("longest", F.when(F.col("known_ref").isNotNull(), _sized("known_ref")))["ref"])
    fresh = F.transform("shapes", lambda s: pad(s["alt"], s["ref"], F.col("ref")))
    listed = merged.withColumn(
        "_known", F.coalesce(F.transform("known", lambda alt: pad(alt, F.col("known_ref"), F.col("ref"))), no_strings)
    ).withColumn("_fresh", F.array_sort(F.array_except(F.coalesce(fresh, no_strings), F.col("_known"))))
    both = F.concat(F.coalesce("rsids", no_strings), F.coalesce("known_rsids", no_strings))
    return listed.select(
        *LOCUS, F.concat(F.array("ref"), "_known", "_fresh").alias("alleles"),
        F.array_sort(F.array_distinct(both)).alias("rsids"), F.col("shapes").isNotNull().alias("touched"),
    )


def _sized(ref: str) -> Column:
    """A reference by length, then text."""
    return F.struct(F.length(ref).alias("len"), F.col(ref).alias("ref"))


def local_alleles(ref: Column, alts: Column, alleles: Column) -> Column:
    """The map from a record's own alleles to the locus list; element 0 is 0."""
    longest = F.get(alleles, F.lit(0))
    alt_indexes = F.transform(
        alts, lambda a: (F.array_position(alleles, pad(a, ref, longest)) - 1).cast("int")
    )
    return F.concat(F.array(F.lit(0)), alt_indexes)


def calls_from_records(records: DataFrame, sites: DataFrame) -> DataFrame:
    """Variant records as calls over the unified alleles of their locus.

    A genotype that points at the dropped placeholder has no allele in the
    list and becomes a no-call. The join is on the locus, where records of
    :func:`one_record_per_locus` already lie: one row per sample at most, in one task.
    """
    named = F.array_max("LGT.alleles") <= F.size("alts")
    return records.join(sites.select(*LOCUS, "alleles"), LOCUS).select(
        *LOCUS, "sample_id", F.when(named, F.col("LGT")).alias("LGT"),
        local_alleles(F.col("ref"), F.col("alts"), F.col("alleles")).alias("LA"), "gq", "dp",
    )


def combine(records: DataFrame, previous: Cohort | None = None) -> Cohort:
    """Merge parsed records, and optionally an earlier cohort, into one cohort.

    New samples must not already be in ``previous``. The ``calls`` and
    ``ref_blocks`` of the result hold earlier entries unchanged;
    :func:`new_entries` gives the added ones alone.
    """
    kept = filter_records(records)
    variants = one_record_per_locus(variant_records(kept))
    # Here the whole list is asked for: one grouping gives the loci that records touch and the others.
    sites = unify_alleles(variants, previous.sites if previous else None).drop("touched")
    added = _entries(kept, variants, sites, records)
    if previous is None:
        return added
    return Cohort(
        sites=sites,
        calls=previous.calls.unionByName(added.calls),
        ref_blocks=previous.ref_blocks.unionByName(added.ref_blocks),
        samples=previous.samples.unionByName(added.samples, allowMissingColumns=True),
    )


def _entries(kept: DataFrame, variants: DataFrame, sites: DataFrame, samples: DataFrame) -> Cohort:
    """The entries of some records over a site list that has their loci."""
    return Cohort(
        sites=sites,
        calls=calls_from_records(variants, sites),
        ref_blocks=carve_blocks(block_records(kept), variants).drop("bin"),
        samples=samples.select("sample_id").distinct(),
    )


def sites_at(previous_sites: DataFrame, records: DataFrame) -> DataFrame:
    """Earlier sites at the loci of some records.

    Whole megabases are left out first, by a list that the genome's length bounds
    (some 3,100), so sites far from any record are neither shuffled nor compared.
    """
    near = F.shiftright("pos", SPAN_BITS).alias("span")
    spans = records.select("contig", near).distinct()
    sites = previous_sites.withColumn("span", near).join(F.broadcast(spans), ["contig", "span"], "left_semi").drop("span")
    return sites.join(records.select(*LOCUS).distinct(), LOCUS, "left_semi")


def new_entries(
    records: DataFrame,
    previous_sites: DataFrame | None = None,
    samples: DataFrame | None = None,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, _: df,
) -> Cohort:
    """What a merge adds: the allele lists of the loci it touches, and the entries of the new samples.

    ``samples`` lists the new samples where that is known, e.g. from file
    names; it also keeps those without any record. ``stage`` may write an
    intermediate table and return what it reads back: the variant records
    feed three outputs and the site list two.
    """
    kept = filter_records(records)
    variants = stage(one_record_per_locus(variant_records(kept)), "variants")
    earlier = None if previous_sites is None else sites_at(previous_sites, variants)
    sites = stage(unify_alleles(variants, earlier).drop("touched"), "sites")
    return _entries(kept, variants, sites, records if samples is None else samples)


def latest_sites(deltas: DataFrame, order: str) -> DataFrame:
    """One row per locus of several site lists: the one of the highest ``order``."""
    columns = [c for c in deltas.columns if c not in (*LOCUS, order)]
    last = deltas.groupBy(*LOCUS).agg(F.max_by(F.struct(*columns), F.col(order)).alias("last"))
    return last.select(*LOCUS, *[f"last.{c}" for c in columns])


def shared_samples(previous: DataFrame, added: DataFrame) -> DataFrame:
    """Samples present on both sides; a merge expects none."""
    return added.select("sample_id").join(previous.select("sample_id"), "sample_id", "left_semi").distinct()
