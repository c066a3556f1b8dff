"""Lookups over the document table.

Single lookups are filters whose ``chrom`` and ``pos`` parts reach the scan
(partition pruning, file statistics); batch lookups are joins.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lociweave.functions.variants import RSID, VARIANT_ID, looks_like_rsid
from lociweave.genome import DATASETS, dataset_catalog
from lociweave.operators.intervals import count_in_intervals, first_variants_in_intervals

# Result caps, response fields and the two refusals of an id lookup.
RESULT_LIMIT = 10000
MATCH_LIMIT = 5
MATCH_FIELDS = ["variant_id", "chrom", "pos", "ref", "alt"]
EXOME_TYPE = "struct<ac:bigint,an:bigint,af:double,homozygote_count:bigint,filters:array<string>>"
NOT_FOUND = "variant not found"
SEVERAL_FOUND = "multiple variants found, query using variant ID to select one"


#: Positions are 32-bit numbers.
LAST_POSITION = 2**31 - 1
ASCII_DIGITS = re.compile("[0-9]+")
#: Megabases, and how many of them a batch lookup names to the scan.
SPAN_BITS, MOST_SPANS = 20, 256


class VariantLookupError(ValueError):
    """A lookup that the caller can correct."""


# -- predicates ------------------------------------------------------------


def in_region(chrom: str, start: int, stop: int) -> Column:
    """Closed region predicate."""
    return (F.col("chrom") == chrom) & F.col("pos").between(start, stop)


def has_id(variant_id_or_rsid: str) -> Column:
    """Rsid membership for ``rs<digits>``, else id equality.

    A well-formed id also gives its chrom and position to the scan.
    """
    if RSID.fullmatch(variant_id_or_rsid):
        return F.array_contains("rsids", variant_id_or_rsid)
    same = F.col("variant_id") == variant_id_or_rsid
    parts = VARIANT_ID.fullmatch(variant_id_or_rsid)
    if parts and len(parts[2]) < 10:
        same = (F.col("chrom") == parts[1]) & (F.col("pos") == int(parts[2])) & same
    return same


def positions_with_prefix(digits: str) -> list[tuple[int, int]]:
    """Closed ranges of the positions whose decimal form begins with ``digits``: one for each further digit, ten at most."""
    if digits.startswith("0"):
        return [(0, 0)] if digits == "0" else []
    ranges = []
    low, high = int(digits), int(digits)
    while low <= LAST_POSITION:
        ranges.append((low, min(high, LAST_POSITION)))
        low, high = 10 * low, 10 * high + 9
    return ranges


def matches(query: str) -> Column:
    """Id prefix or exact rsid.

    What the prefix tells of contig and position goes to the scan beside it.
    """
    chrom, dash, rest = query.partition("-")
    prefix = F.col("variant_id").startswith(query)
    prefix = (F.col("chrom") == chrom if dash else F.col("chrom").startswith(query)) & prefix
    digits, ended, _ = rest.partition("-")
    if ASCII_DIGITS.fullmatch(digits):
        exact = [(int(digits), int(digits))] if int(digits) <= LAST_POSITION and str(int(digits)) == digits else []
        ranges = exact if ended else positions_with_prefix(digits)
        within = [F.col("pos").between(a, b) if a < b else F.col("pos") == a for a, b in ranges]
        prefix = (reduce(lambda x, y: x | y, within) if within else F.lit(False)) & prefix
    return prefix | F.array_contains("rsids", query) if RSID.fullmatch(query) else prefix


# -- rsid index -------------------------------------------------------------


def rsid_index(docs: DataFrame) -> DataFrame:
    """``rsid`` and the match fields of every document that carries it."""
    return docs.select(F.explode(F.array_distinct("rsids")).alias("rsid"), *MATCH_FIELDS)


def at_places(places: list[Row]) -> Column:
    """Documents of a few known places; contig, position and id all reach the scan."""
    each = [(F.col("chrom") == p.chrom) & (F.col("pos") == p.pos) & (F.col("variant_id") == p.variant_id) for p in places]
    return reduce(lambda a, b: a | b, each) if each else F.lit(False)


def near_places(places: DataFrame) -> Column | None:
    """A predicate for the scan that holds for all of some places (``chrom, pos``): their span in each megabase.

    None where there are more than ``MOST_SPANS`` megabases; a join then has to do.
    """
    spans = places.groupBy("chrom", F.shiftright("pos", SPAN_BITS)).agg(F.min("pos").alias("low"), F.max("pos").alias("high"))
    few = spans.select("chrom", "low", "high").limit(MOST_SPANS + 1).collect()
    if len(few) > MOST_SPANS:
        return None
    return reduce(lambda a, b: a | b, [in_region(r.chrom, r.low, r.high) for r in few]) if few else F.lit(False)


# -- response shapes -------------------------------------------------------


def _shape_columns(docs: DataFrame) -> list:

    def either(*names: str) -> Column:
        present = [F.col(n) for n in names if n in docs.columns]
        return F.coalesce(*present) if present else F.lit(None)

    no_strings = F.array().cast("array<string>")
    exome = F.struct(
        either("ac_total", "ac").cast("long").alias("ac"),
        either("an_total", "an").cast("long").alias("an"),
        either("af_total", "af").cast("double").alias("af"),
        either("hom_count", "n_hom").cast("long").alias("homozygote_count"),
        F.coalesce("filters", no_strings).alias("filters"),
    )
    return [
        *MATCH_FIELDS,
        F.coalesce("rsids", no_strings).alias("rsids"),
        exome.alias("exome"),
        F.lit(None).cast(EXOME_TYPE).alias("genome"),
    ]


def variant_shape(docs: DataFrame) -> DataFrame:
    """Nested response: counts under ``exome``, an empty ``genome``.

    Counts come from the annotated names first, then the older ones, so both
    document kinds answer.
    """
    return docs.select(*_shape_columns(docs))


def match_shape(docs: DataFrame) -> DataFrame:
    return docs.select(*MATCH_FIELDS)


# -- single lookups --------------------------------------------------------


def variants_in_region(
    docs: DataFrame, chrom: str, start: int, stop: int, limit: int = RESULT_LIMIT
) -> DataFrame:
    """First ``limit`` variants of a region, gene or transcript by position."""
    return variant_shape(docs.filter(in_region(chrom, start, stop)).orderBy("pos", "ref", "alt").limit(limit))


def count_variants_in_region(docs: DataFrame, chrom: str, start: int, stop: int) -> DataFrame:
    """One row, uncapped."""
    return docs.filter(in_region(chrom, start, stop)).agg(F.count("*").alias("n_variants"))


def matching_variants(docs: DataFrame, query: str, limit: int = MATCH_LIMIT, index: DataFrame | None = None) -> DataFrame:
    """Autocomplete: exact rsid hits first, then ids in order.

    With the ``index`` of :func:`rsid_index` an rsid is looked up there; the
    documents are then read for id prefixes only, which the contig prunes.
    """
    if index is not None and RSID.fullmatch(query):
        exact = index.filter(F.col("rsid") == query).select(F.lit(True).alias("exact"), *MATCH_FIELDS)
        prefix = docs.filter((F.col("chrom").startswith(query)) & F.col("variant_id").startswith(query))
        prefix = prefix.filter(~F.coalesce(F.array_contains("rsids", query), F.lit(False)))
        both = exact.unionByName(prefix.select(F.lit(False).alias("exact"), *MATCH_FIELDS))
        return both.orderBy(F.desc("exact"), "variant_id").limit(limit).drop("exact")
    exact = F.array_contains("rsids", query)
    return match_shape(
        docs.filter(matches(query)).orderBy(F.desc_nulls_last(exact), "variant_id").limit(limit)
    )


def fetch_variant(docs: DataFrame, variant_id_or_rsid: str, index: DataFrame | None = None) -> Row:
    """The one variant of an id; raises when there is none or more than one.

    With the ``index`` of :func:`rsid_index` an rsid is read there first, and its place from the documents.
    """
    wanted = has_id(variant_id_or_rsid)
    if index is not None and RSID.fullmatch(variant_id_or_rsid):
        places = index.filter(F.col("rsid") == variant_id_or_rsid).limit(2).collect()
        wanted = at_places(places)
    hits = variant_shape(docs.filter(wanted)).limit(2).collect()
    if not hits:
        raise VariantLookupError(NOT_FOUND)
    if len(hits) > 1:
        raise VariantLookupError(SEVERAL_FOUND)
    return hits[0]


# -- batch lookups ---------------------------------------------------------


def lookup_many(docs: DataFrame, queries: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``query, n_hits`` and the match fields when exactly one document answers.

    Ids and rsids are routed by shape, as in the single form. An id is joined by
    its parts too, and the megabases of not too many ids are named to the scan.
    With the ``index`` of :func:`rsid_index` rsids are answered from it alone; without,
    from the documents' own lists. Hits of a query are reduced to a count and
    one row map-side.
    """
    asked = queries.select("query").distinct()
    row = F.struct(*MATCH_FIELDS)
    parts = F.split("query", "-")
    ids = asked.filter(~looks_like_rsid(F.col("query"))).select(
        "query", F.get(parts, F.lit(0)).alias("chrom"), F.get(parts, F.lit(1)).try_cast("int").alias("pos")
    )
    # Ids that no document can have by their form are asked for as they are.
    formed = F.col("query").rlike("^[^-]+-(0|[1-9][0-9]{0,9})-[^-]+-[^-]+$") & F.col("pos").isNotNull()
    placed, odd = ids.filter(formed), ids.filter(~F.coalesce(formed, F.lit(False))).select("query")
    near = near_places(placed)
    within = docs if near is None else docs.filter(near)
    by_id = placed.join(
        within.select("chrom", "pos", F.col("variant_id").alias("query"), row.alias("hit")), ["chrom", "pos", "query"]
    ).select("query", "hit")
    if not odd.isEmpty():
        by_id = by_id.unionByName(odd.join(docs.select(F.col("variant_id").alias("query"), row.alias("hit")), "query"))
    listed = rsid_index(docs) if index is None else index
    by_rsid = asked.filter(looks_like_rsid(F.col("query"))).join(
        listed.select(F.col("rsid").alias("query"), row.alias("hit")), "query"
    )
    found = by_id.unionByName(by_rsid).groupBy("query").agg(
        F.count("*").alias("n_hits"), F.min("hit").alias("hit")
    )
    return asked.join(found, "query", "left").select(
        "query",
        F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
        *[F.when(F.col("n_hits") == 1, F.col(f"hit.{f}")).alias(f) for f in MATCH_FIELDS],
    )


def variants_by_interval(
    docs: DataFrame, intervals: DataFrame, interval_id: str, limit: int = RESULT_LIMIT
) -> DataFrame:
    """Batch form of the region lookup: ``interval_id, rank`` and the response shape.

    Written with :func:`lociweave.sources.documents.write_by_interval` it is
    the stored result per gene or transcript.
    """
    ids = intervals.select(interval_id, "chrom", "start", "stop")
    ranked = first_variants_in_intervals(docs, ids, interval_id, limit)
    return ranked.select(interval_id, "rank", *_shape_columns(ranked))


def count_variants_by_interval(docs: DataFrame, intervals: DataFrame, interval_id: str) -> DataFrame:
    """Uncapped count per interval, 0 for empty ones."""
    return count_in_intervals(docs, intervals, interval_id).select(interval_id, "n_variants")


# -- dataset check ---------------------------------------------------------


def genome_matches(arguments: DataFrame, spark: SparkSession) -> DataFrame:
    """Arguments (with ``dataset_id, reference_genome``) plus ``valid``.

    The catalog side is the fixed 16-row list, so it is broadcast.
    """
    genomes = dataset_catalog(spark).select("dataset_id", F.col("reference_genome").alias("dataset_genome"))
    return arguments.join(F.broadcast(genomes), "dataset_id", "left").withColumn(
        "valid", F.coalesce(F.col("reference_genome") == F.col("dataset_genome"), F.lit(False))
    )


def assert_genome(dataset_id: str, reference_genome: str) -> None:
    """Raise when a region, gene or transcript is on another build than the dataset."""
    genome = {d: g for d, _, g in DATASETS}.get(dataset_id)
    if genome != reference_genome:
        raise VariantLookupError(f"dataset {dataset_id} is on {genome}, the argument on {reference_genome}")
