"""Genotype expressions over ``struct<alleles:array<int>, phased:boolean>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_to_global(lgt: Column, la: Column) -> Column:
    """Local call to global call through the local-allele map.

    A no-call stays null. Without a map only the reference call is known, so
    0/0 stays 0/0 and any other call is null.
    """
    alleles = lgt["alleles"]
    mapped = F.when(la.isNotNull(), F.transform(alleles, lambda i: F.get(la, i))).when(
        F.array_max(alleles) == 0, alleles
    )
    known = mapped.isNotNull() & ~F.exists(mapped, lambda a: a.isNull())
    return F.when(known, F.struct(mapped.alias("alleles"), lgt["phased"].alias("phased")))


def global_allele(la: Column, local: Column) -> Column:
    """One local allele index to its global index; no map means reference only."""
    return F.when(la.isNull(), F.when(local == 0, local)).otherwise(F.get(la, local))


def is_hom(alleles: Column) -> Column:
    """All alleles equal, at least two of them (haploid calls are not homozygous)."""
    return (F.size(alleles) > 1) & (F.array_min(alleles) == F.array_max(alleles))


def is_het(alleles: Column) -> Column:
    """Two different alleles in one call."""
    return F.array_min(alleles) != F.array_max(alleles)


def is_non_ref(alleles: Column) -> Column:
    """At least one alternate allele; index 0 is the reference locally and globally."""
    return F.array_max(alleles) > 0


def call_text(call: Column) -> Column:
    """``0/1`` or ``0|1``; null for a no-call."""
    alleles = call["alleles"].cast("array<string>")
    return F.when(call["phased"], F.array_join(alleles, "|")).otherwise(F.array_join(alleles, "/"))


def parse_call(text: Column) -> Column:
    """Genotype text to a call; any missing allele makes it a no-call."""
    parts = F.transform(F.split(text, "[/|]"), lambda a: a.try_cast("int"))
    known = text.isNotNull() & ~F.exists(parts, lambda a: a.isNull())
    return F.when(known, F.struct(parts.alias("alleles"), text.contains("|").alias("phased")))
