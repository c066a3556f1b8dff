"""Allele-string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_REF = "<NON_REF>"


def is_symbolic(allele: Column) -> Column:
    """Alleles without bases of their own: ``<DEL>``, ``*``, breakends."""
    return allele.startswith("<") | (allele == "*") | allele.contains("[") | allele.contains("]")


def pad(allele: Column, ref: Column, longest_ref: Column) -> Column:
    """Express an allele of ``ref`` over the longer reference of its locus."""
    tail = F.substring(longest_ref, F.length(ref) + 1, F.length(longest_ref))
    return F.when(is_symbolic(allele), allele).otherwise(F.concat(allele, tail))


def without_non_ref(alts: Column) -> Column:
    """Alternate alleles without the gVCF placeholder and the missing mark."""
    return F.array_except(alts, F.array(F.lit(NON_REF), F.lit(".")))


def first_alt(alleles: Column) -> Column:
    """Index-1 allele, null for a one-allele row."""
    return F.get(alleles, F.lit(1))
