"""Variant identity expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

RSID = re.compile(r"rs\d+", re.ASCII)
VARIANT_ID = re.compile(r"([^-]+)-(\d+)-([^-]+)-([^-]+)", re.ASCII)


def variant_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """``chrom-pos-ref-alt``; null when a part is null."""
    dash = F.lit("-")
    return F.concat(chrom, dash, pos.cast("string"), dash, ref, dash, alt)


def looks_like_rsid(text: Column) -> Column:
    return text.rlike("^rs[0-9]+$")


def first_double(values: Column) -> Column:
    """Element 0 of a per-allele list as a double; null when absent or malformed."""
    return F.get(values, F.lit(0)).try_cast("double")


def double_or_null(value: Column) -> Column:
    return value.cast("double")


def normalized_set(values: Column) -> Column:
    """A set of strings as a sorted array; a missing set becomes the empty one."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.coalesce(values, empty)))
