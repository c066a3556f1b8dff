"""Nested consequence record to flat fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the flat fields, in order.
FLAT_FIELDS = [
    "Consequence", "IMPACT", "SYMBOL", "HGVSg", "HGVSc", "HGVSp", "transcript_id",
    "CADD_PHRED", "CADD_RAW", "ClinVar_CLNSIG", "ClinVar_CLNREVSTAT",
]


def _has_entries(values: Column) -> Column:
    return F.coalesce(F.size(values) > 0, F.lit(False))


def flatten_consequence(
    vep: Column,
    scores: tuple[Column, Column] | None = None,
    clinical: tuple[Column, Column] | None = None,
) -> Column:
    """The eleven flat fields of a consequence record.

    Transcript entry first, then the intergenic entry (consequence and impact
    only), else null. ``scores`` and ``clinical`` supply values joined from
    their own tables where the record carries none; scores stay bound to a
    transcript entry, as in the record itself.
    """
    has_tc = _has_entries(vep["transcript_consequences"])
    has_ic = _has_entries(vep["intergenic_consequences"])
    tc = F.get(vep["transcript_consequences"], F.lit(0))
    ic = F.get(vep["intergenic_consequences"], F.lit(0))
    clinvar = F.get(vep["custom_annotations"]["ClinVar"], F.lit(0))["fields"]

    def either(tc_value: Column, ic_value: Column) -> Column:
        return F.when(has_tc, tc_value).when(has_ic, ic_value)

    def transcript(value: Column, other: Column | None = None) -> Column:
        return F.when(has_tc, value if other is None else F.coalesce(value, other))

    def or_joined(value: Column, other: Column | None) -> Column:
        return value if other is None else F.coalesce(value, other)

    phred, raw = scores or (None, None)
    sig, rev = clinical or (None, None)
    return F.struct(
        either(
            F.array_join(tc["consequence_terms"], "&"), F.array_join(ic["consequence_terms"], "&")
        ).alias("Consequence"),
        either(tc["impact"], ic["impact"]).alias("IMPACT"),
        transcript(tc["gene_symbol"]).alias("SYMBOL"),
        transcript(tc["hgvsg"]).alias("HGVSg"),
        transcript(tc["hgvsc"]).alias("HGVSc"),
        transcript(tc["hgvsp"]).alias("HGVSp"),
        transcript(tc["transcript_id"]).alias("transcript_id"),
        transcript(tc["cadd_phred"], phred).alias("CADD_PHRED"),
        transcript(tc["cadd_raw_rankscore"], raw).alias("CADD_RAW"),
        or_joined(clinvar["CLNSIG"], sig).alias("ClinVar_CLNSIG"),
        or_joined(clinvar["CLNREVSTAT"], rev).alias("ClinVar_CLNREVSTAT"),
    )
