"""Contig names and lengths, and the dataset catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public GRCh37 contig lengths, in chromosome order.
CONTIG_LENGTHS = {
    "1": 249250621,
    "2": 243199373,
    "3": 198022430,
    "4": 191154276,
    "5": 180915260,
    "6": 171115067,
    "7": 159138663,
    "8": 146364022,
    "9": 141213431,
    "10": 135534747,
    "11": 135006516,
    "12": 133851895,
    "13": 115169878,
    "14": 107349540,
    "15": 102531392,
    "16": 90354753,
    "17": 81195210,
    "18": 78077248,
    "19": 59128983,
    "20": 63025520,
    "21": 48129895,
    "22": 51304566,
    "X": 155270560,
    "Y": 59373566,
    "MT": 16569,
}

# Contigs that enter the cohort; MT is renamed first and dropped after.
COHORT_CONTIGS = [name for name in CONTIG_LENGTHS if name != "MT"]

# Dataset id, label, genome build.
DATASETS = [
    ("cohort", "Cohort", "GRCh37"),
    ("gnomad_r4", "gnomAD v4", "GRCh38"),
    ("gnomad_r4_non_ukb", "gnomAD v4 (non-UK Biobank)", "GRCh38"),
    ("gnomad_cnv_r4", "gnomAD v4 cnv", "GRCh38"),
    ("gnomad_r3", "gnomAD v3", "GRCh38"),
    ("gnomad_r3_controls_and_biobanks", "gnomAD v3 (controls and biobanks)", "GRCh38"),
    ("gnomad_r3_non_cancer", "gnomAD v3 (non-cancer)", "GRCh38"),
    ("gnomad_r3_non_neuro", "gnomAD v3 (non-neuro)", "GRCh38"),
    ("gnomad_r3_non_topmed", "gnomAD v3 (non-TOPMed)", "GRCh38"),
    ("gnomad_r3_non_v2", "gnomAD v3 (non-v2)", "GRCh38"),
    ("gnomad_r2_1", "gnomAD v2", "GRCh37"),
    ("gnomad_r2_1_controls", "gnomAD v2 (controls)", "GRCh37"),
    ("gnomad_r2_1_non_neuro", "gnomAD v2 (non-neuro)", "GRCh37"),
    ("gnomad_r2_1_non_cancer", "gnomAD v2 (non-cancer)", "GRCh37"),
    ("gnomad_r2_1_non_topmed", "gnomAD v2 (non-TOPMed)", "GRCh37"),
    ("exac", "ExAC", "GRCh37"),
]


def dataset_catalog(spark: SparkSession) -> DataFrame:
    """Dataset id, label and genome build, one row per dataset."""
    return spark.createDataFrame(DATASETS, "dataset_id string, label string, reference_genome string")


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def rename_contig(raw: Column) -> Column:
    """``chr1..chr22, chrX, chrY, chrM`` to bare names; other names pass through."""
    prefixed = [f"chr{name}" for name in COHORT_CONTIGS]
    return F.when(raw == "chrM", F.lit("MT")).when(raw.isin(prefixed), F.substring(raw, 4, 2)).otherwise(raw)


def contig_length(contig: Column) -> Column:
    """Length of a contig, null when it is not one of the genome's."""
    return F.try_element_at(_lookup(CONTIG_LENGTHS), contig)


def contig_index(contig: Column) -> Column:
    """Chromosome order (1..22, X, Y, MT) as an int; unknown contigs are null."""
    return F.try_element_at(_lookup({name: i for i, name in enumerate(CONTIG_LENGTHS)}), contig)


def on_cohort_contig(contig: Column, pos: Column) -> Column:
    """Allow-list predicate: a cohort contig and a position on it.

    ``isin`` stays a plain literal list so that it reaches the scan as a
    partition filter on ``contig``.
    """
    return contig.isin(COHORT_CONTIGS) & pos.between(F.lit(1), contig_length(contig))


def valid_locus(contig: Column, pos: Column) -> Column:
    """A known contig (MT included) and a position on it."""
    return F.coalesce(pos.between(F.lit(1), contig_length(contig)), F.lit(False))
