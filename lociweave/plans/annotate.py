"""Cohort version to annotated variants and samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave import schemas
from lociweave.operators.annotate import annotate_variants, frequency_table, score_table, with_variant_key
from lociweave.operators.callstats import call_statistics, variant_quality
from lociweave.operators.combine import Cohort
from lociweave.operators.metadata import join_metadata
from lociweave.operators.report import dimensions
from lociweave.session import replacing
from lociweave.sources import keyed, tables
from lociweave.sources.vcf import read_sites


def load_frequency(spark: SparkSession, table_path: str, sites_vcf: str | None) -> DataFrame:
    """The frequency table, imported from its sites VCF on first use."""

    def build() -> DataFrame:
        sites = read_sites(spark, sites_vcf, ["AF", "AF_nfe"])
        return frequency_table(sites.withColumnsRenamed({"AF": "af", "AF_nfe": "af_nfe"}))

    return tables.materialize_once(spark, table_path, sites_vcf, build, ["contig", "pos", "alleles"])


@dataclass(frozen=True)
class AnnotationSources:
    """Where the annotation tables come from; a table that is stored already needs no source."""

    consequences: str | None = None  #: JSON lines of the external annotator, a file or a folder
    clinical: str | None = None  #: sites VCF with CLNSIG and CLNREVSTAT
    snv_scores: str | None = None
    indel_scores: str | None = None
    frequency: str | None = None  #: sites VCF with AF and AF_nfe


def load_annotations(
    spark: SparkSession, folder: str, sources: AnnotationSources, buckets: int = keyed.BUCKETS
) -> dict[str, DataFrame | bool]:
    """The four annotation tables under ``folder``, each imported on first use, as :func:`annotate` takes them.

    ``annotate(cohort, **load_annotations(...), out=...)`` then exchanges the
    variants once and none of the tables. Score files are taken together.
    """

    def scores() -> DataFrame:
        files = [keyed.read_scores(spark, path) for path in (sources.snv_scores, sources.indel_scores) if path]
        return files[0] if len(files) == 1 else score_table(*files)

    def frequency() -> DataFrame:
        sites = read_sites(spark, sources.frequency, ["AF", "AF_nfe"])
        return with_variant_key(frequency_table(sites.withColumnsRenamed({"AF": "af", "AF_nfe": "af_nfe"})))

    def table(name: str, given: bool, build, ddl: str, also: list[str] | None = None) -> DataFrame:
        return keyed.keyed_once(spark, f"{folder}/{name}", build if given else None, ddl, buckets, also)

    return {
        "consequences": table(
            "consequences", sources.consequences is not None,
            lambda: keyed.consequence_rows(spark.read.text(sources.consequences)), schemas.CONSEQUENCES,
        ),
        "clinical": table(
            "clinical", sources.clinical is not None, lambda: keyed.read_clinical(spark, sources.clinical), schemas.CLINICAL
        ),
        "scores": table("scores", bool(sources.snv_scores or sources.indel_scores), scores, schemas.SCORES),
        "frequency": table("frequency", sources.frequency is not None, frequency, schemas.FREQUENCY, ["alleles"]),
        "unique": True,
    }


def annotate(
    cohort: Cohort,
    consequences: DataFrame,
    clinical: DataFrame,
    scores: DataFrame,
    frequency: DataFrame,
    out: str,
    metadata: DataFrame | None = None,
    overwrite: bool = False,
    quality: bool = True,
    unique: bool = False,
    exact_test: bool = True,
) -> DataFrame:
    """Statistics, four annotation joins and sample metadata; returns the dimensions row.

    ``quality`` stores the whole ``variant_qc``; without it only the fields
    the documents read are computed, which skips the dp / gq summaries.
    ``unique`` says that the four tables hold one row per key, which spares
    sorting them; ``exact_test`` false leaves out the exact test.

    Blocks of a stored cohort are disjoint from its calls, so the statistics
    need no sample-level join. Counts are taken from the written tables.
    """
    if quality:
        stats = variant_quality(cohort.sites, cohort.calls, cohort.ref_blocks, cohort.samples, blocks_disjoint=True, exact_test=exact_test)
    else:
        stats = call_statistics(cohort.sites, cohort.calls, cohort.ref_blocks, blocks_disjoint=True)
    tables.write_annotated(
        annotate_variants(stats, consequences, clinical, scores, frequency, unique), f"{out}/variants", overwrite
    )
    samples = join_metadata(cohort.samples, metadata)
    (replacing(samples) if overwrite else samples.write.mode("errorifexists")).parquet(f"{out}/samples")
    spark = cohort.sites.sparkSession
    return dimensions(
        tables.read_annotated(spark, f"{out}/variants"), spark.read.parquet(f"{out}/samples").select(F.col("sample_id"))
    )
