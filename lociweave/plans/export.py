"""Annotated variants, or a bare cohort, to documents and stored lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociweave.operators.callstats import call_statistics
from lociweave.operators.combine import Cohort
from lociweave.operators.documents import annotated_documents, basic_documents
from lociweave.operators.lookup import variants_by_interval
from lociweave.sources.documents import read_documents, write_by_interval, write_documents, write_rsid_index


def export_annotated(variants: DataFrame, path: str, rsid_index: str | None = None) -> int:
    """Full documents of a stored variant table, written in its order; returns how many.

    ``rsid_index`` is where the table of their rsids goes.
    """
    n = write_documents(annotated_documents(variants), path, in_order=True)
    if rsid_index:
        write_rsid_index(variants.sparkSession, path, rsid_index)
    return n


def export_basic(cohort: Cohort, path: str, rsid_index: str | None = None) -> int:
    """Statistics-only documents straight from a cohort store."""
    stats = call_statistics(cohort.sites, cohort.calls, cohort.ref_blocks, blocks_disjoint=True)
    n = write_documents(basic_documents(stats), path)
    if rsid_index:
        write_rsid_index(cohort.sites.sparkSession, path, rsid_index)
    return n


def store_lookups(spark: SparkSession, documents: str, genes: DataFrame, transcripts: DataFrame, base: str) -> None:
    """The gene and transcript answers, rebuilt with the documents."""
    docs = read_documents(spark, documents)
    write_by_interval(variants_by_interval(docs, genes, "gene_id"), "gene_id", f"{base}/variants_by_gene")
    write_by_interval(
        variants_by_interval(docs, transcripts, "transcript_id"), "transcript_id", f"{base}/variants_by_transcript"
    )
