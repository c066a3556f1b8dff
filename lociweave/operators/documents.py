"""Flat variant documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions.alleles import first_alt
from lociweave.functions.variants import double_or_null, normalized_set, variant_id
from lociweave.schemas import VARIANT_DOCS

DOC_COLUMNS = [field.strip().split(" ")[0] for field in VARIANT_DOCS.split(", ")]
DOC_TYPES = dict(field.strip().split(" ") for field in VARIANT_DOCS.split(", "))


def optional(df: DataFrame, name: str, default: Column) -> Column:
    """A column if the table has it, else the default."""
    return F.col(name) if name in df.columns else default


def _identity(variants: DataFrame) -> list[Column]:
    no_strings = F.array().cast("array<string>")
    ref, alt = F.get("alleles", F.lit(0)), first_alt(F.col("alleles"))
    return [
        variant_id(F.col("contig"), F.col("pos"), ref, alt).alias("variant_id"),
        F.col("contig").alias("chrom"), "pos", ref.alias("ref"), alt.alias("alt"),
        normalized_set(optional(variants, "rsids", no_strings)).alias("rsids"),
        normalized_set(optional(variants, "filters", no_strings)).alias("filters"),
    ]


def _index1(field: str) -> Column:
    return F.get(f"variant_qc.{field}", F.lit(1))


def annotated_documents(variants: DataFrame) -> DataFrame:
    """The annotated document: identity, statistics of allele 1, annotation fields."""
    vep = {
        "gene_symbol": "SYMBOL", "consequence": "Consequence", "impact": "IMPACT", "gdna": "HGVSg",
        "cdna": "HGVSc", "p_nomen": "HGVSp", "transcript": "transcript_id",
    }
    return variants.select(
        *_identity(variants),
        _index1("AC").alias("ac_total"),
        F.col("variant_qc.AN").alias("an_total"),
        double_or_null(_index1("AF")).alias("af_total"),
        _index1("homozygote_count").alias("hom_count"),
        *[F.col(f"vep.{source}").alias(name) for name, source in vep.items()],
        double_or_null(F.col("vep.CADD_PHRED")).alias("cadd_score"),
        F.col("vep.ClinVar_CLNSIG").alias("clinvar_sig"),
        F.col("vep.ClinVar_CLNREVSTAT").alias("clinvar_clnrevstat"),
        double_or_null(F.col("gnomad_af")).alias("gnomad_af"),
        double_or_null(F.col("gnomad_nonfin")).alias("gnomad_nonfin"),
    )


def basic_documents(variants: DataFrame) -> DataFrame:
    """The statistics-only document, under the older field names."""
    return variants.select(
        *_identity(variants),
        _index1("AC").alias("ac"),
        F.col("variant_qc.AN").alias("an"),
        double_or_null(_index1("AF")).alias("af"),
        _index1("homozygote_count").alias("n_hom"),
    )


def as_declared(docs: DataFrame, *beside: Column) -> DataFrame:
    """Either document kind under the declared 27-field mapping; absent fields are null."""
    return docs.select(
        *beside,
        *[
            (F.col(name) if name in docs.columns else F.lit(None)).cast(DOC_TYPES[name]).alias(name)
            for name in DOC_COLUMNS
        ]
    )


def last_write_per_id(docs: DataFrame, version: str) -> DataFrame:
    """One document per id: the one with the highest ``version``."""
    latest = docs.groupBy("variant_id").agg(F.max_by(F.struct(*docs.columns), F.col(version)).alias("_latest"))
    return latest.select("_latest.*")


def one_per_id(docs: DataFrame, order: str | None = None) -> DataFrame:
    """One document per id: the last by ``order``, which is dropped; without it the greatest row, the same on every run."""
    if order is not None:
        return last_write_per_id(docs, order).drop(order)
    return docs.groupBy("variant_id").agg(F.max(F.struct(*docs.columns)).alias("_kept")).select("_kept.*")


def upsert_documents(current: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Documents after writing ``incoming`` over ``current``; same id replaces.

    Only ids are compared. The current table is not reshuffled when the
    incoming side measures small enough to broadcast, which an increment
    mostly does. Of several incoming documents of one id the last by ``order``
    is written (see :func:`one_per_id`).
    """
    incoming = one_per_id(incoming, order)
    kept = current.join(incoming.select("variant_id"), "variant_id", "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def bulk_lines(docs: DataFrame, index: str) -> DataFrame:
    """Bulk-load text: an action line and a document line per document, nulls written out."""
    keep_nulls = {"ignoreNullFields": "false"}
    action = F.to_json(
        F.struct(F.struct(F.lit(index).alias("_index"), F.col("variant_id").alias("_id")).alias("index"))
    )
    return docs.select(
        F.explode(F.array(action, F.to_json(F.struct(*docs.columns), keep_nulls))).alias("value")
    )
