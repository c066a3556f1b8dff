"""Views as the tables the operators take."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.operators.annotate import annotate_variants
from lociweave.operators.callstats import call_statistics
from lociweave.operators.documents import annotated_documents, basic_documents
from lociweave.schemas import CONSEQUENCE, LOCAL_CALL

from conformance.views import TABLES, with_views


class Given:
    """The cohort tables derived from one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._registered: set[str] = set()

    def sql(self, text: str) -> DataFrame:
        """A statement over the given tables and the views."""
        full = with_views(text)
        for table in TABLES:
            if table not in self._registered and re.search(rf"\b{table}\b", full):
                self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet").createOrReplaceTempView(table)
                self._registered.add(table)
        return self.spark.sql(full)

    def table(self, name: str) -> DataFrame:
        return self.sql(f"select * from {name}")

    @cached_property
    def sites(self) -> DataFrame:
        return self.table("fx_sites").select(
            "contig", "pos",
            F.array_compact(F.array("ref", "alt", "alt2")).alias("alleles"),
            F.array_compact(F.array("rsid")).alias("rsids"),
        )

    @cached_property
    def calls(self) -> DataFrame:
        return self.table("fx_lgt").select(
            "contig", "pos", "sample_id",
            F.when(
                F.col("l0").isNotNull(),
                F.struct(F.array("l0", "l1").alias("alleles"), F.lit(False).alias("phased")),
            ).cast(LOCAL_CALL).alias("LGT"),
            F.array_compact(F.array(F.lit(0), F.col("la1"), F.col("la2"))).alias("LA"),
            "gq", "dp",
        )

    @cached_property
    def blocks(self) -> DataFrame:
        return self.table("fx_ref")

    @cached_property
    def samples(self) -> DataFrame:
        return self.table("fx_samples").select("sample_id")

    @cached_property
    def records(self) -> DataFrame:
        """Variant records and block records as a gVCF scan gives them."""
        called = F.struct(
            F.split("gt", "/").cast("array<int>").alias("alleles"), F.lit(False).alias("phased")
        )
        variants = self.table("fx_gvcf").select(
            "sample_id", "raw_contig", "pos", F.lit(None).cast("int").alias("end_pos"),
            F.lit(None).cast("array<string>").alias("rsids"), "ref", F.split("alts", ",").alias("alts"),
            F.when(F.col("gt") != "./.", called).cast(LOCAL_CALL).alias("LGT"), "gq", "dp",
        )
        raw = F.when(F.col("contig") == "MT", "chrM").otherwise(F.concat(F.lit("chr"), F.col("contig")))
        hom_ref = F.struct(F.array(F.lit(0), F.lit(0)).alias("alleles"), F.lit(False).alias("phased"))
        blocks = self.blocks.select(
            "sample_id", raw.alias("raw_contig"), "pos", "end_pos",
            F.lit(None).cast("array<string>").alias("rsids"), F.lit("N").alias("ref"),
            F.array(F.lit("<NON_REF>")).alias("alts"), hom_ref.cast(LOCAL_CALL).alias("LGT"), "gq", "dp",
        )
        return variants.unionByName(blocks)

    @cached_property
    def consequences(self) -> DataFrame:
        """Nested consequence records; absent lists are null for one record kind, empty for the other."""
        terms = F.split("consequence", "&")
        transcript = F.struct(
            terms.alias("consequence_terms"), "impact", "gene_symbol", "hgvsg", "hgvsc", "hgvsp", "transcript_id",
            F.lit(None).cast("double").alias("cadd_phred"),
            F.lit(None).cast("double").alias("cadd_raw_rankscore"), F.lit(1).alias("canonical"),
        )
        intergenic = F.struct(terms.alias("consequence_terms"), "impact")
        vep = F.struct(
            F.lit(None).cast("string").alias("input"),
            F.get(terms, F.lit(0)).alias("most_severe_consequence"),
            F.when(F.col("has_tc"), F.array(transcript)).alias("transcript_consequences"),
            F.when(F.col("has_ic"), F.array(intergenic)).otherwise(
                F.filter(F.array(intergenic), lambda _: F.lit(False))
            ).alias("intergenic_consequences"),
            F.lit(None).cast("struct<ClinVar:array<struct<allele:string,fields:struct<CLNSIG:string,CLNREVSTAT:string>>>>")
            .alias("custom_annotations"),
        )
        return self.table("fx_vep").select("contig", "pos", "ref", "alt", vep.cast(CONSEQUENCE).alias("vep"))

    @cached_property
    def frequency(self) -> DataFrame:
        return self.table("fx_gnomad").select(
            "contig", "pos", F.array("ref", "alt").alias("alleles"), "af", "af_nfe"
        )

    @cached_property
    def statistics(self) -> DataFrame:
        return call_statistics(self.sites, self.calls, self.blocks)

    @cached_property
    def annotated(self) -> DataFrame:
        return annotate_variants(
            self.statistics, self.consequences, self.table("fx_clinvar"), self.table("fx_cadd"), self.frequency
        )

    @cached_property
    def documents(self) -> DataFrame:
        return annotated_documents(self.annotated)

    @cached_property
    def basic(self) -> DataFrame:
        return basic_documents(self.statistics)

    @cached_property
    def document_keys(self) -> DataFrame:
        """Documents without statistics, for lookups that read identity fields only."""
        return self.sql(
            "select concat(contig, '-', cast(pos as string), '-', ref, '-', alt) as variant_id, "
            "contig as chrom, pos, ref, alt, rsid from fx_sites"
        ).withColumn("rsids", F.array_compact(F.array("rsid"))).drop("rsid")
