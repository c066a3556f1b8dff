"""Annotation tables by variant key: loaders, stored form, and joins that exchange none of them."""

import gzip
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lociweave import schemas
from lociweave.operators.annotate import (
    VARIANT_KEY, annotate_variants, join_clinical, join_consequence, join_frequency, join_scores, with_variant_key,
)
from lociweave.plans.annotate import AnnotationSources, load_annotations
from lociweave.sources import keyed

VCF = "##fileformat=VCFv4.1\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
SCORE_HEADER = "## scores v0\n#Chrom\tPos\tRef\tAlt\tType\tRawScore\tPHRED\n"
N = 400


def write_sources(folder):
    def put(name, text):
        Path(f"{folder}/{name}").write_bytes(gzip.compress(text.encode()))
        return f"{folder}/{name}"

    clinical = "".join(
        f"chr1\t{i}\t.\tA\tC,G\t.\t.\tCLNSIG=Benign,_{i};CLNREVSTAT=criteria_provided,_single_submitter\n" for i in range(1, N)
    ) + "1\t5\t.\tA\t.\t.\t.\tCLNSIG=x\n" + "zz\t5\t.\tA\tT\t.\t.\tCLNSIG=x\n" + "1\t7\t.\tA\tT\t.\t.\tAF=1\n"
    snv = "".join(f"1\t{i}\tA\t{alt}\tSNV\t{i / 8}\t{i % 50}\n" * 2 for i in range(1, N) for alt in "CG")
    indel = SCORE_HEADER.replace("Type\t", "") + "1\t9\tAT\tA\tnone\t3.5\nX\t0\tA\tAT\t1\t1\n"
    vep = [
        {"input": f"1 {i} . A C . . .", "most_severe_consequence": "stop_gained",
         "transcript_consequences": [{"consequence_terms": ["stop_gained"], "impact": "HIGH", "gene_symbol": f"G{i % 7}"}]}
        for i in range(1, N, 2)
    ]
    Path(f"{folder}/vep.json").write_text("\n".join(map(json.dumps, vep)) + "\nnot json\n{}\n")
    frequency = "".join(f"1\t{i}\t.\tA\tC\t.\tPASS\tAF=0.{i};AF_nfe=.\n" for i in range(1, N, 3))
    return AnnotationSources(
        f"{folder}/vep.json", put("clinvar.vcf.gz", VCF + clinical), put("snv.tsv.gz", SCORE_HEADER + snv),
        put("indel.tsv.gz", indel), put("sites.vcf.gz", VCF + frequency),
    )


@pytest.fixture
def variants(spark):
    rows = [("1", i, ["A", alt] + (["T"] if i % 10 == 0 else []), None) for i in range(1, N) for alt in "C"] + [("1", 9, ["AT", "A"], None), ("2", 3, ["A"], None)]
    return spark.createDataFrame(rows, schemas.SITES).withColumn("variant_qc", F.lit(1))


def test_loaders(spark, folder, rows):
    sources = write_sources(folder)
    clinical = keyed.read_clinical(spark, sources.clinical)
    assert rows(clinical.filter("pos in (5, 7)")) == [
        *[("1", p, "A", alt, f"Benign,_{p}", "criteria_provided,_single_submitter") for p in (5, 7) for alt in "CG"],
        ("1", 7, "A", "T", None, None),
    ]
    for size in (200, 1 << 20):
        snv = keyed.read_scores(spark, sources.snv_scores, range_bytes=size)
        assert snv.count() == 4 * (N - 1) and rows(snv.filter("pos = 8 and alt = 'C'")) == [("1", 8, "A", "C", 8.0, 1.0)] * 2
    assert rows(keyed.read_scores(spark, sources.indel_scores)) == [("1", 9, "AT", "A", 3.5, None)]
    records = keyed.consequence_rows(spark.read.text(sources.consequences))
    assert records.count() == N // 2 and rows(records.filter("pos = 3"), *VARIANT_KEY, "vep.most_severe_consequence") == [("1", 3, "A", "C", "stop_gained")]
    Path(f"{folder}/bare.tsv").write_text("1\t1\tA\tC\t1\t1\n")
    with pytest.raises(ValueError, match="column names"):
        keyed.read_scores(spark, f"{folder}/bare.tsv")
    with pytest.raises(ValueError, match="no column PHRED"):
        keyed.score_rows(spark.createDataFrame([], "value string"), "#Chrom\tPos\tRef\tAlt\tRawScore")


def test_stored_tables_join_without_an_exchange_of_their_own(spark, folder, rows, variants):
    stored = load_annotations(spark, f"{folder}/tables", write_sources(folder), buckets=16)
    assert stored["scores"].count() == 2 * (N - 1) + 1
    plain = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in stored.items() if k != "unique"}
    plain["frequency"] = plain["frequency"].drop("ref", "alt")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = annotate_variants(variants, **stored)
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\)", text)[0][1] == "16"
        assert text.count("Exchange hashpartitioning") == 1 and "Aggregate" not in text
        assert text.count("Bucketed: true") == 4
        want = rows(annotate_variants(variants, **plain))
        assert rows(joined) == want and len(want) == N + 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = {(r.pos, tuple(r.alleles)): r for r in joined.collect()}
    assert found[9, ("AT", "A")].vep.CADD_RAW is None and found[9, ("A", "C")].vep.CADD_PHRED == 9.0
    assert found[7, ("A", "C")].gnomad_af == 0.7 and found[10, ("A", "C", "T")].gnomad_af is None


def test_tables_are_imported_once_and_open_in_another_session(spark, folder, rows):
    sources = write_sources(folder)
    first = load_annotations(spark, f"{folder}/tables", sources, buckets=4)
    told = rows(first["clinical"])
    name = json.loads(Path(f"{folder}/tables/clinical/{keyed.SPEC}").read_text())["name"]
    spark.sql(f"drop table {name}")
    again = load_annotations(spark, f"{folder}/tables", AnnotationSources(), buckets=99)
    assert rows(again["clinical"]) == told and rows(again["frequency"]) == rows(first["frequency"])
    with pytest.raises(FileNotFoundError):
        load_annotations(spark, f"{folder}/other", AnnotationSources())
    late = keyed.write_keyed(first["clinical"].limit(0), f"{folder}/tables/clinical", schemas.CLINICAL, 4)
    assert rows(late) == told


def test_one_row_a_key_and_none_without_a_key(spark, folder, rows):
    given = [("1", 1, "A", "C", "b", "r")] * 3 + [("1", 1, "A", "C", "a", None), ("1", 2, "A", None, "x", "y"), (None, 2, "A", "C", "x", "y")]
    table = keyed.write_keyed(spark.createDataFrame(given, schemas.CLINICAL), f"{folder}/t", schemas.CLINICAL, 3)
    assert rows(table) == [("1", 1, "A", "C", "a", None)]
    none = keyed.write_keyed(spark.createDataFrame([], schemas.SCORES), f"{folder}/none", schemas.SCORES, 3)
    sites = with_variant_key(spark.createDataFrame([("1", 1, ["A", "C"], None)], schemas.SITES))
    assert rows(join_scores(join_clinical(sites, table, True), none, True), "clnsig", "cadd_raw") == [("a", None)]
    empty = {k: spark.createDataFrame([], ddl) for k, ddl in (("vep", schemas.CONSEQUENCES), ("frequency", schemas.FREQUENCY))}
    assert rows(join_frequency(join_consequence(sites, empty["vep"]), empty["frequency"]), "vep", "gnomad_af") == [(None, None)]
