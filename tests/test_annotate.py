"""Annotation joins, flattening, documents and report."""

import json

from pyspark.sql import functions as F

from lociweave.functions.consequences import FLAT_FIELDS, flatten_consequence
from lociweave.functions.variants import first_double
from lociweave.operators import annotate as A
from lociweave.operators import documents as D
from lociweave.schemas import CONSEQUENCE


def vep(tc=None, ic=None, clinvar=None, custom=True):
    return {
        "input": None, "most_severe_consequence": None, "transcript_consequences": tc,
        "intergenic_consequences": ic, "custom_annotations": {"ClinVar": clinvar} if custom else None,
    }


TC = {"consequence_terms": ["a", "b"], "impact": "HIGH", "gene_symbol": "G", "hgvsg": "g", "hgvsc": "c", "hgvsp": "p",
      "transcript_id": "T", "cadd_phred": 1.5, "cadd_raw_rankscore": 0.1, "canonical": 1}
IC = {"consequence_terms": ["far"], "impact": "MODIFIER"}
CV = [{"allele": "C", "fields": {"CLNSIG": "Benign", "CLNREVSTAT": "one"}},
      {"allele": "C", "fields": {"CLNSIG": "Other", "CLNREVSTAT": "two"}}]


def test_flatten(spark):
    records = [
        (0, vep([TC], [IC], CV)), (1, vep([], [IC])), (2, vep(None, None, [], custom=True)), (3, None),
        (4, vep(None, [IC], custom=False)),
    ]
    df = spark.createDataFrame(records, f"i int, vep {CONSEQUENCE}")
    got = {r.i: r.f for r in df.select("i", flatten_consequence(F.col("vep")).alias("f")).collect()}
    assert tuple(got[0].asDict()) == tuple(FLAT_FIELDS)
    assert tuple(got[0]) == ("a&b", "HIGH", "G", "g", "c", "p", "T", 1.5, 0.1, "Benign", "one")
    assert tuple(got[1])[:3] == ("far", "MODIFIER", None)
    assert set(got[2]) == {None} and set(got[3]) == {None}
    assert got[4].Consequence == "far" and got[4].ClinVar_CLNSIG is None


def test_first_double(spark, rows):
    df = spark.createDataFrame([(0, ["0.5", "1"]), (1, []), (2, None), (3, ["x"])], "i int, v array<string>")
    assert rows(df.select("i", first_double(F.col("v")))) == [(0, 0.5), (1, None), (2, None), (3, None)]


def sites(spark):
    return A.with_variant_key(spark.createDataFrame(
        [("1", 5, ["A", "C"]), ("1", 6, ["A", "C", "G"]), ("1", 7, ["A"])], "contig string, pos int, alleles array<string>"
    ))


def test_frequency_needs_the_whole_allele_list(spark, rows):
    freq = spark.createDataFrame(
        [("1", 5, ["A", "C"], 0.1, None), ("1", 5, ["A", "C"], 0.3, 0.2), ("1", 6, ["A", "C"], 0.5, 0.5),
         ("1", 6, ["A", "C", "G"], 0.7, 0.6), ("1", 5, ["A", "C", "T"], 0.9, 0.9)],
        "contig string, pos int, alleles array<string>, af double, af_nfe double",
    )
    got = rows(A.join_frequency(sites(spark), freq), "pos", "gnomad_af", "gnomad_nonfin")
    assert got == [(5, 0.1, None), (6, 0.7, 0.6), (7, None, None)]


def test_joins_keep_the_row_count(spark):
    table = spark.createDataFrame(
        [("1", 5, "A", "C", "x", None)] * 4 + [("1", 5, "A", "C", "a", "z")],
        "contig string, pos int, ref string, alt string, clnsig string, clnrevstat string",
    )
    joined = A.join_clinical(sites(spark), table)
    assert joined.count() == 3
    assert joined.filter("pos = 5").first().clnsig == "a"


def test_first_per_key_with_a_hot_key(spark, rows):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    got = A.first_per_key(df, ["k"])
    assert got.count() == df.select("k").distinct().count()
    assert rows(got.filter("k = 'hot'")) == [("hot", 0)]


def variants(spark, **extra):
    qc = "struct<AC:array<bigint>,AF:array<double>,AN:bigint,homozygote_count:array<bigint>>"
    flat = "struct<" + ",".join(f"{c}:{'double' if c.startswith('CADD') else 'string'}" for c in FLAT_FIELDS) + ">"
    base = [
        ("1", 5, ["A", "C"], ([3, 1], [0.75, 0.25], 4, [1, 0]), ("x", "HIGH", "G", None, None, None, "T", 2.0, 0.1, "Pathogenic", None), 0.5, None),
        ("1", 7, ["A"], ([4], [1.0], 4, [2]), (None,) * 11, None, None),
    ]
    return spark.createDataFrame(base, f"contig string, pos int, alleles array<string>, variant_qc {qc}, vep {flat}, gnomad_af double, gnomad_nonfin double")


def test_documents(spark):
    docs = D.annotated_documents(variants(spark)).orderBy("pos").collect()
    assert docs[0].variant_id == "1-5-A-C" and docs[0].ac_total == 1 and docs[0].hom_count == 0
    assert docs[0].filters == [] and docs[0].rsids == []
    assert docs[1].variant_id is None and docs[1].alt is None and docs[1].ac_total is None and docs[1].an_total == 4
    assert len(docs[0]) == 23  # the 22 exported keys and rsids
    assert len(D.DOC_COLUMNS) == 27


def test_optional_filters(spark):
    marked = variants(spark).withColumn("filters", F.expr("case when pos = 5 then array('q','a','q') end"))
    assert [r.filters for r in D.basic_documents(marked).orderBy("pos").collect()] == [["a", "q"], []]


def test_upsert_twice_is_upsert_once(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "variant_id string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "variant_id string, v int")
    once = D.upsert_documents(old, new)
    assert rows(once) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(D.upsert_documents(once, new)) == rows(once)


def test_bulk_lines(spark):
    lines = [r.value for r in D.bulk_lines(D.as_declared(D.basic_documents(variants(spark).limit(1))), "idx").collect()]
    assert json.loads(lines[0]) == {"index": {"_index": "idx", "_id": "1-5-A-C"}}
    doc = json.loads(lines[1])
    assert len(doc) == 27 and doc["an"] == 4 and doc["gene_symbol"] is None and doc["rsids"] == []


def test_first_per_key_carries_each_column_once(spark, rows):
    df = spark.sql("select id % 2 as k, cast(9 - id as int) as a, concat('x', id) as b from range(10)")
    got = A.first_per_key(df, ["k"], order=["a", "b"])
    assert rows(got) == [(0, 1, "x8"), (1, 0, "x9")] and got.columns == ["k", "a", "b"]
    ranked = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "min(struct" in line]
    assert len(ranked) == 1 and ranked[0].count("_o") == 2 and ", b, b#" not in ranked[0]
