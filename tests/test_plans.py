"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from conformance.queries import QUERIES
from lociweave.operators import lookup as L
from lociweave.operators.annotate import join_frequency, join_clinical, join_scores, with_variant_key
from lociweave.operators.callstats import allele_tallies, call_statistics
from lociweave.operators.documents import as_declared
from lociweave.schemas import CALLS, REF_BLOCKS, SITES
from lociweave.sources import documents as doc_io

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    # Long lists of pushed filters are shown whole.
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    keys = QUERIES["docs_basic"](spark, SF_DIR).drop("rsids", "filters")
    doc_io.write_documents(as_declared(keys), f"{path}/docs")
    return f"{path}/docs"


def scan_of(text):
    return re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], ReadSchema: (.*)", text)


def test_region_filter_reaches_the_scan(spark, stored):
    docs = doc_io.read_documents(spark, stored)
    scan = scan_of(plan(L.count_variants_in_region(docs, "7", 10, 20)))
    assert "chrom" in scan[1] and "GreaterThanOrEqual(pos,10)" in scan[2] and "LessThanOrEqual(pos,20)" in scan[2]
    assert scan[3].startswith("struct<pos:int>")


def test_id_lookup_prunes_by_its_parts(spark, stored):
    docs = doc_io.read_documents(spark, stored)
    scan = scan_of(plan(docs.filter(L.has_id("7-55-A-C"))))
    assert "chrom" in scan[1] and "EqualTo(pos,55)" in scan[2] and "EqualTo(variant_id,7-55-A-C)" in scan[2]


def test_prefix_lookup_prunes_the_contig(spark, stored):
    docs = doc_io.read_documents(spark, stored)
    scan = scan_of(plan(docs.filter(L.matches("7-1"))))
    assert "chrom" in scan[1] and "StringStartsWith(variant_id,7-1)" in scan[2] and "pos" in scan[2]


def test_prefix_lookup_names_position_ranges(spark, stored):
    docs = doc_io.read_documents(spark, stored)
    scan = scan_of(plan(docs.filter(L.matches("7-39"))))
    assert "EqualTo(pos,39)" in scan[2] and "GreaterThanOrEqual(pos,390)" in scan[2] and "LessThanOrEqual(pos,399)" in scan[2]
    assert "chrom" in scan_of(plan(docs.filter(L.matches("1"))))[1]


def test_rsid_lookup_reads_the_index_and_one_place(spark, stored, tmp_path):
    docs = doc_io.read_documents(spark, stored)
    named = docs.withColumn("rsids", F.array(F.concat(F.lit("rs"), "pos")))
    doc_io.write_documents(named, f"{tmp_path}/docs")
    doc_io.write_rsid_index(spark, f"{tmp_path}/docs", f"{tmp_path}/index")
    index = doc_io.read_rsid_index(spark, f"{tmp_path}/index")
    one = index.filter(F.col("rsid") == "rs5")
    assert "EqualTo(rsid,rs5)" in scan_of(plan(one))[2]
    place = index.orderBy("rsid").limit(1).collect()
    scan = scan_of(plan(docs.filter(L.at_places(place))))
    assert "chrom" in scan[1] and f"EqualTo(pos,{place[0].pos})" in scan[2] and "EqualTo(variant_id" in scan[2]
    assert L.fetch_variant(named, place[0].rsid, index).variant_id == place[0].variant_id
    # Autocomplete of an rsid reads no contig of the documents, the batch form reads rsids from the index alone.
    text = plan(L.matching_variants(doc_io.read_documents(spark, f"{tmp_path}/docs"), "rs5", index=index))
    assert "StartsWith(chrom" in text and "EqualTo(rsid,rs5)" in text
    asked = spark.createDataFrame([("rs5",), (place[0].variant_id,)], "query string")
    text = plan(L.lookup_many(doc_io.read_documents(spark, f"{tmp_path}/docs"), asked, index))
    assert f"GreaterThanOrEqual(pos,{place[0].pos})" in text and not re.search(r"ReadSchema: [^\n]*rsids", text)


def empty(spark, ddl):
    return spark.createDataFrame([], ddl)


def test_call_counting_combines_before_its_shuffle_in_one_generated_stage(spark, tmp_path):
    spark.createDataFrame([("1", 5, "s", None, [0, 1], 1, 1)], CALLS).write.parquet(f"{tmp_path}/calls")
    text = plan(allele_tallies(spark.read.parquet(f"{tmp_path}/calls")))
    assert "partial_count" in text and text.count("Exchange") == 1
    assert re.search(r"ReadSchema: struct<contig:string,pos:int,LGT:struct<alleles:array<int>>,LA:array<int>>", text)
    # everything from the scan to the partial counts is one generated stage
    final = allele_tallies(spark.read.parquet(f"{tmp_path}/calls"))
    final.collect()
    stages = re.findall(r"\*\((\d+)\) (\w+)", plan(final))
    assert {op for n, op in stages if n == "1"} >= {"Project", "Generate", "HashAggregate", "ColumnarToRow"}


def test_statistics_on_disjoint_blocks_have_no_sample_level_shuffle(spark):
    stats = call_statistics(empty(spark, SITES), empty(spark, CALLS), empty(spark, REF_BLOCKS), blocks_disjoint=True)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(stats))
    assert exchanges and not any("sample_id" in e for e in exchanges)


def test_annotation_chain_exchanges_variants_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = "contig string, pos int, ref string, alt string"
        sites = with_variant_key(empty(spark, SITES).filter(F.rand() < 2))
        joined = join_scores(
            join_clinical(sites, spark.createDataFrame([("1", 1, "A", "C", "x", "y")], f"{keys}, clnsig string, clnrevstat string")),
            spark.createDataFrame([("1", 1, "A", "C", 1.0, 1.0)], f"{keys}, cadd_phred double, cadd_raw double"))
        # one exchange for the variants, one per right side (shared by its aggregation and the join)
        assert plan(joined).count("Exchange hashpartitioning") == 3
        frequency = spark.createDataFrame([("1", 1, ["A", "C"], 0.1, 0.1)], "contig string, pos int, alleles array<string>, af double, af_nfe double")
        # the allele list is no fifth key, so the frequency table is the only new exchange
        text = plan(join_frequency(joined, frequency, unique=True))
        assert text.count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_preview_and_region_limits_sort_no_more_than_they_keep(spark, stored):
    docs = doc_io.read_documents(spark, stored)
    assert "TakeOrderedAndProject" in plan(L.variants_in_region(docs, "7", 10, 20))
    assert "TakeOrderedAndProject" in plan(L.matching_variants(docs, "7-1"))


def test_partitions_follow_the_shuffle_size():
    from lociweave.session import shuffle_partitions

    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(100 << 40) == 100 * 8192
