"""Single lookups, routing and checks."""

import pytest
from pyspark.sql import functions as F

from lociweave.operators import lookup as L
from lociweave.operators.documents import as_declared


@pytest.fixture(scope="module")
def docs(spark):
    data = [("1-5-A-C", "1", 5, "A", "C", ["rs7"]), ("1-5-A-G", "1", 5, "A", "G", ["rs7", "rs8"]),
            ("1-50-A-G", "1", 50, "A", "G", []), ("10-5-A-C", "10", 5, "A", "C", None)]
    df = spark.createDataFrame(data, "variant_id string, chrom string, pos int, ref string, alt string, rsids array<string>")
    return as_declared(df.withColumn("ac", F.lit(3)).withColumn("ac_total", F.when(F.col("pos") == 5, 4)))


def test_every_document_finds_itself(docs):
    for row in docs.collect():
        assert L.fetch_variant(docs, row.variant_id).variant_id == row.variant_id


def test_rsid_routing(docs):
    assert L.fetch_variant(docs, "rs8").variant_id == "1-5-A-G"
    with pytest.raises(L.VariantLookupError, match="multiple variants found, query using variant ID to select one"):
        L.fetch_variant(docs, "rs7")
    for query in ("rs9", "1-6-A-C", "rs7x", "no", "1-99999999999-A-C"):
        with pytest.raises(L.VariantLookupError, match="variant not found"):
            L.fetch_variant(docs, query)


def test_counts_prefer_the_annotated_names(docs):
    assert L.fetch_variant(docs, "1-5-A-C").exome.ac == 4
    assert L.fetch_variant(docs, "1-50-A-G").exome.ac == 3
    shaped = L.fetch_variant(docs, "10-5-A-C")
    assert shaped.rsids == [] and shaped.exome.filters == [] and shaped.genome is None


def test_region_is_closed_and_ordered(docs):
    got = [r.variant_id for r in L.variants_in_region(docs, "1", 5, 50).collect()]
    assert got == ["1-5-A-C", "1-5-A-G", "1-50-A-G"]
    assert L.variants_in_region(docs, "1", 6, 49).count() == 0
    assert [r.variant_id for r in L.variants_in_region(docs, "1", 1, 99, limit=1).collect()] == ["1-5-A-C"]
    assert L.count_variants_in_region(docs, "1", 1, 99).first().n_variants == 3


def test_autocomplete(docs):
    found = lambda q, **k: [r.variant_id for r in L.matching_variants(docs, q, **k).collect()]
    assert found("1-5") == ["1-5-A-C", "1-5-A-G", "1-50-A-G"]
    assert found("1") == ["1-5-A-C", "1-5-A-G", "1-50-A-G", "10-5-A-C"]
    assert found("1", limit=2) == ["1-5-A-C", "1-5-A-G"]
    assert found("rs8") == ["1-5-A-G"] and found("%") == [] and found("1_5") == []


def test_many(spark, docs, rows):
    asked = spark.createDataFrame([("rs7",), ("rs8",), ("1-5-A-C",), ("zz",), ("rs8",)], "query string")
    assert rows(L.lookup_many(docs, asked), "query", "n_hits", "variant_id") == [
        ("1-5-A-C", 1, "1-5-A-C"), ("rs7", 2, None), ("rs8", 1, "1-5-A-G"), ("zz", 0, None)]


def test_genome_check(spark):
    L.assert_genome("cohort", "GRCh37")
    for dataset in ("gnomad_r4", "unknown"):
        with pytest.raises(L.VariantLookupError):
            L.assert_genome(dataset, "GRCh37")
    from lociweave.genome import dataset_catalog

    assert dataset_catalog(spark).count() == 16


def test_prefix_ranges_cover_just_the_positions_that_begin_with_the_digits():
    for digits in ("1", "39", "117", "2147483647", "999999999", "0", "05"):
        ranges = L.positions_with_prefix(digits)
        assert len(ranges) <= 10
        inside = lambda p: any(a <= p <= b for a, b in ranges)
        for p in [0, 1, 5, 10, 11, 39, 117, 390, 399, 400, 1170, 11799, 11800, 39_000_000, 2_147_483_647, 999_999_999, 1_999_999_999]:
            assert inside(p) == str(p).startswith(digits)


def test_index_answers_as_the_documents_do(spark, docs, rows):
    index = L.rsid_index(docs)
    assert L.fetch_variant(docs, "rs8", index).variant_id == "1-5-A-G"
    with pytest.raises(L.VariantLookupError, match="multiple variants found"):
        L.fetch_variant(docs, "rs7", index)
    with pytest.raises(L.VariantLookupError, match="variant not found"):
        L.fetch_variant(docs, "rs9", index)
    for query in ("rs7", "rs8", "rs", "rs70"):
        got = [r.variant_id for r in L.matching_variants(docs, query, index=index).collect()]
        assert got == [r.variant_id for r in L.matching_variants(docs, query).collect()]
    asked = spark.createDataFrame([(q,) for q in ("rs7", "rs8", "1-5-A-C", "zz", "1-05-A-C", "1-99999999999-A-C", "10-5-A-C")], "query string")
    assert rows(L.lookup_many(docs, asked, index)) == rows(L.lookup_many(docs, asked))


def test_prefixes_with_and_without_an_end(docs):
    found = lambda q: [r.variant_id for r in L.matching_variants(docs, q, limit=9).collect()]
    assert found("1-5-") == ["1-5-A-C", "1-5-A-G"] and found("1-5-A-G") == ["1-5-A-G"]
    assert found("1-50") == ["1-50-A-G"] and found("1-05") == [] and found("1-99999999999-") == [] and found("1-") == found("1-5")
    assert found("10") == ["10-5-A-C"] and found("") == ["1-5-A-C", "1-5-A-G", "1-50-A-G", "10-5-A-C"]
