"""Cohort merge."""

import pytest
from pyspark.sql import functions as F

from lociweave.functions.genotypes import call_text
from lociweave.operators import combine as C
from lociweave.operators.callstats import call_statistics
from lociweave.schemas import RECORDS

ANY = "<NON_REF>"


def record(sample, contig, pos, ref, alts, gt, gq=30, end=None, rsids=None):
    alleles = None if gt is None else {"alleles": gt, "phased": False}
    return (sample, contig, pos, end, rsids, ref, alts, alleles, gq, 10)


FIRST = [
    record("a", "chr1", 100, "A", ["C", ANY], [0, 1], rsids=["rs2"]),
    record("b", "chr1", 100, "AT", ["A", ANY], [0, 1]),
    record("a", "chr1", 1, "N", [ANY], [0, 0], end=99),
    record("b", "chrM", 100, "A", ["C", ANY], [0, 1]),
    record("b", "chrUn", 100, "A", ["C", ANY], [0, 1]),
    record("b", "chr22", 51304567, "A", ["C", ANY], [0, 1]),
    record("b", "chrX", 7, "A", ["*", "G", ANY], [1, 2]),
    record("b", "chrX", 9, "A", ["G", ANY], [0, 2]),
]
SECOND = [
    record("c", "chr1", 100, "ATG", ["A", ANY], [1, 1], rsids=["rs1"]),
    record("c", "chrX", 7, "AC", ["A", ANY], [0, 1]),
    record("d", "1", 100, "A", ["C", "T"], [1, 2]),
]


def frame(spark, records):
    return spark.createDataFrame(records, RECORDS)


def sites_of(cohort):
    return {(r.contig, r.pos): r.alleles for r in cohort.sites.collect()}


def test_filter(spark, rows):
    kept = C.filter_records(frame(spark, FIRST + SECOND))
    assert {r[0] for r in rows(kept, "contig")} == {"1", "X"}


def test_unified_alleles(spark):
    cohort = C.combine(frame(spark, FIRST))
    # the deletion allele A of AT and the padded C of A; '*' is not padded
    assert sites_of(cohort) == {
        ("1", 100): ["AT", "A", "CT"], ("X", 7): ["A", "*", "G"], ("X", 9): ["A", "G"],
    }
    got = {(r.contig, r.pos, r.sample_id): (r.LA, r.gt) for r in
           cohort.calls.withColumn("gt", call_text(F.col("LGT"))).collect()}
    assert got == {
        ("1", 100, "a"): ([0, 2], "0/1"), ("1", 100, "b"): ([0, 1], "0/1"), ("X", 7, "b"): ([0, 1, 2], "1/2"),
        ("X", 9, "b"): ([0, 1], None),  # points at the placeholder
    }
    assert [(r.sample_id, r.contig, r.pos, r.end_pos) for r in cohort.ref_blocks.collect()] == [("a", "1", 1, 99)]


def test_later_run_appends_alleles(spark):
    first = C.combine(frame(spark, FIRST))
    both = C.combine(frame(spark, SECOND), first)
    assert sites_of(both) == {
        ("1", 100): ["ATG", "AG", "CTG", "A", "TTG"], ("X", 7): ["AC", "*", "GC", "A"], ("X", 9): ["A", "G"],
    }
    la = {(r.pos, r.sample_id): r.LA for r in both.calls.collect()}
    assert la[100, "a"] == [0, 2] and la[100, "b"] == [0, 1]  # as written in the first run
    assert la[100, "c"] == [0, 3] and la[100, "d"] == [0, 2, 4] and la[7, "c"] == [0, 3]
    rsids = {(r.contig, r.pos): r.rsids for r in both.sites.collect()}
    assert rsids["1", 100] == ["rs1", "rs2"] and rsids["X", 7] == []


def per_allele_string(cohort):
    stats = call_statistics(cohort.sites, cohort.calls, cohort.ref_blocks, blocks_disjoint=True)
    return {
        (r.contig, r.pos): (r.variant_qc.AN, dict(zip(r.alleles, zip(r.variant_qc.AC, r.variant_qc.homozygote_count))))
        for r in stats.collect()
    }


def test_one_run_and_two_runs_count_the_same(spark):
    once = C.combine(frame(spark, FIRST + SECOND))
    twice = C.combine(frame(spark, SECOND), C.combine(frame(spark, FIRST)))
    assert per_allele_string(once) == per_allele_string(twice)


def test_two_records_at_one_locus(spark, rows):
    records = frame(spark, [
        record("a", "1", 5, "A", ["C"], [0, 1], gq=10), record("a", "1", 5, "AT", ["A"], [0, 1], gq=40),
        record("a", "1", 6, "A", ["G"], [0, 1]), record("b", "1", 5, "A", ["C"], [0, 1]),
    ])
    filtered = C.filter_records(records)
    kept = C.one_record_per_locus(filtered)
    assert rows(kept, "sample_id", "pos", "ref") == [("a", 5, "AT"), ("a", 6, "A"), ("b", 5, "A")]
    assert rows(C.duplicate_loci(filtered)) == [("a", 1)]


def test_shared_samples(spark, rows):
    one = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    assert rows(C.shared_samples(one, spark.createDataFrame([("b",), ("c",)], "sample_id string"))) == [("b",)]


@pytest.mark.parametrize("n", [3000])
def test_a_locus_that_holds_most_records(spark, n):
    crowd = [record(f"s{i}", "1", 500, "A", ["C" if i % 3 else "CT", ANY], [0, 1]) for i in range(n)]
    cohort = C.combine(frame(spark, crowd + FIRST))
    stats = per_allele_string(cohort)
    an, counts = stats["1", 500]
    assert an == 2 * n and counts["CT"][0] == n // 3 and counts["C"][0] == n - n // 3


def test_records_of_a_merge_are_brought_together_by_locus_alone(spark):
    """The choice of records, the allele lists and the calls of a run all work on records that lie by locus."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables that are too large
    try:
        both = C.combine(frame(spark, SECOND), C.combine(frame(spark, FIRST)))
        plan = both.calls.join(both.sites, C.LOCUS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(contig" in plan and "hashpartitioning(sample_id" not in plan
    assert both.calls.join(both.sites, C.LOCUS).count() == both.calls.count() == 7


def test_equal_records_are_chosen_by_the_rest_of_the_record(spark, rows):
    twice = [record("a", "1", 5, "A", ["C"], gt) for gt in ([1, 1], [0, 1], [0, 1])] + [record(None, "1", 5, "A", ["C"], gt) for gt in ([0, 1], None)]
    for given in (twice, twice[::-1]):
        kept = C.one_record_per_locus(C.filter_records(frame(spark, given)))
        assert rows(kept, "sample_id", "LGT.alleles") == sorted([("a", [0, 1]), (None, None)], key=repr)
