"""Genotypes, statistics and Hardy-Weinberg edge cases."""

from math import comb, isclose

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.functions.genotypes import call_text, local_to_global, parse_call
from lociweave.functions.hardy import hwe_p_values
from lociweave.operators.callstats import call_statistics, hardy_weinberg, variant_quality
from lociweave.operators.densify import dense_entries
from lociweave.schemas import CALLS, LOCAL_CALL, REF_BLOCKS

SITES = "contig string, pos int, alleles array<string>"


def call(*alleles):
    return {"alleles": list(alleles), "phased": False} if alleles else None


def test_local_to_global(spark, rows):
    data = [
        (1, call(0, 1), [0, 2]), (2, call(1, 1), [0, 1]), (3, None, [0, 1]), (4, call(0, 0), None),
        (5, call(0, 1), None), (6, call(1), [0, 3]), (7, call(0, 5), [0, 1]), (8, call(1, 2), [0, 3, 1]),
    ]
    df = spark.createDataFrame(data, f"i int, LGT {LOCAL_CALL}, LA array<int>")
    got = rows(df.select("i", call_text(local_to_global(F.col("LGT"), F.col("LA"))).alias("gt")))
    assert got == [(1, "0/2"), (2, "1/1"), (3, None), (4, "0/0"), (5, None), (6, "3"), (7, None), (8, "3/1")]


def test_parse_call(spark, rows):
    texts = ["0/1", "1|2", "./.", ".", "1", "0/.", None, "x/y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in rows(df.select("i", call_text(parse_call(F.col("t"))).alias("gt")))]
    assert got == ["0/1", "1|2", None, None, "1", None, None, None]


@pytest.fixture(scope="module")
def cohort(spark):
    sites = [("1", 100, ["A", "C"]), ("1", 200, ["A", "C", "G"]), ("X", 50, ["T"]), ("X", 60, ["T", "A"]),
             ("2", 10, ["G", "T"])]
    calls = [
        ("1", 100, "s1", call(0, 1), [0, 1], 50, 10), ("1", 100, "s2", call(1, 1), [0, 1], 60, 20),
        ("1", 100, "s3", None, [0, 1], 0, 0),  # hides the block under it
        ("1", 200, "s1", call(1, 1), [0, 2], 40, 8), ("1", 200, "s2", call(1, 2), [0, 2, 1], 40, 8),
        ("X", 60, "s1", call(1), [0, 1], 30, 4), ("X", 60, "s2", call(0, 1), [0, 1], 30, 4),
    ]
    blocks = [
        ("s3", "1", 90, 110, 20, 5), ("s4", "1", 100, 100, 30, 6), ("s3", "1", 150, 200, 20, 5),
        ("s4", "1", 201, 300, 20, 5), ("s3", "X", 1, 60, 10, None),
    ]
    return (
        spark.createDataFrame(sites, SITES), spark.createDataFrame(calls, CALLS),
        spark.createDataFrame(blocks, REF_BLOCKS),
        spark.createDataFrame([(f"s{i}",) for i in range(1, 6)], "sample_id string"),
    )


def test_statistics(cohort):
    sites, calls, blocks, _ = cohort
    qc = {(r.contig, r.pos): r.variant_qc for r in call_statistics(sites, calls, blocks).collect()}
    a = qc["1", 100]
    assert (a.AC, a.AN, a.homozygote_count, a.n_called) == ([3, 3], 6, [1, 1], 3)
    assert a.AF == [0.5, 0.5]
    b = qc["1", 200]
    assert (b.AC, b.AN, b.homozygote_count, b.n_het) == ([2, 1, 3], 6, [1, 0, 1], 1)
    c = qc["X", 50]
    assert (c.AC, c.AN, c.AF) == ([2], 2, [1.0])
    d = qc["X", 60]  # a haploid call adds one to AN and is not homozygous
    assert (d.AC, d.AN, d.homozygote_count) == ([3, 2], 5, [1, 0])
    e = qc["2", 10]
    assert (e.AC, e.AN, e.AF, e.n_called) == ([0, 0], 0, [None, None], 0)


def test_sum_of_counts_is_an(cohort):
    for r in call_statistics(*cohort[:3]).collect():
        assert sum(r.variant_qc.AC) == r.variant_qc.AN


def test_disjoint_blocks_give_the_same(cohort, rows):
    from lociweave.operators.blocks import carve_blocks

    sites, calls, blocks, _ = cohort
    carved = carve_blocks(blocks, calls).drop("bin")
    assert rows(call_statistics(sites, calls, carved, blocks_disjoint=True)) == rows(
        call_statistics(sites, calls, blocks))


def test_dense_entries(cohort, rows):
    sites, calls, blocks, _ = cohort
    got = rows(dense_entries(sites, calls, blocks).select("contig", "pos", "sample_id", call_text(F.col("GT"))))
    assert [g for g in got if g[1] in (100, 200)] == [
        ("1", 100, "s1", "0/1"), ("1", 100, "s2", "1/1"), ("1", 100, "s3", None), ("1", 100, "s4", "0/0"),
        ("1", 200, "s1", "2/2"), ("1", 200, "s2", "2/1"), ("1", 200, "s3", "0/0"),
    ]


def test_genotype_qc(cohort):
    r = {(x.contig, x.pos): x.variant_qc for x in variant_quality(*cohort).collect()}
    a = r["1", 100]
    assert (a.n_called, a.n_not_called, a.call_rate, a.n_het, a.n_non_ref) == (3, 2, 0.6, 1, 2)
    gq, dp = [50, 60, 0, 30], [10, 20, 0, 6]
    assert isclose(a.gq_stats.mean, np.mean(gq)) and isclose(a.gq_stats.stdev, np.std(gq))
    assert isclose(a.dp_stats.stdev, np.std(dp)) and (a.dp_stats.min, a.dp_stats.max) == (0, 20)
    none = r["2", 10]
    assert (none.n_called, none.n_not_called, none.dp_stats.mean, none.dp_stats.min) == (0, 5, None, None)
    assert np.allclose([a.het_freq_hwe, a.p_value_hwe], [9 / 15, direct_mid_p(1, 1, 1)[0]])


def test_whole_quality_agrees_with_the_call_statistics(cohort):
    short = {(x.contig, x.pos): x.variant_qc.asDict() for x in call_statistics(*cohort[:3]).collect()}
    whole = {(x.contig, x.pos): x.variant_qc.asDict() for x in variant_quality(*cohort).collect()}
    assert {k: {f: v[f] for f in short[k]} for k, v in whole.items()} == short


def direct_mid_p(hom_ref, het, hom_var):
    """Mid-p values by direct binomials."""
    n, rare = hom_ref + het + hom_var, 2 * hom_var + het
    ways = {}
    for h in range(rare % 2, min(rare, 2 * n - rare) + 1, 2):
        hv = (rare - h) // 2
        ways[h] = comb(n, hv) * comb(n - hv, h) * 2**h
    total = sum(ways.values())
    seen = ways[het]
    two = sum(2 * w if w < seen else w if w == seen else 0 for w in ways.values())
    more = sum(2 * w for h, w in ways.items() if h > het) + seen
    return two / (2 * total), more / (2 * total)


TRIPLES = [
    (10, 0, 0), (0, 0, 10), (5, 5, 5), (1, 20, 1), (100, 3, 1), (0, 1, 0), (2, 1, 30), (1, 0, 1), (0, 2, 0), (3, 3, 0),
    (900, 180, 9), (400, 200, 400), (0, 1000, 0), (250, 500, 250), (600, 600, 0), (1500, 3, 40), (0, 500, 300), (700, 0, 300),
]


def test_exact_p_values(spark):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(TRIPLES)], "i int, a long, b long, c long")
    solved = df.withColumn("p", hwe_p_values(F.col("a"), F.col("b"), F.col("c")))
    got = [tuple(r.p) for r in solved.orderBy("i").collect()]
    assert np.allclose(got, [direct_mid_p(*t) for t in TRIPLES], rtol=1e-9, atol=1e-290)


def test_exact_p_values_of_none_and_of_sums_beyond_a_double(spark):
    given = [(None, 1, 1), (0, 0, 0), (20_000, 0, 20_000), (0, 40_000, 0), (12_500, 25_000, 12_500)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(given)], "i int, a long, b long, c long")
    got = [r.p for r in df.withColumn("p", hwe_p_values(F.col("a"), F.col("b"), F.col("c"))).orderBy("i").collect()]
    assert got[:2] == [None, None]
    # No heterozygote, and nothing but heterozygotes, of 40,000 samples with equal alleles; then what is expected.
    assert tuple(got[2]) == (0.0, 1.0) and max(got[3]) == 0.0
    assert np.allclose(tuple(got[4]), (1.0, 0.5), atol=0.01)


def test_exact_test_stays_in_the_jvm(spark, cohort):
    plan = variant_quality(*cohort)._jdf.queryExecution().executedPlan().toString()
    assert "p_value_hwe" in plan and "Python" not in plan


def test_hardy_weinberg(spark, cohort):
    got = {(r.contig, r.pos): r for r in hardy_weinberg(call_statistics(*cohort[:3])).collect()}
    a = got["1", 100]
    assert (a.n_hom_ref, a.n_het, a.n_hom_var) == (1, 1, 1)
    assert isclose(a.het_freq_hwe, 3 * 3 / (5 * 3))
    assert np.allclose([a.p_value_hwe, a.p_value_excess_het], direct_mid_p(1, 1, 1))
    assert got["1", 200].p_value_hwe is None and got["2", 10].p_value_hwe is None
