"""Block operators against position-by-position brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lociweave.operators.blocks import (
    block_summary_at_sites,
    carve_blocks,
    clip_to_bins,
    coverage_at_sites,
    reference_entries_at_sites,
)

BLOCKS = "sample_id string, contig string, pos int, end_pos int, gq int, dp int"
BORDER = 1 << 16


def made_up(seed, overlap=False):
    rng = random.Random(seed)
    blocks, calls, sites = [], set(), set()
    for sample in "ab":
        at = BORDER - 400
        while at < BORDER + 400:
            length = rng.randint(1, 60)
            blocks.append((sample, "1", at, at + length - 1, rng.randint(1, 99), rng.choice([None, 5, 30])))
            at += rng.randint(1, length) if overlap else length + rng.choice([0, 0, 7])
        calls |= {(sample, "1", rng.randint(BORDER - 420, BORDER + 420)) for _ in range(60)}
    sites |= {("1", rng.randint(BORDER - 450, BORDER + 450)) for _ in range(300)}
    return blocks, sorted(calls), sorted(sites)


def cover(blocks, calls=()):
    hidden = set(calls)
    out = defaultdict(list)
    for sample, contig, pos, end, gq, dp in blocks:
        for p in range(pos, end + 1):
            if (sample, contig, p) not in hidden:
                out[contig, p].append((sample, gq, dp))
    return out


def tables(spark, blocks, calls, sites):
    return (
        spark.createDataFrame(blocks, BLOCKS),
        spark.createDataFrame(calls, "sample_id string, contig string, pos int"),
        spark.createDataFrame(sites, "contig string, pos int"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_carved_pieces_cover_what_no_entry_hides(spark, rows, seed):
    blocks, calls, sites = made_up(seed)
    b, c, _ = tables(spark, blocks, calls, sites)
    pieces = rows(carve_blocks(b, c).drop("bin"), "sample_id", "contig", "pos", "end_pos", "gq", "dp")
    assert cover(pieces) == {k: v for k, v in cover(blocks, calls).items()} or (
        {k: sorted(v, key=repr) for k, v in cover(pieces).items()}
        == {k: sorted(v, key=repr) for k, v in cover(blocks, calls).items()}
    )


def test_overlapping_blocks_come_out_disjoint(spark, rows):
    blocks, calls, sites = made_up(3, overlap=True)
    b, c, _ = tables(spark, blocks, calls, sites)
    got = cover(rows(carve_blocks(b, c), "sample_id", "contig", "pos", "end_pos", "gq", "dp"))
    want = cover(blocks, calls)
    assert {k: sorted(s for s, *_ in v) for k, v in got.items()} == {
        k: sorted({s for s, *_ in v}) for k, v in want.items()
    }


def test_sweep_counts_blocks_over_each_site(spark, rows):
    blocks, calls, sites = made_up(4)
    b, _, s = tables(spark, blocks, calls, sites)
    want = cover(blocks)
    assert rows(coverage_at_sites(s, clip_to_bins(b))) == sorted(
        ((c, p, len(want[c, p])) for c, p in sites), key=repr
    )


def test_block_edges(spark, rows):
    b = spark.createDataFrame([("a", "1", 10, 20, 30, 5), ("a", "1", 21, 30, 31, 6), ("a", "2", 5, 4, 1, 1)], BLOCKS)
    s = spark.createDataFrame([("1", p) for p in (9, 10, 20, 21, 30, 31)] + [("2", 5)], "contig string, pos int")
    assert [r[2] for r in rows(coverage_at_sites(s, clip_to_bins(b)).orderBy("contig", "pos"))]
    assert dict(((c, p), n) for c, p, n in rows(coverage_at_sites(s, clip_to_bins(b)))) == {
        ("1", 9): 0, ("1", 10): 1, ("1", 20): 1, ("1", 21): 1, ("1", 30): 1, ("1", 31): 0, ("2", 5): 0,
    }


def test_summary_and_entries_agree_with_brute_force(spark, rows):
    blocks, calls, sites = made_up(5)
    b, c, s = tables(spark, blocks, calls, sites)
    want = cover(blocks, calls)
    pieces = carve_blocks(b, c)
    entries = rows(reference_entries_at_sites(s, pieces))
    assert entries == sorted(((c_, p, *e[:1], *e[1:]) for c_, p in sites for e in want[c_, p]), key=repr)
    got = {(r.contig, r.pos): r for r in block_summary_at_sites(s, pieces).collect()}
    assert set(got) == {k for k in sites if want[k]}
    for key, r in got.items():
        gqs = [gq for _, gq, _ in want[key]]
        dps = [dp for _, _, dp in want[key] if dp is not None]
        assert (r.n_ref, r.gq_sum, r.gq_sq, r.gq_min, r.gq_max) == (
            len(gqs), sum(gqs), sum(g * g for g in gqs), min(gqs), max(gqs))
        assert (r.dp_n, r.dp_min, r.dp_max) == (len(dps), min(dps, default=None), max(dps, default=None))


def test_long_block_over_many_bins(spark):
    b = spark.createDataFrame([("a", "1", 5, 10 * BORDER + 7, 30, 5)], BLOCKS)
    pieces = clip_to_bins(b)
    assert pieces.count() == 11
    assert pieces.agg(F.sum(F.col("end_pos") - F.col("pos") + 1)).first()[0] == 10 * BORDER + 3


def measured(spark):
    """Blocks and sites whose sizes Spark knows, below its limit for a broadcast."""
    blocks = spark.sql("select concat('s', id) as sample_id, '1' as contig, cast(id * 100 as int) as pos, "
                       "cast(id * 100 + 90 as int) as end_pos, 30 as gq, 5 as dp from range(50)")
    return blocks, spark.sql("select '1' as contig, cast(id * 7 as int) as pos from range(500)")


def test_entries_do_not_broadcast_the_listed_sites(spark):
    blocks, sites = measured(spark)
    found = reference_entries_at_sites(sites, clip_to_bins(blocks))
    assert found.count() == sum(1 for i in range(500) if 7 * i < 5000 and 7 * i % 100 <= 90)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_summary_does_not_broadcast_the_listed_sites(spark):
    blocks, sites = measured(spark)
    found = block_summary_at_sites(sites, clip_to_bins(blocks))
    assert found.agg(F.sum("n_ref")).first()[0] == sum(1 for i in range(500) if 7 * i < 5000 and 7 * i % 100 <= 90)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
