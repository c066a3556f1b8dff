"""Stored answers per gene: rebuilt where the documents or the genes changed, and nowhere else."""

from pathlib import Path

import pytest
from test_versions import docs_of, files

from lociweave.operators.lookup import variants_by_interval
from lociweave.sources import documents as D
from lociweave.sources import stored_lookups as S

MB = 1 << 20
GENES = [("g1", "1", 5, 30), ("wide", "1", 10, 3 * MB), ("far", "1", 5 * MB, 6 * MB), ("x", "X", 1, 99), ("none", "2", 1, 9)]


def genes_of(spark, rows):
    return spark.createDataFrame(rows, "gene_id string, chrom string, start long, stop long")


def same(spark, rows, store, base, genes):
    want = variants_by_interval(D.read_store(spark, store), genes_of(spark, genes), "gene_id")
    got = S.read_lookups(spark, base, "gene_id")
    assert got.columns == want.columns and rows(got) == rows(want)
    return rows(got, "gene_id", "rank", "pos")


def test_untouched_answers_stay(spark, folder, rows):
    store, base = f"{folder}/store", f"{folder}/by_gene"
    D.upsert_store(spark, store, docs_of(spark, [("1", 10, 1, 0), ("1", 20, 1, 0), ("1", 3 * MB, 1, 0), ("1", 5 * MB + 4, 1, 0), ("X", 5, 1, 0)]))
    assert S.refresh_lookups(spark, store, genes_of(spark, GENES), "gene_id", base) == 0
    told = same(spark, rows, store, base, GENES)
    assert [t for t in told if t[0] == "wide"] == [("wide", n, p) for n, p in enumerate((10, 20, 3 * MB), 1)]
    assert S.refresh_lookups(spark, store, genes_of(spark, GENES), "gene_id", base) is None
    before = files(f"{base}/rows")
    # The wide gene is at home in the first megabase and reaches the fourth.
    D.upsert_store(spark, store, docs_of(spark, [("1", 3 * MB - 1, 4, 0)]))
    version = S.refresh_lookups(spark, store, genes_of(spark, GENES), "gene_id", base)
    after = files(f"{base}/rows")
    assert {k: after[k] for k in before} == before
    assert {str(Path(k).parent) for k in after.keys() - before.keys()} == {f"v={version}/chrom=1/part=0"}
    assert ("wide", 3, 3 * MB - 1) in same(spark, rows, store, base, GENES)
    # No gene reaches this megabase: the version of the documents is noted, no answer is written.
    D.upsert_store(spark, store, docs_of(spark, [("9", 9, 4, 0)]))
    S.refresh_lookups(spark, store, genes_of(spark, GENES), "gene_id", base)
    assert files(f"{base}/rows") == after and S.refresh_lookups(spark, store, genes_of(spark, GENES), "gene_id", base) is None
    assert rows(S.read_lookup(spark, base, "gene_id", "far"), "rank", "pos") == [(1, 5 * MB + 4)]
    text = S.read_lookup(spark, base, "gene_id", "far")._jdf.queryExecution().executedPlan().toString()
    assert "part#" in text and "PartitionFilters" in text and S.read_lookup(spark, base, "gene_id", "nobody").count() == 0


def test_changed_genes_and_an_empty_store(spark, folder, rows):
    store, base = f"{folder}/store", f"{folder}/by_gene"
    with pytest.raises(FileNotFoundError):
        S.read_lookups(spark, base, "gene_id")
    S.refresh_lookups(spark, store, genes_of(spark, GENES), "gene_id", base)
    assert S.read_lookups(spark, base, "gene_id").count() == 0
    D.upsert_store(spark, store, docs_of(spark, [("1", 10, 1, 0), ("1", 5 * MB + 4, 1, 0), ("2", 5, 1, 0)]))
    S.refresh_lookups(spark, store, genes_of(spark, GENES), "gene_id", base)
    same(spark, rows, store, base, GENES)
    before = files(f"{base}/rows")
    moved = [g for g in GENES if g[0] != "far"] + [("new", "2", 1, 4 * MB)]
    version = S.refresh_lookups(spark, store, genes_of(spark, moved), "gene_id", base)
    new = {str(Path(k).parent) for k in files(f"{base}/rows").keys() - before.keys()}
    assert new == {f"v={version}/chrom=2/part=0"}
    assert {t[0] for t in same(spark, rows, store, base, moved)} == {"g1", "wide", "none", "new"}
