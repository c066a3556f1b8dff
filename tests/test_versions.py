"""Document versions by megabase and site lists by touched locus."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_end_to_end import line, write_gvcf

from lociweave.operators.combine import latest_sites, sites_at
from lociweave.operators.documents import as_declared, upsert_documents
from lociweave.plans.ingest import IngestFolders, completed_runs, ingest, latest_cohort
from lociweave.sources import documents as D
from lociweave.sources import tables

DDL = "variant_id string, chrom string, pos int, ref string, alt string, ac long, written int"


def docs_of(spark, rows):
    return spark.createDataFrame([(f"{c}-{p}-A-C", c, p, "A", "C", ac, w) for c, p, ac, w in rows], DDL)


def files(base):
    return {str(p.relative_to(base)): p.stat().st_mtime_ns for p in Path(base).rglob("*.parquet")}


def test_only_touched_megabases_are_written(spark, folder, rows):
    base = f"{folder}/store"
    assert D.read_store(spark, base).count() == 0
    first = docs_of(spark, [("1", 10, 1, 0), ("1", 20, 1, 0), ("1", 3 << 20, 1, 0), ("X", 5, 1, 0)])
    assert D.upsert_store(spark, base, first) == 0
    before = files(f"{base}/rows")
    second = docs_of(spark, [("1", 20, 7, 1), ("1", 20, 9, 3), ("1", 20, 8, 2), ("1", 30, 2, 1)])
    assert D.upsert_store(spark, base, second, "written") == 1
    after = files(f"{base}/rows")
    assert {k: after[k] for k in before} == before
    assert {os.path.dirname(k) for k in after.keys() - before.keys()} == {"v=1/chrom=1/part=0"}
    want = upsert_documents(as_declared(first), as_declared(docs_of(spark, [("1", 20, 9, 3), ("1", 30, 2, 1)])))
    assert rows(D.read_store(spark, base)) == rows(want)
    assert rows(D.read_store(spark, base), "pos", "ac") == [(10, 1), (20, 9), (30, 2), (3145728, 1), (5, 1)]
    # Twice the same is the same; a version of another megabase leaves this one alone.
    D.upsert_store(spark, base, second, "written")
    D.upsert_store(spark, base, docs_of(spark, [("X", 5, 4, 0)]))
    assert rows(D.read_store(spark, base), "pos", "ac") == [(10, 1), (20, 9), (30, 2), (3145728, 1), (5, 4)]


def test_untouched_folders_are_pruned_and_nothing_current_is_exchanged(spark, folder):
    base = f"{folder}/store"
    D.upsert_store(spark, base, docs_of(spark, [(str(c), p << 20, 1, 0) for c in range(1, 6) for p in range(4)]))
    D.upsert_store(spark, base, docs_of(spark, [("1", 0, 2, 0)]))
    stored = D.stored_rows(spark, base)
    text = stored._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text and "Exchange hashpartitioning(v" not in text
    touched = spark.createDataFrame([("1", 0)], "chrom string, part int")
    kept = stored.join(F.broadcast(touched), ["chrom", "part"], "left_semi").join(
        F.broadcast(spark.createDataFrame([("1-0-A-C",)], "variant_id string")), "variant_id", "left_anti")
    text = kept._jdf.queryExecution().executedPlan().toString()
    # What is exchanged is the list of live megabases, grouped by megabase.
    assert "Exchange hashpartitioning(variant_id" not in text
    assert kept.count() == 0


def test_overtaken_version_is_made_again(spark, folder, rows, monkeypatch):
    base, create, others = f"{folder}/store", D.create_once, []
    D.upsert_store(spark, base, docs_of(spark, [("1", 10, 1, 0)]))

    def late(spark, path, text=""):
        if "/commits/" in path and not others:
            others.append(True)
            D.upsert_store(spark, base, docs_of(spark, [("1", 20, 2, 0)]))
        return create(spark, path, text)

    monkeypatch.setattr(D, "create_once", late)
    D.upsert_store(spark, base, docs_of(spark, [("1", 30, 3, 0)]))
    assert rows(D.read_store(spark, base), "pos", "ac") == [(10, 1), (20, 2), (30, 3)]


def test_half_a_version_does_not_count(spark, folder, rows, monkeypatch):
    base = f"{folder}/store"
    D.upsert_store(spark, base, docs_of(spark, [("1", 10, 1, 0)]))

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(D, "create_once", lost)
    with pytest.raises(RuntimeError):
        D.upsert_store(spark, base, docs_of(spark, [("1", 10, 9, 0)]))
    monkeypatch.undo()
    assert rows(D.read_store(spark, base), "pos", "ac") == [(10, 1)]
    D.upsert_store(spark, base, docs_of(spark, [("1", 10, 5, 0)]))
    assert rows(D.read_store(spark, base), "pos", "ac") == [(10, 5)]


def test_same_document_stays_on_every_run(spark):
    incoming = docs_of(spark, [("1", 10, 1, 0), ("1", 10, 3, 0), ("1", 10, 2, 0)])
    got = {upsert_documents(as_declared(incoming).limit(0), as_declared(incoming.repartition(n, "ac"))).first().ac for n in (1, 2, 3)}
    assert got == {3}


def test_a_run_writes_the_loci_it_touches(spark, folder, rows):
    root, path = f"{folder}/cohort", f"{folder}/gvcf"
    write_gvcf(path, "s0", [line("chr1", 100 + i, "A", "C,<NON_REF>", "0/1") for i in range(300)] + [line("chr2", 7, "G", "T,<NON_REF>", "0/1")])
    ingest(spark, path, root, "2026-03-11")
    want = {("1", 100 + i): ["A", "C"] for i in range(300)} | {("2", 7): ["G", "T"]}
    base = f"{root}/cohort"
    for n in range(1, 4):
        write_gvcf(path, f"s{n}", [line("chr1", 100 + n, "A", "G,<NON_REF>", "0/1"), line("chr3", n, "A", "T,<NON_REF>", "1/1")])
        run = ingest(spark, path, root, "2026-03-11")
        assert spark.read.parquet(f"{root}/cohort/sites/run_id={run}").count() == 2
        want[("1", 100 + n)] = ["A", "C", "G"]
        want[("3", n)] = ["A", "T"]
        cohort = latest_cohort(spark, IngestFolders(root))
        assert {(r.contig, r.pos): r.alleles for r in cohort.sites.collect()} == want
        if n == 2:
            # Three runs so far: a whole list is written, and the next run comes on top of it.
            runs = completed_runs(spark, IngestFolders(root))
            assert not tables.compact_sites(spark, base, runs, after=4) and tables.compact_sites(spark, base, runs, after=3)
            assert not tables.compact_sites(spark, base, runs, after=1)
            assert {(r.contig, r.pos): r.alleles for r in tables.read_cohort(spark, base, runs).sites.collect()} == want
    runs = completed_runs(spark, IngestFolders(root))
    assert [r for r in runs if os.path.exists(f"{base}/sites_full/run_id={r}")] == [runs[2]]
    # Earlier versions stay as they were.
    assert tables.read_cohort(spark, f"{root}/cohort", runs[:2]).sites.filter("pos = 102").first().alleles == ["A", "C"]
    assert {r.LA[1] for r in cohort.calls.filter("pos = 101 and sample_id = 's1'").collect()} == {2}


def test_sites_far_away_are_neither_read_on_nor_shuffled(spark):
    sites = spark.createDataFrame([("1", i << 18, ["A", "C"], []) for i in range(64)] + [("2", 5, ["A", "C"], [])],
                                  "contig string, pos int, alleles array<string>, rsids array<string>")
    records = spark.createDataFrame([("1", 1 << 18), ("1", 77), ("1", 1 << 18)], "contig string, pos int")
    near = sites_at(sites, records)
    assert [(r.contig, r.pos) for r in near.collect()] == [("1", 1 << 18)]
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "span" in text
    both = sites.withColumn("nth", F.lit(0)).unionByName(
        spark.createDataFrame([("2", 5, ["A", "C", "G"], ["rs1"], 1)], "contig string, pos int, alleles array<string>, rsids array<string>, nth int"))
    assert latest_sites(both, "nth").filter("contig = '2'").first().alleles == ["A", "C", "G"]
    assert latest_sites(both, "nth").count() == 65
