"""Files in, lookups out: ingest in two runs, annotate, export, look up."""

import gzip
import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lociweave.operators import lookup as L
from lociweave.operators import runs as R
from lociweave.operators.annotate import with_variant_key
from lociweave.plans import annotate as annotate_plan
from lociweave.plans import export
from lociweave.plans.ingest import IngestFolders, ingest, latest_cohort
from lociweave.schemas import CONSEQUENCE
from lociweave.sources import documents as doc_io
from lociweave.sources import tables, vcf
from lociweave.streaming.file_ingest import file_status, ingest_new_files, status_with_skipped

HEADER = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{sample}\n"


def line(contig, pos, ref, alt, gt, ident=".", info=".", gq=40, dp=12):
    return f"{contig}\t{pos}\t{ident}\t{ref}\t{alt}\t.\t.\t{info}\tGT:DP:GQ\t{gt}:{dp}:{gq}\n"


def write_gvcf(folder, sample, lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    whole = HEADER.format(sample=sample) + "".join(lines)
    half = len(whole) // 2
    # two gzip members, as block compression writes many
    Path(folder, f"{sample}.gvcf.gz").write_bytes(gzip.compress(whole[:half].encode()) + gzip.compress(whole[half:].encode()))


@pytest.fixture
def gvcfs(folder):
    path = f"{folder}/gvcf"
    write_gvcf(path, "s1", [
        line("chr1", 1, "N", "<NON_REF>", "0/0", info="END=99"),
        line("chr1", 100, "A", "C,<NON_REF>", "0/1", ident="rs5"),
        line("chr1", 101, "G", "<NON_REF>", "0/0", info="DP=3;END=300", gq=20),
        line("chrM", 10, "A", "C,<NON_REF>", "1/1"),
        line("chrX", 10, "A", "T,<NON_REF>", "1"),
    ])
    write_gvcf(path, "s2", [
        line("chr1", 50, "A", "<NON_REF>", "0/0", info="END=99"),
        line("chr1", 100, "AT", "A,<NON_REF>", "1/1"),
        line("chr1", 200, "C", "G,<NON_REF>", "./."),
    ])
    return path


def add_second_batch(path):
    write_gvcf(path, "s3", [line("chr1", 100, "A", "G,<NON_REF>", "0|1"), line("chr1", 150, "T", "<NON_REF>", "0/0", info="END=260")])
    write_gvcf(path, "s4", [])
    write_gvcf(path, "bad", [line("chr1", 100, "A", "G,<NON_REF>", "0/1"), "chr1\tnot-a-position\n"])


def test_scan(spark, gvcfs, rows):
    got = rows(vcf.read_gvcf(spark, gvcfs).filter("sample_id = 's1'").orderBy("pos"),
               "raw_contig", "pos", "end_pos", "rsids", "ref", "alts", "gq", "dp")
    assert len(got) == 5
    assert ("chr1", 101, 300, None, "G", ["<NON_REF>"], 20, 12) in got
    assert ("chr1", 100, None, ["rs5"], "A", ["C", "<NON_REF>"], 40, 12) in got


def test_stream_reads_each_file_once(spark, gvcfs, folder, rows):
    out, checkpoint = f"{folder}/staging", f"{folder}/cp"
    ingest_new_files(spark, gvcfs, out, checkpoint)
    read = lambda: spark.read.parquet(f"{out}/records").filter("not is_end").count()
    before = read()
    ingest_new_files(spark, gvcfs, out, checkpoint)
    assert read() == before == 8 + 2
    add_second_batch(gvcfs)
    long_ago = time.time() - 30 * 86400
    os.utime(f"{gvcfs}/s3.gvcf.gz", (long_ago, long_ago))
    ingest_new_files(spark, gvcfs, out, checkpoint, max_files_per_batch=2)
    status = file_status(spark, out)
    assert rows(status, "gvcf", "status", "n_records", "error") == [
        ("bad.gvcf.gz", "failed", 2, "1 malformed lines"), ("s1.gvcf.gz", "done", 5, None),
        ("s2.gvcf.gz", "done", 3, None), ("s3.gvcf.gz", "done", 2, None), ("s4.gvcf.gz", "done", 0, None)]
    summary = R.ingest_summary(status_with_skipped(status, since_batch=1)).first()
    assert (summary.total, summary.successful, summary.new, summary.skipped, summary.failed) == (5, 4, 2, 2, 1)
    assert [r.gvcf for r in R.first_failures(status).collect()] == ["bad.gvcf.gz"]


def test_whole_path(spark, gvcfs, folder, rows):
    root = f"{folder}/cohort"
    first = ingest(spark, gvcfs, root, "2026-03-11")
    assert first == "2026-03-11_run001"
    assert ingest(spark, gvcfs, root, "2026-03-11") is None
    old = latest_cohort(spark, IngestFolders(root))
    assert rows(old.samples) == [("s1",), ("s2",)]
    add_second_batch(gvcfs)
    assert ingest(spark, gvcfs, root, "2026-03-12") == "2026-03-12_run001"

    cohort = latest_cohort(spark, IngestFolders(root))
    assert rows(cohort.samples) == [("s1",), ("s2",), ("s3",), ("s4",)]
    assert rows(cohort.sites, "contig", "pos", "alleles") == [
        ("1", 100, ["AT", "A", "CT", "GT"]), ("1", 200, ["C", "G"]), ("X", 10, ["A", "T"])]
    # the first version is still there, as it was
    assert rows(tables.read_cohort(spark, f"{root}/cohort", [first]).sites, "contig", "pos", "alleles")[0] == (
        "1", 100, ["AT", "A", "CT"])
    events, files = tables.read_run_log(spark, f"{root}/run_log")
    states = R.run_states(events)
    assert rows(states, "run_id", "status", "n_samples") == [
        ("2026-03-11_run001", "completed", 2), ("2026-03-12_run001", "completed", 4)]
    assert R.ingested_files(states, files).count() == 4

    # annotate
    keyed = with_variant_key(cohort.sites)
    vep = keyed.filter("pos = 100").select(
        "contig", "pos", "ref", "alt",
        F.from_json(F.lit(json.dumps({"transcript_consequences": [
            {"consequence_terms": ["stop_gained"], "impact": "HIGH", "gene_symbol": "G1"}]})), CONSEQUENCE).alias("vep"))
    clinical = spark.createDataFrame([("1", 200, "C", "G", "Benign", None)],
                                     "contig string, pos int, ref string, alt string, clnsig string, clnrevstat string")
    scores = spark.createDataFrame([("1", 100, "AT", "A", 20.5, 0.4)],
                                   "contig string, pos int, ref string, alt string, cadd_phred double, cadd_raw double")
    sites_vcf = f"{folder}/freq.vcf.gz"
    Path(sites_vcf).write_bytes(gzip.compress((
        "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
        "1\t200\trs9\tC\tG\t.\t.\tAC=1;AF=0.25,0.1;AF_nfe=.\n"
        "1\t999999999\t.\tC\tG\t.\t.\tAF=0.5\n"
        "zz\t5\t.\tC\tG\t.\t.\tAF=0.5\n").encode()))
    frequency = annotate_plan.load_frequency(spark, f"{folder}/freq", sites_vcf)
    assert rows(frequency, "contig", "pos", "alleles", "af", "af_nfe") == [("1", 200, ["C", "G"], 0.25, None)]
    assert annotate_plan.load_frequency(spark, f"{folder}/freq", None).count() == 1
    with pytest.raises(FileNotFoundError):
        annotate_plan.load_frequency(spark, f"{folder}/other", f"{folder}/missing.vcf.gz")

    csv = f"{folder}/meta.csv"
    Path(csv).write_text("sample_id,sex,age,extra\ns1,F,,1\ns2,,40,2\nzz,M,1,3\n")
    metadata = tables.read_metadata(spark, csv)
    assert set(dict(metadata.dtypes).values()) == {"string"}
    assert rows(metadata.filter("sample_id = 's1'")) == [("s1", "F", None, "1")]
    size = annotate_plan.annotate(cohort, vep, clinical, scores, frequency, f"{folder}/ann", metadata)
    assert tuple(size.first()) == (3, 4)
    with pytest.raises(Exception, match="(?i)exist"):
        annotate_plan.annotate(cohort, vep, clinical, scores, frequency, f"{folder}/ann", metadata)
    samples = spark.read.parquet(f"{folder}/ann/samples")
    assert rows(samples, "sample_id", "age") == [("s1", None), ("s2", "40"), ("s3", None), ("s4", None)]

    # export and look up
    variants = tables.read_annotated(spark, f"{folder}/ann/variants")
    assert export.export_annotated(variants, f"{folder}/docs") == 3
    docs = doc_io.read_documents(spark, f"{folder}/docs")
    hit = L.fetch_variant(docs, "1-100-AT-A")
    # s1 0/1 (CT), s2 1/1 (A), s3 0/1 (GT)
    assert (hit.exome.ac, hit.exome.an, hit.exome.homozygote_count, hit.rsids) == (2, 6, 1, ["rs5"])
    assert L.fetch_variant(docs, "rs5").variant_id == "1-100-AT-A"
    full = docs.filter("pos = 100").first()
    assert (full.gene_symbol, full.consequence, full.cadd_score, full.clinvar_sig) == ("G1", "stop_gained", 20.5, None)
    two = docs.filter("pos = 200").first()
    # s1 and s3 have a block over 200, s2 an explicit no-call
    assert (two.ac_total, two.an_total, two.gnomad_af, two.clinvar_sig) == (0, 4, 0.25, "Benign")
    x = docs.filter("chrom = 'X'").first()
    assert (x.ac_total, x.an_total, x.hom_count) == (1, 1, 0)

    assert export.export_basic(cohort, f"{folder}/basic") == 3
    basic = doc_io.read_documents(spark, f"{folder}/basic")
    assert rows(basic, "variant_id", "ac", "an") == rows(docs, "variant_id", "ac_total", "an_total")

    genes = spark.createDataFrame([("g1", "1", 90, 200), ("g2", "2", 1, 9)], "gene_id string, chrom string, start long, stop long")
    export.store_lookups(spark, f"{folder}/docs", genes, genes.withColumnRenamed("gene_id", "transcript_id"), f"{folder}/stored")
    stored = doc_io.read_interval(spark, f"{folder}/stored/variants_by_gene", "gene_id", "g1")
    assert [r.variant_id for r in stored.collect()] == ["1-100-AT-A", "1-200-C-G"]
    with pytest.raises(FileNotFoundError):
        doc_io.read_interval(spark, f"{folder}/stored/nothing", "gene_id", "g1")

    doc_io.write_bulk_text(docs, "cohort_variants", f"{folder}/bulk")
    assert spark.read.text(f"{folder}/bulk").count() == 6
    newer = docs.filter("pos = 100").withColumn("ac_total", F.lit(9).cast("long"))
    assert doc_io.upsert_into(spark, f"{folder}/docs", newer, f"{folder}/docs2") == 3
    assert rows(doc_io.read_documents(spark, f"{folder}/docs2"), "pos", "ac_total") == [(10, 1), (100, 9), (200, 0)]
    doc_io.ensure_documents(spark, f"{folder}/empty")
    doc_io.ensure_documents(spark, f"{folder}/docs2")
    assert doc_io.read_documents(spark, f"{folder}/empty").count() == 0
    assert doc_io.read_documents(spark, f"{folder}/docs2").count() == 3


def test_failed_and_interrupted_runs(spark, gvcfs, folder, rows, monkeypatch):
    root = f"{folder}/cohort"
    folders = IngestFolders(root)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "write_cohort_run", broken)
    with pytest.raises(RuntimeError, match="lost"):
        ingest(spark, gvcfs, root, "2026-03-11")
    monkeypatch.undo()
    assert latest_cohort(spark, folders) is None
    # a run found in progress is done again under its own id, with its own files
    events, _ = tables.read_run_log(spark, folders.log)
    assert rows(R.run_states(events), "status") == [("failed",)]
    spark.createDataFrame([("2026-03-11_run005", "s1.gvcf.gz")], "run_id string, gvcf string").write.mode("append").parquet(
        f"{folders.log}/files")
    tables.append_run_event(spark, folders.log, "2026-03-11_run005", 10, R.IN_PROGRESS)
    assert ingest(spark, gvcfs, root, "2026-03-11") == "2026-03-11_run005"
    assert rows(latest_cohort(spark, folders).samples) == [("s1",)]
    assert ingest(spark, gvcfs, root, "2026-03-11") == "2026-03-11_run006"
    assert rows(latest_cohort(spark, folders).samples) == [("s1",), ("s2",)]


def test_repeated_sample_is_refused(spark, gvcfs, folder):
    root = f"{folder}/cohort"
    ingest(spark, gvcfs, root, "2026-03-11")
    folders = IngestFolders(root)
    spark.createDataFrame([("r9", "s1.gvcf.gz")], "run_id string, gvcf string").write.mode("append").parquet(f"{folders.log}/files")
    tables.append_run_event(spark, folders.log, "r9", 10, R.IN_PROGRESS)
    with pytest.raises(ValueError, match="already in the cohort"):
        ingest(spark, gvcfs, root, "2026-03-11")


def test_standalone_cohort(spark, gvcfs, folder, rows):
    ingest(spark, gvcfs, f"{folder}/cohort", "2026-03-11")
    cohort = latest_cohort(spark, IngestFolders(f"{folder}/cohort"))
    tables.write_standalone(cohort, f"{folder}/alone")
    again = tables.read_standalone(spark, f"{folder}/alone")
    for name in ("sites", "calls", "ref_blocks", "samples"):
        a, b = getattr(cohort, name), getattr(again, name)
        assert rows(a, *sorted(a.columns)) == rows(b, *sorted(a.columns))
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_standalone(cohort, f"{folder}/alone")


def test_manifest(spark, folder, rows):
    runs, files = tables.read_manifest(spark, f"{folder}/none.json")
    assert runs.count() == 0 and files.count() == 0
    path = f"{folder}/m.json"
    Path(path).write_text(json.dumps({"version": 1, "runs": [
        {"run_id": "d_run001", "vds_path": "/a", "temp_path": "/t", "status": "completed",
         "started_at": "2026-03-11T14:30:00", "completed_at": "2026-03-11T18:45:00", "n_samples": 2, "gvcfs": ["a", "b"]},
        {"run_id": "d_run002", "vds_path": "/b", "temp_path": "/t", "status": "in_progress",
         "started_at": "2026-03-12T14:30:00", "gvcfs": ["c"]}]}, indent=2))
    runs, files = tables.read_manifest(spark, path)
    assert rows(runs, "run_id", "seq", "status", "n_samples") == [("d_run001", 0, "completed", 2), ("d_run002", 1, "in_progress", None)]
    assert rows(R.ingested_files(runs, files)) == [("a",), ("b",)]
    assert R.latest_run(runs, R.COMPLETED).first().cohort_path == "/a"
    Path(path).write_text("{}")
    assert tables.read_manifest(spark, path)[0].count() == 0
