"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs to its last row (noop sink) and derives its cohort from the
given tables first. ``stored`` times the same work on a written cohort, as a
real one is: statistics in calls per second, document export in documents
per second. A small query and one export warm the JVM up and are not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conformance.queries import QUERIES  # noqa: E402
from conformance.shapes import Given  # noqa: E402
from lociweave.operators.blocks import carve_blocks  # noqa: E402
from lociweave.operators.callstats import call_statistics  # noqa: E402
from lociweave.operators.combine import Cohort  # noqa: E402
from lociweave.plans.export import export_annotated  # noqa: E402
from lociweave.session import build_session  # noqa: E402
from lociweave.sources import tables  # noqa: E402

HEADLINE = [
    "variant_call_stats", "block_coverage", "genotype_qc", "densify", "join_frequency", "flatten_vep",
    "docs_annotated", "docs_basic", "report_full", "combine_calls", "combine_incremental",
    "variants_by_gene", "variants_by_transcript", "region_counts", "lookup_many", "gene_summary", "hwe_p_values",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def to_last_row(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stored_rates(spark, sf_dir: str) -> dict[str, float]:
    """Rates on a cohort and a variant table written to a fresh folder."""
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    given = Given(spark, sf_dir)
    carved = carve_blocks(given.blocks, given.calls).drop("bin")
    tables.write_standalone(Cohort(given.sites, given.calls, carved, given.samples), f"{out}/cohort")
    tables.write_annotated(given.annotated, f"{out}/variants")
    cohort = tables.read_standalone(spark, f"{out}/cohort")
    variants = tables.read_annotated(spark, f"{out}/variants")
    n_calls, n_docs = cohort.calls.count(), variants.count()
    export_annotated(variants, f"{out}/docs")
    stats = timed(lambda: to_last_row(
        call_statistics(cohort.sites, cohort.calls, cohort.ref_blocks, blocks_disjoint=True)))
    export = timed(lambda: export_annotated(variants, f"{out}/docs"))
    return {"calls_per_sec": round(n_calls / stats), "docs_per_sec": round(n_docs / export)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    to_last_row(QUERIES["block_coverage"](spark, sf_dir))
    times = {name: round(timed(lambda n=name: to_last_row(QUERIES[n](spark, sf_dir))), 3) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "stored": stored_rates(spark, sf_dir), "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
