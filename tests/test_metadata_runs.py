"""Metadata rules and the run log."""

import itertools

import pytest

from lociweave.operators import metadata as M
from lociweave.operators import runs as R


def test_metadata_join_keeps_samples(spark, rows):
    samples = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    meta = spark.createDataFrame([("a", "F"), ("a", "M"), ("z", "F")], "sample_id string, sex string")
    assert rows(M.join_metadata(samples, meta)) == [("a", "F"), ("b", None)]
    assert M.join_metadata(samples, None) is samples


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_typos_are_all_pairs_at_distance_one(spark, rows):
    texts = ["".join(t) for n in range(4) for t in itertools.product("AB", repeat=n)]
    unknown = spark.createDataFrame([(t,) for t in texts[::2]], "sample_id string")
    known = spark.createDataFrame([(t,) for t in texts[1::2]], "sample_id string")
    want = sorted(((a, b) for a in texts[::2] for b in texts[1::2] if distance(a, b) == 1), key=repr)
    assert rows(M.likely_typos(unknown, known)) == want


def test_dates(spark, rows):
    df = spark.createDataFrame([("3/7/24",), ("13/45/24",), (None,), ("12/31/99",), ("x",)], "date_seq string")
    got = rows(M.normalize_dates(df))
    assert {(t, str(d) if d else None, b) for t, d, b in got} == {
        ("3/7/24", "2024-03-07", False), ("13/45/24", None, True), (None, None, False),
        ("12/31/99", "2099-12-31", False), ("x", None, True)}


def test_required_columns(spark):
    assert M.missing_columns(spark.createDataFrame([("a", "F")], "sample_id string, sex string")) == [
        "age", "date_seq", "run_id", "care_site", "health_status"]


def runs(spark, *ids):
    return spark.createDataFrame([(r, i, "completed") for i, r in enumerate(ids)], "run_id string, seq long, status string")


@pytest.mark.parametrize("ids, expected", [
    ((), "2026-03-11_run001"),
    (("2026-03-11_run001", "2026-03-11_run007", "2026-03-10_run900"), "2026-03-11_run008"),
    (("2026-03-11_run999",), "2026-03-11_run1000"),
    (("2026-03-11_run1000", "2026-03-11_runx", "2026-03-11_run"), "2026-03-11_run1001"),
])
def test_next_run_id(spark, ids, expected):
    assert R.next_run_id(runs(spark, *ids), "2026-03-11").first().run_id == expected


def test_latest_is_by_list_order(spark):
    log = runs(spark, "2026-03-12_run001", "2026-03-11_run001")
    assert R.latest_run(log, R.COMPLETED).first().run_id == "2026-03-11_run001"
    assert R.latest_run(log, R.IN_PROGRESS).isEmpty()


def test_files_of_failed_runs_stay_open(spark, rows):
    log = spark.createDataFrame([("r1", 0, "completed"), ("r2", 1, "failed"), ("r3", 2, "in_progress")],
                                "run_id string, seq long, status string")
    files = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", "c"), ("r1", "d")], "run_id string, gvcf string")
    listed = spark.createDataFrame([(f,) for f in "abcde"], "gvcf string")
    assert rows(R.ingested_files(log, files)) == [("a",), ("d",)]
    assert rows(R.new_files(listed, log, files)) == [("b",), ("c",), ("e",)]


def test_state_is_the_last_event_in_first_seen_order(spark, rows):
    events = spark.createDataFrame(
        [("r1", 1, "in_progress"), ("r2", 2, "in_progress"), ("r1", 3, "failed"), ("r2", 4, "completed")],
        "run_id string, seq long, status string")
    assert rows(R.run_states(events)) == [("r1", 1, "failed"), ("r2", 2, "completed")]
