"""The physical plans the design relies on, with broadcasting off as at full scale unless said otherwise."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from samples import snapshot
from rollmart.operators import keyed
from rollmart.plans import checks, daily, dims, fact, marts, stage
from rollmart.schemas import STG_PUPIL
from rollmart.sources.folders import Scratch
from rollmart.sources.store import Store

FACT = "fact_pupil_attendance_daily"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def loaded(spark, raw, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    days = [f"2025/01/{n:02d}" for n in (1, 2, 3)]
    store.replace("raw_pupil", raw(*[snapshot(d, p) for d in days for p in "123"]))
    store.replace("raw_pupil_attendance", raw.marks(*[(d, p, "Present") for d in days for p in "123"]))
    daily.load_stage_and_dims(store)
    fact.load_history(store, lambda d: d.cast("string"))
    return store


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dimensions_are_broadcast_while_small(loaded):
    text = plan(fact.build_day(loaded, date(2025, 1, 2), "b"))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 6


def test_no_broadcast_is_forced(loaded, no_broadcast):
    text = plan(fact.build_day(loaded, date(2025, 1, 2), "b"))
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 6


def test_a_day_reads_one_folder_and_shuffles_by_pupil_once(loaded, no_broadcast):
    frame = fact.build_day(loaded, date(2025, 1, 2), "b")
    files = [f for f in frame.inputFiles() if "_date=" in f]
    assert files and all("_date=2025-01-02/" in f for f in files)
    # Stage, marks and the pupil dimension: one exchange each.
    assert len(re.findall(r"Exchange hashpartitioning\(pupil_id", plan(frame))) == 3


KEY, ORDER = ("pupil_id", "snapshot_date"), ("_file", "_block", "_row")


def usable_rows(store):
    return stage.clean_pupil(store.read("raw_pupil")).where(keyed.all_present(("snapshot_date", "pupil_id")))


def new_rows(store, rows, scratch):
    days = store.days("stg_pupil")
    return keyed.possibly_new(rows, store.read("stg_pupil", days), STG_PUPIL, days, True, scratch)


def test_first_load_shuffles_the_batch_once(loaded, no_broadcast):
    text = plan(keyed.first_per_key(usable_rows(loaded), KEY, ORDER))
    assert text.count("Exchange ") == 1


def test_a_refresh_without_new_keys_joins_nothing(loaded, spark):
    text = plan(new_rows(loaded, usable_rows(loaded), Scratch(spark)))
    assert "Join" not in text and "Exchange" not in text


def test_a_refresh_moves_only_new_rows(loaded, spark, raw):
    more = stage.clean_pupil(raw(*[snapshot(f"2025/01/{n:02d}", p) for n in (2, 9) for p in "1234"]))
    fresh = new_rows(loaded, more, Scratch(spark))
    # Small key sets are broadcast: the rows stay where they are until the known ones are gone.
    assert "Exchange hash" not in plan(fresh) and "BroadcastHashJoin" in plan(fresh)
    got = sorted((r["snapshot_date"].day, r["pupil_id"]) for r in fresh.collect())
    assert got == [(2, 4), (9, 1), (9, 2), (9, 3), (9, 4)]


def test_a_refresh_spreads_the_copies_of_a_new_key(loaded, spark, raw, no_broadcast):
    copies = [snapshot("2025/01/02", "9", status=str(n)) for n in range(300)]
    more = stage.clean_pupil(raw(*copies, *[snapshot("2025/01/02", p) for p in "1238"]))
    fresh = new_rows(loaded, more, Scratch(spark))
    # Whole rows move by key and place, so that one key's copies go to all tasks, and only its first row is left.
    moved = [line for line in plan(fresh).splitlines() if "Exchange hash" in line]
    assert moved and all(re.search(r"_place#\d+", line) for line in moved)
    assert sorted((r["pupil_id"], r["status"]) for r in fresh.collect()) == [(8, "In"), (9, "0")]


def test_a_refresh_reads_only_the_keys_of_the_stage(loaded, no_broadcast):
    keys = usable_rows(loaded).select(*KEY).distinct()
    text = plan(keyed.unknown_keys(keys, loaded.read("stg_pupil"), KEY))
    assert re.search(r"FileScan parquet \[pupil_id#\d+L,snapshot_date#\d+\]", text)
    assert text.count("Exchange ") == 2


def test_rates_are_summed_before_any_join(loaded, no_broadcast):
    text = plan(marts.attendance_rate(*(loaded.read(n) for n in (FACT, "dim_academy", "dim_grade", "dim_date"))))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "attendance" in line)
    assert re.search(r"\[academy_key#\d+L,grade_key#\d+L,attendance#\d+,fact_date#\d+\]", scan)
    lines = text.splitlines()
    above = [line for line in lines[: lines.index(scan)] if "partial_sum(CASE" in line]
    assert above and "partial_sum(CASE" in lines[lines.index(scan) - 1]


def test_benchmarks_spread_an_academy_by_pupil(loaded, no_broadcast):
    text = plan(marts.academy_metrics(loaded.read(FACT), loaded.read("dim_academy")))
    assert re.search(r"hashpartitioning\(academy_key#\d+L, pupil_key#\d+L", text)
    assert re.search(r"hashpartitioning\(academy_name#\d+, pupil_key#\d+L", text)


def test_attribute_sets_are_hash_aggregated(loaded):
    text = plan(dims.attribute_sets(loaded.read("stg_pupil")))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_foreign_keys_scan_the_fact_once(loaded, no_broadcast):
    frame = checks.foreign_key_checks(loaded)
    assert len([line for line in plan(frame).splitlines() if "FileScan" in line and "fact_date" in line]) == 1


def test_nothing_runs_in_python(loaded):
    frames = [
        fact.build_day(loaded, date(2025, 1, 2), "b"), stage.clean_pupil(loaded.read("raw_pupil")),
        marts.academy_metrics(loaded.read(FACT), loaded.read("dim_academy")), checks.foreign_key_checks(loaded),
        fact.late_rows(loaded),
    ]
    assert not any(re.search("Python|Cartesian|NestedLoop", plan(f)) for f in frames)


def test_late_rows_do_not_cross(loaded, no_broadcast):
    assert fact.late_rows(loaded).where(F.col("pupil_id") > 0).count() == 0
