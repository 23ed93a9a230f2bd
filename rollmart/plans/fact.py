"""Stage and dimensions to the daily fact, one whole day per load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.keyed import first_per_key, unknown_keys
from ..schemas import DIM_DATE, DIM_PUPIL, FACT, MART_RATE, STATES, STG_ATTENDANCE, STG_PUPIL
from ..sources.store import Store

STRICT, NEXT_AVAILABLE = "strict", "next_available"
# Fixed value: label of the load summary.
SUMMARY_LABEL = "INCREMENTAL LOAD RESULT"
# Which of several rows with one key comes first: the members that were numbered first.
FIRST = ("academy_key", "grade_key", "stream_key", "status", "attendance")


@dataclass(frozen=True)
class LoadResult:
    batch_id: str
    target: date | None
    inserted: int
    stalled: bool
    ignored: int = 0


def target_date(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """One row: the first calendar date while the fact is empty, else the day after its last one."""
    days = fact.select(F.col("fact_date").alias("loaded"), F.lit(None).cast("date").alias("known")).unionByName(
        dates.select(F.lit(None).cast("date").alias("loaded"), F.col("date").alias("known"))
    )
    bounds = days.agg(F.max("loaded").alias("last"), F.min("known").alias("first"))
    target = F.when(F.col("last").isNull(), F.col("first")).otherwise(F.date_add("last", 1))
    return bounds.select(target.alias("target_date"))


def with_keys(
    joined: DataFrame, dates: DataFrame, pupils: DataFrame, academies: DataFrame, grades: DataFrame,
    streams: DataFrame, batch: Column,
) -> DataFrame:
    """Fact rows from staged pupils with their marks.

    No broadcast is forced: Spark broadcasts the dimensions whose files are below its size limit and
    shuffles for the rest, where adaptive execution splits hot keys.
    """
    return (
        joined
        .join(pupils.select("pupil_id", "pupil_key"), "pupil_id")
        .join(dates.select("date", "date_key"), F.col("snapshot_date") == F.col("date"))
        .join(academies, "academy_name", "left")
        .join(grades.select("grade_id", "grade_key"), "grade_id", "left")
        .join(streams, "stream", "left")
        .withColumnRenamed("snapshot_date", "fact_date")
        .withColumn("prcs_id", batch)
        .select(*FACT.columns)
    )


def _keyed(store: Store, joined: DataFrame, batch: Column) -> DataFrame:
    dims = [store.read(n) for n in ("dim_date", "dim_pupil", "dim_academy", "dim_grade", "dim_stream")]
    return with_keys(joined, *dims, batch)


def build_day(store: Store, day: date, batch_id: str) -> DataFrame:
    """Fact rows of one day.

    Both scans list and read one folder, and the joins need the pupil id alone: stage, marks and pupil
    dimension share one partitioning.
    """
    pupils = store.read(STG_PUPIL.name, [day])
    marks = store.read(STG_ATTENDANCE.name, [day])
    joined = pupils.join(marks.select("pupil_id", "attendance"), "pupil_id")
    return _keyed(store, joined, F.lit(batch_id))


def staged_with_marks(pupils: DataFrame, marks: DataFrame) -> DataFrame:
    """Staged pupils joined to their mark of the same day."""
    marks = marks.withColumnRenamed("attendance_date", "snapshot_date")
    return pupils.join(marks, ["snapshot_date", "pupil_id"])


def _heal(store: Store) -> None:
    # A history load starts from an empty fact, so all that a cut-off one left behind is its own.
    if store.folders.exists(f"{store.root}/_open-history"):
        store.folders.remove(store.own_base(FACT.name))
        for table in (MART_RATE, *STATES):
            store.forget(table.name)
        store.close_step("history")


def _first_calendar_day(store: Store) -> date | None:
    return store.read(DIM_DATE.name).agg(F.min("date")).first()[0]


def _stage_days(store: Store) -> list[date]:
    return sorted(set(store.days(STG_PUPIL.name)) & set(store.days(STG_ATTENDANCE.name)))


def _check(advance: str) -> None:
    if advance not in (STRICT, NEXT_AVAILABLE):
        raise ValueError(f"advance must be {STRICT!r} or {NEXT_AVAILABLE!r}, not {advance!r}")


def _one_per_key(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The first row of each (day, pupil), and how many rows were offered.

    The copies that a member held twice brings are cut in the tasks that make them, before the shuffle by key.
    """
    offered = Observation()
    return first_per_key(rows.observe(offered, F.count(F.lit(1)).alias("rows")), FACT.key, FIRST), offered


def insert_day(store: Store, day: date, batch_id: str) -> tuple[int, int]:
    """Insert or ignore the rows of one day; returns how many were inserted and how many ignored.

    A pupil has one row a day: of several the first one stays, and a row that is there already is never replaced. A
    new day is staged aside and moved into place whole; a day that is there gets the rows it lacks, and the rate mart
    makes that day anew.
    """
    if not batch_id:
        raise ValueError("a batch id is required")
    store.own_base(FACT.name)
    fresh, offered = _one_per_key(build_day(store, day, batch_id))
    held = day in store.days(FACT.name)
    if held:
        fresh = unknown_keys(fresh, store.read(FACT.name, [day]), FACT.key)
    store.announce_batch(batch_id, day)
    store.doubt_days([day])
    inserted = (store.append if held else store.put_days)(FACT.name, fresh)["rows"]
    if inserted:
        store.log_batch(batch_id, day, inserted)
        if held:
            store.touch_days([day])
    else:
        store.trust_days([day])
    store.settle_late(day)
    return inserted, offered.get["rows"] - inserted


def load_next(store: Store, batch_id: str, advance: str = STRICT) -> LoadResult:
    """Load the next day of the fact.

    ``strict`` tries only the day after the last one (the first calendar day at the start) and loads nothing
    when that day has no joined rows, which blocks every later day and is reported as stalled.
    ``next_available`` goes on to the first later day that has some. Which days exist comes from folder
    listings; the load itself is one job.
    """
    _check(advance)
    if not batch_id:
        raise ValueError("a batch id is required")
    _heal(store)
    loaded = store.days(FACT.name)
    target = loaded[-1] + timedelta(days=1) if loaded else _first_calendar_day(store)
    if target is None:
        return LoadResult(batch_id, None, 0, False)
    ahead = [day for day in _stage_days(store) if day >= target]
    for day in ahead if advance == NEXT_AVAILABLE else ahead[:1]:
        if advance == STRICT and day != target:
            break
        inserted, ignored = insert_day(store, day, batch_id)
        if inserted:
            return LoadResult(batch_id, day, inserted, False, ignored)
    stalled = advance == STRICT and any(day > target for day in ahead)
    return LoadResult(batch_id, target, 0, stalled)


def _unbroken(days: list[date], start: date) -> list[date]:
    run = []
    for day in days:
        if day != start + timedelta(days=len(run)):
            break
        run.append(day)
    return run


def load_history(store: Store, batch_of: Callable[[Column], Column], advance: str = STRICT) -> LoadResult:
    """Fill an empty fact with all days that daily loads would have reached, in one job.

    ``batch_of`` gives the batch id for the fact date column. A run that is cut off is undone by the next load.
    """
    _check(advance)
    # Refused before anything is marked or removed if the fact belongs to another store.
    store.own_base(FACT.name)
    _heal(store)
    if store.days(FACT.name):
        raise RuntimeError("the fact is not empty; use load_next")
    start = _first_calendar_day(store)
    days = [day for day in _stage_days(store) if start and day >= start]
    if advance == STRICT:
        # Staged days alone may reach over a day without joined rows, where daily loads stop.
        days = _unbroken(sorted(_days_with_rows(store, _unbroken(days, start))), start)
    if not days:
        return LoadResult("", start, 0, False)
    pupils, marks = store.read(STG_PUPIL.name, days), store.read(STG_ATTENDANCE.name, days)
    rows, offered = _one_per_key(_keyed(store, staged_with_marks(pupils, marks), batch_of(F.col("fact_date")).cast("string")))
    store.open_step("history")
    store.doubt_days(days)
    # One row per calendar day.
    named = store.spark.createDataFrame([(day,) for day in days], "fact_date date")
    batches = {r["fact_date"]: r["batch"] for r in named.select("fact_date", batch_of(F.col("fact_date")).cast("string").alias("batch")).collect()}
    for day, batch in batches.items():
        store.announce_batch(batch, day)
    written = store.put_days(FACT.name, rows.hint("rebalance", FACT.day))
    loaded = store.read(FACT.name, written["days"]).groupBy(FACT.day).agg(F.count(F.lit(1)).alias("n"))
    for r in loaded.collect():
        store.log_batch(batches[r[FACT.day]], r[FACT.day], r["n"])
    store.trust_days(set(days) - set(written["days"]))
    store.close_step("history")
    last = written["days"][-1] if written["days"] else start
    return LoadResult("", last, written["rows"], False, offered.get["rows"] - written["rows"])


def _days_with_rows(store: Store, days: list[date]) -> set[date]:
    """The days that have a row to load, from keys alone."""
    staged = store.read(STG_PUPIL.name, days).select("snapshot_date", "pupil_id")
    marks = store.read(STG_ATTENDANCE.name, days).select(F.col("attendance_date").alias("snapshot_date"), "pupil_id")
    known = staged.join(store.read(DIM_PUPIL.name).select("pupil_id"), "pupil_id", "left_semi")
    found = known.join(marks, ["snapshot_date", "pupil_id"], "left_semi").select("snapshot_date").distinct()
    listed = found.join(store.read(DIM_DATE.name).select(F.col("date").alias("snapshot_date")), "snapshot_date", "left_semi")
    return {r["snapshot_date"] for r in listed.collect()}


def load_summary(store: Store, result: LoadResult) -> DataFrame:
    """One row: label, fact rows in total, last day loaded, rows inserted by this run."""
    return store.read(FACT.name).agg(
        F.count(F.lit(1)).alias("total_fact_rows"), F.max("fact_date").alias("last_loaded_date")
    ).select(
        F.lit(SUMMARY_LABEL).alias("status"), "total_fact_rows", "last_loaded_date",
        F.lit(result.inserted).cast("bigint").alias("rows_inserted_this_run"),
    )


def late_rows(store: Store, since: date | None = None) -> DataFrame:
    """Staged rows with a mark whose day the fact has already passed without them; days from ``since`` on.

    Only days that were noted when rows were staged behind the fact can have some; nothing else is read.
    """
    loaded, noted = store.days(FACT.name), store.late_days()
    passed = [
        day for day in _stage_days(store)
        if loaded and day <= loaded[-1] and (not since or day >= since) and (noted is None or day in noted)
    ]
    joined = staged_with_marks(
        store.read(STG_PUPIL.name, passed).select("snapshot_date", "pupil_id"),
        store.read(STG_ATTENDANCE.name, passed),
    )
    fact = store.read(FACT.name, [day for day in loaded if day in set(passed)])
    known = fact.select(F.col("fact_date").alias("snapshot_date"), "pupil_key").join(
        store.read("dim_pupil").select("pupil_key", "pupil_id"), "pupil_key"
    )
    return unknown_keys(joined, known, STG_PUPIL.key).select("snapshot_date", "pupil_id", "attendance")
