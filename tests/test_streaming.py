from __future__ import annotations

import csv

import pytest

from samples import snapshot
from rollmart.plans import daily, fact
from rollmart.schemas import ATTENDANCE_EXTRACT, PUPIL_EXTRACT
from rollmart.streaming.intake import stage_arrivals


def arrive(folder, name, rows, header=ATTENDANCE_EXTRACT):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="") as out:
        csv.writer(out).writerows([header, *rows])


def test_files_are_staged_once_in_order(spark, store, tmp_path):
    folder, progress = tmp_path / "in", str(tmp_path / "progress")

    def run():
        query = stage_arrivals(store, "stg_pupil_attendance", str(folder), progress, files_per_batch=1)
        query.awaitTermination()

    arrive(folder, "a.csv", [("2025/01/01", "1", "Present"), ("2025/01/01", "1", "Absent"), ("x", "2", "Present")])
    run()
    arrive(folder, "b.csv", [("2025/01/01", "1", "Absent"), ("2025/01/02", "1", "NA")])
    run()
    run()
    rows = store.read("stg_pupil_attendance").orderBy("attendance_date").collect()
    assert [(r["attendance_date"].day, r["pupil_id"], r["attendance"]) for r in rows] == [(1, 1, "Present"), (2, 1, None)]
    # Progress lost: everything is read again and nothing is added.
    stage_arrivals(store, "stg_pupil_attendance", str(folder), progress + "2").awaitTermination()
    assert store.read("stg_pupil_attendance").count() == 2


def test_streamed_pupils_reach_the_dimensions_and_the_fact(spark, store, raw, tmp_path):
    store.replace("raw_pupil", raw(snapshot("2025/01/01", "1")))
    store.replace("raw_pupil_attendance", raw.marks(("2025/01/01", "1", "Present")))
    daily.load_stage_and_dims(store)
    assert fact.load_next(store, "a").inserted == 1

    pupils, marks = tmp_path / "pupils", tmp_path / "marks"
    arrive(pupils, "b.csv", [("2025/01/02", "North", p, "Ann", "", "Lee", "In", "1", "PRIMARY1", "a") for p in "12"], PUPIL_EXTRACT)
    arrive(marks, "b.csv", [("2025/01/02", p, "Present") for p in "12"])
    stage_arrivals(store, "stg_pupil", str(pupils), str(tmp_path / "p1")).awaitTermination()
    stage_arrivals(store, "stg_pupil_attendance", str(marks), str(tmp_path / "p2")).awaitTermination()
    assert [day.day for day in store.noted_days()] == [2]

    # The daily run brings nothing new itself.
    staged, added = daily.load_stage_and_dims(store)
    assert (staged[0].inserted, added["dim_pupil"], added["dim_date"]) == (0, 1, 1)
    assert fact.load_next(store, "b").inserted == 2
    assert store.noted_days() == [] and daily.load_stage_and_dims(store)[1] == {}


def test_unknown_table(store):
    with pytest.raises(KeyError):
        stage_arrivals(store, "dim_pupil", "/in", "/progress")
