from __future__ import annotations

import random
from collections import defaultdict
from datetime import date

import pytest

from rollmart.plans import checks, daily, dims, marts
from rollmart.schemas import TABLES
from rollmart.sources.folders import Scratch
from rollmart.sources.targets import ParquetTarget

FACT = "fact_pupil_attendance_daily"
ACADEMIES = {1: "North", 2: "South", 3: "East"}
GRADES = {1: (10, "Primary 1"), 2: (20, "Primary 1"), 3: (30, "Top Class")}  # two ids share a name
DAYS = [date(2025, 1, n) for n in range(1, 16)]
MARKS = ("Present", "Absent", "present", None)


@pytest.fixture
def star(store, spark):
    """A random star schema with NULL and dangling keys; half of the rows belong to one academy."""
    pick = random.Random(7)
    facts = {}
    for _ in range(1500):
        day, pupil = pick.choice(DAYS), pick.randint(1, 60)
        academy = 1 if pick.random() < 0.5 else pick.choice([2, 3, 99, None])
        facts[day, pupil] = (
            day, int(day.strftime("%Y%m%d")), pupil, academy, pick.choice([1, 2, 3, 88, None]), None,
            "In", pick.choice(MARKS), "b",
        )

    def write(name, rows):
        store.append(name, spark.createDataFrame(rows, TABLES[name].schema))

    write(FACT, list(facts.values()))
    write("dim_academy", list(ACADEMIES.items()))
    write("dim_grade", [(key, *rest) for key, rest in GRADES.items()])
    write("dim_pupil", [(p, p, "A", "B") for p in range(1, 61)])
    write("dim_date", [
        (int(d.strftime("%Y%m%d")), d, d.year, d.month, d.day, d.strftime("%A")) for d in DAYS if d.day != 7
    ])
    return store, list(facts.values())


def rates(facts):
    groups = defaultdict(list)
    for day, _, _, academy, grade, *_, mark, _ in facts:
        if day.day != 7:  # the calendar lacks this day
            groups[day, ACADEMIES.get(academy), GRADES.get(grade, (0, None))[1]].append(mark == "Present")
    return {key: (sum(seen) / len(seen), len(seen)) for key, seen in groups.items()}


def test_attendance_rate(star):
    store, facts = star
    got = marts.attendance_rate(*(store.read(n) for n in (FACT, "dim_academy", "dim_grade", "dim_date")))
    assert got.columns == TABLES["attendance_rate"].columns
    rows = got.collect()
    assert {(r["fact_date"], r["academy_name"], r["grade_name"]): (r["attendance_rate"], r["total_pupils_presented"])
            for r in rows} == rates(facts)
    assert all((r["year"], r["month"], r["weekday"]) == (2025, 1, r["fact_date"].strftime("%A")) for r in rows)


def test_absenteeism_weekday(star):
    store, facts = star
    marts.build_marts(store)
    groups = defaultdict(list)
    for (day, academy, _), (rate, count) in rates(facts).items():
        groups[day.strftime("%A")].append((1 - rate, count, academy))
    got = {r["weekday"]: r for r in store.read("absenteeism_weekday").collect()}
    assert set(got) == set(groups)
    for weekday, seen in groups.items():
        assert got[weekday]["avg_absenteeism_rate"] == pytest.approx(sum(s[0] for s in seen) / len(seen))
        assert got[weekday]["avg_daily_pupils"] == pytest.approx(sum(s[1] for s in seen) / len(seen))
        assert got[weekday]["academies_count"] == len({s[2] for s in seen} - {None})


def test_academy_benchmarks(star, spark):
    store, facts = star
    groups = defaultdict(list)
    for _, _, pupil, academy, *_, mark, _ in facts:
        groups[ACADEMIES.get(academy)].append((mark == "Present", pupil))
    rate = {name: sum(s[0] for s in seen) / len(seen) for name, seen in groups.items()}
    want = {
        name: (rate[name], len({s[1] for s in seen}), 1 + sum(r > rate[name] for r in rate.values()))
        for name, seen in groups.items()
    }
    got = marts.academy_benchmarks(store.read(FACT), store.read("dim_academy"), Scratch(spark)).collect()
    assert {r["academy_name"]: (r["overall_attendance_rate"], r["total_unique_pupils"], r["rank"]) for r in got} == want


def test_reading_order(star):
    store, _ = star
    marts.build_marts(store)
    rows = [(r["fact_date"], r["academy_name"], r["grade_name"]) for r in marts.read_mart(store, "attendance_rate").collect()]
    late = "~"  # NULL sorts behind all names
    assert rows == sorted(rows, key=lambda r: (-r[0].toordinal(), r[1] or late, r[2] or late))
    shares = [r["avg_absenteeism_rate"] for r in marts.read_mart(store, "absenteeism_weekday").collect()]
    assert shares == sorted(shares, reverse=True)
    ranks = [r["rank"] for r in marts.read_mart(store, "academy_benchmarks").collect()]
    assert ranks == sorted(ranks)


def test_rebuilt_marts_replace_the_old_ones(star):
    store, _ = star
    first = marts.build_marts(store)
    assert marts.build_marts(store, rebuild=True) == first
    assert store.read("attendance_rate").count() == first["attendance_rate"]


def test_rate_mart_follows_the_days_of_the_fact(star):
    store, facts = star
    first = marts.build_marts(store)
    assert marts.build_marts(store) == {**first, "attendance_rate": 0}
    store.drop_days(FACT, DAYS[3:4])
    store.drop_days("attendance_rate", DAYS[5:6])
    marts.build_marts(store)
    want = rates([f for f in facts if f[0] != DAYS[3]])
    rows = store.read("attendance_rate").collect()
    assert {(r["fact_date"], r["academy_name"], r["grade_name"]): (r["attendance_rate"], r["total_pupils_presented"])
            for r in rows} == want
    store.truncate_all()
    assert not store.days("attendance_rate")


def test_example_models(spark):
    base = marts.base_model(spark.createDataFrame([(1,), (2,)], "id bigint"))
    assert sorted(str(r[0]) for r in base.collect()) == ["1", "2", "None", "None"]
    assert [r[0] for r in marts.child_model(base).collect()] == [1]


def failures(report):
    return {(r["table_name"], r["column_name"], r["test"]): r["failures"] for r in report.collect()}


def test_mart_checks_and_gate(star):
    store, facts = star
    marts.build_marts(store)
    report = failures(checks.mart_checks(store))
    assert len(report) == 14
    names = [key[1] for key in rates(facts)]
    assert report["attendance_rate", "academy_name", "not_null"] == names.count(None) > 0
    assert report["academy_benchmarks", "academy_name", "not_null"] == 1
    assert report["absenteeism_weekday", "weekday", "unique"] == 0
    with pytest.raises(checks.DataTestFailure) as caught:
        checks.run_checks(store)
    assert {f[:2] for f in caught.value.failures} == {
        ("attendance_rate", "academy_name"), ("attendance_rate", "grade_name"), ("academy_benchmarks", "academy_name"),
    }
    assert checks.run_checks(store, "warn") == caught.value.failures
    with pytest.raises(ValueError):
        checks.run_checks(store, "ignore")


def test_key_and_foreign_key_checks(star, spark):
    store, facts = star
    assert set(failures(checks.key_checks(store)).values()) == {0}
    store.append("dim_grade", spark.createDataFrame([(3, 40, "x"), (4, 10, "y")], TABLES["dim_grade"].schema))
    report = failures(checks.key_checks(store, [DAYS[0]]))
    assert report["dim_grade", "grade_key", "primary_key"] == 1
    assert report["dim_grade", "grade_id", "unique"] == 1
    assert report[FACT, "fact_date,pupil_key", "primary_key"] == 0

    report = failures(checks.foreign_key_checks(store))
    assert report[FACT, "academy_key", "foreign_key"] == sum(f[3] == 99 for f in facts)
    assert report[FACT, "grade_key", "foreign_key"] == sum(f[4] == 88 for f in facts)
    assert report[FACT, "date_key", "foreign_key"] == sum(f[0].day == 7 for f in facts)
    assert report[FACT, "pupil_key", "foreign_key"] == report[FACT, "stream_key", "foreign_key"] == 0
    one_day = failures(checks.foreign_key_checks(store, [DAYS[6]]))
    assert one_day[FACT, "date_key", "foreign_key"] == sum(f[0].day == 7 for f in facts)


def test_unique_passes_over_null(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "c string")
    assert failures(checks.unique(rows, "t", ("c",))) == {("t", "c", "unique"): 1}


def test_reporting_run(star, spark, tmp_path):
    store, facts = star
    target = ParquetTarget(spark, str(tmp_path / "target"))
    with pytest.raises(checks.DataTestFailure):
        daily.run_reporting(store, target)
    result = daily.run_reporting(store, target, severity="warn")
    assert [s.table for s in result.synced] == [FACT, "dim_date", "dim_pupil", "dim_academy", "dim_grade", "dim_stream"]
    assert [s.skipped for s in result.synced] == [False] * 5 + [True]
    assert result.synced[0].rows == len(facts)
    assert set(result.marts) == {"attendance_rate", "absenteeism_weekday", "academy_benchmarks"}
    assert len(result.failures) == 3


def scanned_days(rows):
    """The day folders that the files of a frame lie in."""
    return sorted({part.partition("=")[2] for file in rows.inputFiles() for part in file.split("/") if part.startswith("fact_date=")})


def fact_frame(spark, *rows):
    full = [(date(2025, 1, d), 20250100 + d, pupil, academy, 1, 1, "In", mark, "b") for d, pupil, academy, mark in rows]
    return spark.createDataFrame(full, TABLES[FACT].schema)


def test_small_marts_are_kept_from_the_new_days(spark, store, monkeypatch):
    store.append("dim_academy", spark.createDataFrame([(1, "North"), (2, "South")], TABLES["dim_academy"].schema))
    store.append("dim_grade", spark.createDataFrame([(1, 1, "Primary 1")], TABLES["dim_grade"].schema))
    days = [(date(2025, 1, d),) for d in range(1, 9)]
    store.append("dim_date", dims.calendar(spark.createDataFrame(days, "snapshot_date date")))
    read, original = [], store.read

    def reading(name, of=None):
        if name == FACT:
            read.append(of)
        return original(name, of)

    monkeypatch.setattr(store, "read", reading)

    def check():
        """The stored marts against those of the whole fact."""
        academies = original("dim_academy")
        want = {tuple(r) for r in marts.academy_metrics(original(FACT), academies).collect()}
        got = original("academy_benchmarks").collect()
        assert {(r["academy_name"], r["overall_attendance_rate"], r["total_unique_pupils"]) for r in got} == want
        weekdays = marts.absenteeism_weekday(original("attendance_rate")).collect()
        assert {(r[0], round(r[1], 9), round(r[2], 9), r[3]) for r in original("absenteeism_weekday").collect()} == {
            (r[0], round(r[1], 9), round(r[2], 9), r[3]) for r in weekdays
        }

    def build():
        read.clear()
        marts.build_marts(store)
        found = {day.day for of in read for day in of}
        check()
        return found

    store.append(FACT, fact_frame(spark, (1, 1, 1, "Present"), (1, 2, 1, "Absent"), (1, 3, None, "Present"), (1, 4, 77, "Present")))
    assert build() == {1}
    store.append(FACT, fact_frame(spark, (2, 1, 1, "Present"), (2, 2, 2, None), (2, 3, None, "Absent"), (2, 5, 2, "Present")))
    assert build() == {2}
    store.append(FACT, fact_frame(spark, (8, 1, 1, "Present"), (8, 5, 2, "Absent")))
    assert build() == {8}
    assert build() == set()
    # A step that was cut off before its days were noted adds nothing when it is done again.
    store.forget_counted()
    store.note_counted([date(2025, 1, 1), date(2025, 1, 2)])
    assert build() == {8}
    # A day that left: all of it is made anew for the pupils, the sums of the other days stay for the weekdays.
    store.drop_days(FACT, [date(2025, 1, 2)])
    assert build() == {1, 8}
    store.append(FACT, fact_frame(spark, (8, 9, 1, "Present")))
    store.touch_days([date(2025, 1, 8)])
    assert build() == {1, 8}
