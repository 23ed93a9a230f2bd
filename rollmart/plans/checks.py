"""Data tests as queries: not null, unique, primary keys, foreign keys; and the gate that applies them."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import all_present
from ..schemas import FACT, FOREIGN_KEYS, TABLES, UNIQUE_KEYS, WAREHOUSE
from ..sources.store import Store

# Declared tests on the mart columns.
NOT_NULL = {
    "attendance_rate": ("fact_date", "academy_name", "grade_name", "attendance_rate", "total_pupils_presented"),
    "absenteeism_weekday": ("weekday", "avg_absenteeism_rate", "avg_daily_pupils", "academies_count"),
    "academy_benchmarks": ("academy_name", "overall_attendance_rate", "total_unique_pupils", "rank"),
}
UNIQUE = {"absenteeism_weekday": ("weekday",)}


class DataTestFailure(Exception):
    def __init__(self, failures: list[tuple[str, str, str, int]]):
        self.failures = failures
        super().__init__("; ".join(f"{t}.{c} {test}: {n}" for t, c, test, n in failures))


def not_null(rows: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """NULL count per column, all columns in one pass."""
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "failures"
    )


def unique(rows: DataFrame, table: str, key: tuple[str, ...], test: str = "unique") -> DataFrame:
    """Number of key values that occur more than once; keys with a NULL do not count."""
    repeated = rows.where(all_present(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("column_name"), F.lit(test).alias("test"),
        "failures",
    )


def not_null_checks(store: Store) -> DataFrame:
    return reduce(DataFrame.unionByName, (not_null(store.read(t), t, cols) for t, cols in NOT_NULL.items()))


def unique_checks(store: Store) -> DataFrame:
    return reduce(DataFrame.unionByName, (unique(store.read(t), t, key) for t, key in UNIQUE.items()))


def _part(store: Store, name: str, days: list[date] | None) -> DataFrame:
    if days is None or not TABLES[name].day:
        return store.read(name)
    return store.read(name, [d for d in store.days(name) if d in set(days)])


def key_checks(store: Store, days: list[date] | None = None) -> DataFrame:
    """Declared primary keys and unique natural keys of all warehouse tables.

    The day is part of every key of a day-partitioned table, so after a daily load its ``days`` are enough.
    """
    parts = [unique(_part(store, t.name, days), t.name, t.key, "primary_key") for t in WAREHOUSE if t.key]
    parts += [unique(store.read(t), t, key) for t, key in UNIQUE_KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


def foreign_key_checks(store: Store, days: list[date] | None = None) -> DataFrame:
    """Fact rows per foreign key whose value the dimension lacks; NULL is allowed.

    One pass over the fact: its key values are stacked and counted before the shuffle, so the look-up sees
    one row per distinct value.
    """
    names = list(FOREIGN_KEYS)
    fact = _part(store, FACT.name, days).select(*(F.col(c).cast("bigint").alias(c) for c in names))
    used = (
        fact.unpivot([], names, "column_name", "value").where(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    held = reduce(DataFrame.unionByName, (
        store.read(dim).select(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("value"))
        for c, dim in FOREIGN_KEYS.items()
    ))
    orphans = used.join(held, ["column_name", "value"], "left_anti").select("column_name", "rows")
    zeros = store.spark.createDataFrame([(c, 0) for c in names], "column_name string, rows bigint")
    return orphans.unionByName(zeros).groupBy("column_name").agg(F.sum("rows").alias("failures")).select(
        F.lit(FACT.name).alias("table_name"), "column_name", F.lit("foreign_key").alias("test"), "failures"
    )


def check_keys(store: Store) -> list[date]:
    """Test the keys of all fact days that were written since their last check; returns those days.

    A repeated key or a value that its dimension lacks raises, and the days stay in doubt, so that nothing is published
    until they are mended. Days that passed are not read again: what was loaded never changes.
    """
    days = store.doubted_days()
    if not days:
        return []
    report = key_checks(store, days).unionByName(foreign_key_checks(store, days)).where("failures > 0").collect()
    if report:
        raise DataTestFailure(sorted((r["table_name"], r["column_name"], r["test"], r["failures"]) for r in report))
    store.trust_days(days)
    return days


def mart_checks(store: Store) -> DataFrame:
    """The declared tests on the marts, one row per test."""
    return not_null_checks(store).unionByName(unique_checks(store))


def run_checks(store: Store, severity: str = "error") -> list[tuple[str, str, str, int]]:
    """Apply the mart tests; failing ones raise with severity ``error`` and are returned with ``warn``."""
    if severity not in ("error", "warn"):
        raise ValueError(f"severity must be 'error' or 'warn', not {severity!r}")
    report = mart_checks(store).where("failures > 0").collect()  # one row per declared test at most
    failures = sorted((r["table_name"], r["column_name"], r["test"], r["failures"]) for r in report)
    if failures and severity == "error":
        raise DataTestFailure(failures)
    return failures
