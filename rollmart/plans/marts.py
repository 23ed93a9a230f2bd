"""The three reporting marts and the example models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import is_present
from ..operators.keyed import unknown_keys
from ..operators.numbering import number_rows, rank_descending
from ..schemas import (
    ACADEMY_PUPILS, ACADEMY_SUMS, FACT, MART_BENCHMARKS, MART_RATE, MART_WEEKDAY, WEEKDAY_SUMS,
)
from ..session import side_by_side
from ..sources.folders import Scratch
from ..sources.store import Store


def attendance_rate(fact: DataFrame, academies: DataFrame, grades: DataFrame, dates: DataFrame) -> DataFrame:
    """Share of present pupils per day, academy and grade.

    The fact is summed up by its keys before any name is looked up, so the joins see one row per day and key
    pair. The second sum merges keys that share a name and all rows whose key has none.
    """
    by_key = fact.groupBy("fact_date", "academy_key", "grade_key").agg(
        F.sum(is_present(F.col("attendance"))).alias("present"), F.count(F.lit(1)).alias("pupils")
    )
    by_name = (
        by_key.join(academies, "academy_key", "left")
        .join(grades.select("grade_key", "grade_name"), "grade_key", "left")
        .groupBy("fact_date", "academy_name", "grade_name")
        .agg(F.sum("present").alias("present"), F.sum("pupils").alias("total_pupils_presented"))
    )
    rate = F.col("present").cast("double") / F.col("total_pupils_presented")
    return (
        by_name.join(dates, F.col("fact_date") == F.col("date"))
        .withColumn("attendance_rate", rate)
        .select(*MART_RATE.columns)
    )


def absenteeism_weekday(rates: DataFrame) -> DataFrame:
    """Unweighted means over the rows of the rate mart, per weekday."""
    return rates.groupBy("weekday").agg(
        F.avg(1 - F.col("attendance_rate")).alias("avg_absenteeism_rate"),
        F.avg("total_pupils_presented").alias("avg_daily_pupils"),
        F.count_distinct("academy_name").alias("academies_count"),
    )


def academy_metrics(fact: DataFrame, academies: DataFrame) -> DataFrame:
    """Rate over all records and number of pupils per academy; rows without an academy form one group.

    Summing per academy and pupil first shrinks the fact to its distinct pairs and spreads a large academy
    over all tasks.
    """
    pairs = fact.groupBy("academy_key", "pupil_key").agg(
        F.sum(is_present(F.col("attendance"))).alias("present"), F.count(F.lit(1)).alias("marks")
    )
    return (
        pairs.join(academies, "academy_key", "left")
        .groupBy("academy_name")
        .agg(
            (F.sum("present").cast("double") / F.sum("marks")).alias("overall_attendance_rate"),
            F.count_distinct("pupil_key").alias("total_unique_pupils"),
        )
    )


def academy_benchmarks(fact: DataFrame, academies: DataFrame, scratch: Scratch) -> DataFrame:
    """Academies ranked by their overall rate, best first."""
    metrics = scratch.keep(academy_metrics(fact, academies), "metrics")
    return rank_descending(metrics, "overall_attendance_rate", "rank", scratch)


# Reading order of the marts: descending keys start and ascending keys end with NULL.

def rate_order() -> list:
    return [F.desc_nulls_first("fact_date"), F.asc_nulls_last("academy_name"), F.asc_nulls_last("grade_name")]


def weekday_order() -> list:
    return [F.desc_nulls_first("avg_absenteeism_rate"), F.asc_nulls_last("weekday")]


def benchmark_order() -> list:
    return [F.asc_nulls_last("rank"), F.asc_nulls_last("academy_name")]


MART_ORDER = {
    MART_RATE.name: rate_order, MART_WEEKDAY.name: weekday_order, MART_BENCHMARKS.name: benchmark_order,
}


def read_mart(store: Store, name: str) -> DataFrame:
    """A stored mart in its reading order."""
    return store.read(name).orderBy(*MART_ORDER[name]())


def positioned(rows: DataFrame, order: list, scratch: Scratch) -> DataFrame:
    """The rows with their place in the order as column ``pos``."""
    return number_rows(rows, order, "pos", scratch)


def build_rates(store: Store, rebuild: bool = False) -> int:
    """Bring the stored rate mart up to the fact; returns the rows written.

    Loaded fact days and known dimension members never change, so only days the mart lacks are computed
    unless ``rebuild`` asks for all.
    """
    loaded, held = store.days(FACT.name), store.days(MART_RATE.name)
    store.drop_days(MART_RATE.name, [day for day in held if day not in set(loaded)])
    days = loaded if rebuild else [day for day in loaded if day not in set(held)]
    store.drop_days(WEEKDAY_SUMS.name, days)
    if not days:
        return 0
    dims = (store.read(name) for name in ("dim_academy", "dim_grade", "dim_date"))
    rates = attendance_rate(store.read(FACT.name, days), *dims)
    return store.put_days(MART_RATE.name, rates.hint("rebalance", MART_RATE.day))["rows"]


# What is kept of the fact for the two small marts, so that a build reads the days that are new.

def weekday_sums(rates: DataFrame) -> DataFrame:
    """Per day and academy the sums that the means over a weekday are made of."""
    return rates.groupBy("fact_date", "weekday", "academy_name").agg(
        F.sum(1 - F.col("attendance_rate")).alias("absent_rates"), F.sum("total_pupils_presented").alias("pupils"),
        F.count(F.lit(1)).alias("groups"),
    )


def weekdays_of(sums: DataFrame) -> DataFrame:
    """The weekday mart from its sums."""
    return sums.groupBy("weekday").agg(
        (F.sum("absent_rates") / F.sum("groups")).alias("avg_absenteeism_rate"),
        (F.sum("pupils") / F.sum("groups")).alias("avg_daily_pupils"), F.count_distinct("academy_name").alias("academies_count"),
    )


def extend_weekdays(store: Store) -> DataFrame:
    """The weekday mart, after the sums were brought up to the rate mart. A day that left it leaves the sums."""
    wanted, held = store.days(MART_RATE.name), store.days(WEEKDAY_SUMS.name)
    store.drop_days(WEEKDAY_SUMS.name, [day for day in held if day not in set(wanted)])
    days = [day for day in wanted if day not in set(held)]
    if days:
        store.put_days(WEEKDAY_SUMS.name, weekday_sums(store.read(MART_RATE.name, days)).hint("rebalance", WEEKDAY_SUMS.day))
    return weekdays_of(store.read(WEEKDAY_SUMS.name))


def academy_pairs(fact: DataFrame, academies: DataFrame) -> DataFrame:
    """Marks and presences per day, academy and pupil; rows without a known academy belong to academy 0."""
    known = academies.select("academy_key", F.col("academy_key").alias("_known"))
    summed = fact.groupBy("fact_date", "academy_key", "pupil_key").agg(
        F.sum(is_present(F.col("attendance"))).alias("present"), F.count(F.lit(1)).alias("marks")
    )
    return summed.join(known, "academy_key", "left").select(
        "fact_date", F.coalesce("_known", F.lit(0)).cast("bigint").alias("academy_key"), "pupil_key", "present", "marks"
    )


def metrics_of(sums: DataFrame, pupils: DataFrame, academies: DataFrame) -> DataFrame:
    """The metrics of the academies from what is kept: sums per day, and the distinct pairs of academy and pupil."""
    rates = sums.groupBy("academy_key").agg(F.sum("present").alias("present"), F.sum("marks").alias("marks"))
    members = pupils.groupBy("academy_key").agg(F.count(F.lit(1)).alias("total_unique_pupils"))
    return rates.join(members, "academy_key").join(academies, "academy_key", "left").select(
        "academy_name", (F.col("present").cast("double") / F.col("marks")).alias("overall_attendance_rate"), "total_unique_pupils"
    )


def extend_academies(store: Store, rebuild: bool = False) -> DataFrame:
    """The metrics of the academies, after what is kept of the fact was brought up to it.

    The pairs of academy and pupil only grow, and adding a day twice adds nothing. A day that left the fact or changed
    takes them along: then all of it is made anew.
    """
    loaded, summed, counted = store.days(FACT.name), store.days(ACADEMY_SUMS.name), store.counted_days()
    if rebuild or set(summed) - set(loaded) or set(counted) - set(summed):
        for table in (ACADEMY_SUMS, ACADEMY_PUPILS):
            store.forget(table.name)
        store.forget_counted()
        summed, counted = [], []
    days = [day for day in loaded if day not in set(summed) or day not in set(counted)]
    academies = store.read("dim_academy")
    if days:
        with store.scratch() as scratch:
            pairs = scratch.keep(academy_pairs(store.read(FACT.name, days), academies), "pairs")
            sums = pairs.groupBy("fact_date", "academy_key").agg(F.sum("present").alias("present"), F.sum("marks").alias("marks"))
            store.put_days(ACADEMY_SUMS.name, sums.hint("rebalance", ACADEMY_SUMS.day))
            seen = pairs.select("academy_key", "pupil_key").distinct()
            store.append(ACADEMY_PUPILS.name, unknown_keys(seen, store.read(ACADEMY_PUPILS.name), ACADEMY_PUPILS.key))
            store.note_counted(days)
    return metrics_of(store.read(ACADEMY_SUMS.name), store.read(ACADEMY_PUPILS.name), academies)


def build_marts(store: Store, rebuild: bool = False) -> dict[str, int]:
    """Build and store all marts from the days that are new. Returns rows written per mart."""
    def rates_and_weekdays() -> dict[str, int]:
        rates = build_rates(store, rebuild)
        weekdays = store.replace(MART_WEEKDAY.name, extend_weekdays(store))["rows"]
        return {MART_RATE.name: rates, MART_WEEKDAY.name: weekdays}

    def benchmarks() -> dict[str, int]:
        with store.scratch() as scratch:
            metrics = scratch.keep(extend_academies(store, rebuild), "metrics")
            ranked = rank_descending(metrics, "overall_attendance_rate", "rank", scratch)
            return {MART_BENCHMARKS.name: store.replace(MART_BENCHMARKS.name, ranked)["rows"]}

    first, second = side_by_side(store.spark, rates_and_weekdays, benchmarks)
    return {**first, **second}


def base_model(ids: DataFrame) -> DataFrame:
    """The example base model over any ids: a branch of values and a branch of NULLs under one name."""
    return ids.unionAll(ids.select(F.lit(None).cast("bigint").alias("id")))


def child_model(base: DataFrame) -> DataFrame:
    """The example child model: the rows of the base model with id 1; NULL is not 1."""
    return base.where(F.col("id") == 1)
