"""Extract-shaped views over the supplied tables.

``events`` plays the daily extract: every event of a user is one delivered snapshot row and its id the row
order. Customer and nation give name, school and class stream. A ``signup`` carries no attendance mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ordered() -> list:
    return [F.lit("").alias("_file"), F.lit(0).cast("bigint").alias("_block"), F.col("event_id").alias("_row")]


def _day_text() -> Column:
    return F.date_format(F.col("ts").cast("date"), "yyyy/MM/dd")


def raw_pupil(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    user, event = F.col("user_id"), F.col("event_id")
    grade = user % 11
    grade_text = (
        F.when(grade.between(1, 7) & (event % 2 == 0), F.concat(F.lit("primary"), grade.cast("string")))
        .when(grade.between(1, 7), F.concat(F.lit(" Primary "), grade.cast("string")))
        .when(grade == 8, "baby class").when(grade == 9, " TOP CLASS ").when(grade == 10, "Nursery")
    )
    return (
        events.join(customers, user == F.col("c_custkey"))
        .join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
        .select(
            _day_text().alias("SnapshotDate"),
            F.when(user % 17 == 0, "   ").otherwise(F.concat(F.lit("  "), "n_name", F.lit(" "))).alias("AcademyName"),
            user.cast("string").alias("PupilID"),
            F.substring("c_name", 1, 8).alias("FirstName"),
            F.lit(None).cast("string").alias("MiddleName"),
            F.substring("c_name", 10, 100).alias("LastName"),
            F.col("event_type").alias("Status"),
            grade.cast("string").alias("GradeId"),
            grade_text.alias("GradeName"),
            F.when(user % 5 == 0, "").otherwise(F.concat(F.lit(" "), F.lower("c_mktsegment"))).alias("Stream"),
            *_ordered(),
        )
    )


def raw_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return (
        table(spark, sf_dir, "events").where(kind != "signup")
        .select(
            _day_text().alias("Date"),
            F.col("user_id").cast("string").alias("PupilID"),
            F.when(kind == "error", " ").when(kind == "purchase", "Absent").otherwise("Present").alias("Attendance"),
            *_ordered(),
        )
    )
