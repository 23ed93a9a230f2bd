"""The registered queries: one per operator or load behaviour, each over whole supplied tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollmart.functions import calendar, cleaning
from rollmart.operators.keyed import insert_ignore, unknown_keys
from rollmart.plans import checks, daily, dims, fact, marts, sqlfile, stage, sync
from rollmart.schemas import (
    ATTENDANCE_EXTRACT, FACT, MARTS, PUPIL_EXTRACT, RAW_REJECTED, STG_ATTENDANCE, STG_PUPIL, TABLES, WAREHOUSE,
)
from rollmart.sources import extracts
from rollmart.sources.folders import Scratch
from rollmart.sources.store import Store, layer_order
from rollmart.sources.targets import ParquetTarget, TsvTarget
from rollmart.streaming import intake

from . import views
from .warehouse import loaded, new_root

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_FILES = Path(__file__).parent / "sql"
DAY = "2024-01-%02d"


def query(build):
    REGISTRY[build.__name__] = build
    return build


def events(spark, sf_dir):
    return views.table(spark, sf_dir, "events")


def day_batch(day: date) -> str:
    return hashlib.md5(day.isoformat().encode()).hexdigest()


# Scalar expressions

@query
def date_text_parse(spark, sf_dir):
    month, day = F.lpad((F.col("user_id") % 14).cast("string"), 2, "0"), F.lpad((F.col("event_id") % 33).cast("string"), 2, "0")
    separator = F.when(F.col("event_type") == "click", "-").when(F.col("event_type") == "view", "").otherwise("/")
    text = F.concat(F.lit("2024"), separator, month, separator, day, F.lit(" 10:00"))
    return events(spark, sf_dir).select("event_id", text.alias("text")).select(
        "event_id", "text", calendar.parse_ymd(F.col("text")).alias("parsed")
    )


@query
def cast_prefix_int(spark, sf_dir):
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(user, F.lit("abc")))
        .when(kind == "view", F.concat(F.lit("  -"), event, F.lit(".7 ")))
        .when(kind == "signup", F.concat(user, F.lit("99999999999999999999")))
        .when(kind == "purchase", F.col("props"))
    )
    rows = events(spark, sf_dir).select("event_id", text.alias("text"))
    return rows.select(
        "event_id", "text", cleaning.prefix_int(F.col("text")).alias("number"),
        cleaning.prefix_int(F.col("text"), "reject").alias("number_or_null"),
    )


@query
def blank_to_null(spark, sf_dir):
    kind = F.col("event_type")
    text = F.when(kind == "click", "   ").when(kind == "view", "").when(
        kind == "signup", F.concat(F.lit("\t"), "props", F.lit("  "))
    ).otherwise(F.concat(F.lit(" "), "props"))
    return events(spark, sf_dir).select("event_id", cleaning.blank_to_null(text).alias("text"))


@query
def grade_name_normalise(spark, sf_dir):
    return views.raw_pupil(spark, sf_dir).select(
        F.col("_row").alias("event_id"), "GradeName", cleaning.grade_name(F.col("GradeName")).alias("grade_name")
    )


@query
def stream_normalise(spark, sf_dir):
    return views.raw_pupil(spark, sf_dir).select(
        F.col("_row").alias("event_id"), cleaning.stream_name(F.col("Stream")).alias("stream")
    )


@query
def batch_id_md5(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", calendar.batch_id(F.col("ts")).alias("prcs_id"))


# Extracts, raw and stage

def deliver(rows: DataFrame, columns: tuple[str, ...], path: str) -> str:
    rows.select(*columns).write.options(
        **extracts.CSV_OPTIONS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return path


def with_markers(raw: DataFrame) -> DataFrame:
    """The extract with missing-value markers, quotes and commas in the middle name."""
    kind = F.col("Status")
    return raw.withColumn(
        "MiddleName",
        F.when(kind == "click", "NA").when(kind == "view", "NULL").when(kind == "error", "n/a")
        .when(kind == "signup", 'Ann "A", O\'Neil').otherwise(" "),
    )


@query
def csv_raw_load(spark, sf_dir):
    path = Scratch(spark).path("pupils")
    deliver(with_markers(views.raw_pupil(spark, sf_dir)), PUPIL_EXTRACT, path)
    return extracts.read_extract(spark, path, PUPIL_EXTRACT).select(*PUPIL_EXTRACT)


@query
def csv_attendance_load(spark, sf_dir):
    path = deliver(views.raw_attendance(spark, sf_dir), ATTENDANCE_EXTRACT, Scratch(spark).path("marks"))
    return extracts.read_extract(spark, path, ATTENDANCE_EXTRACT).select(*ATTENDANCE_EXTRACT)


@query
def csv_to_stage(spark, sf_dir):
    """Extract files in row order; the first row of a key is found again from file, split and row."""
    base = loaded(spark, sf_dir)
    path = Scratch(spark).path("pupils")
    deliver(views.raw_pupil(spark, sf_dir).orderBy("_row"), PUPIL_EXTRACT, path)
    store = base.branch(new_root(spark), [STG_PUPIL.name])
    insert_ignore(store, STG_PUPIL.name, stage.clean_pupil(extracts.read_extract(spark, path, PUPIL_EXTRACT)))
    return store.read(STG_PUPIL.name)


@query
def stream_to_stage(spark, sf_dir):
    base, scratch = loaded(spark, sf_dir), Scratch(spark)
    path = deliver(views.raw_attendance(spark, sf_dir).orderBy("_row"), ATTENDANCE_EXTRACT, scratch.path("marks"))
    store = base.branch(new_root(spark), [STG_ATTENDANCE.name])
    checkpoint = scratch.path("progress")
    for _ in range(2):
        intake.stage_arrivals(store, STG_ATTENDANCE.name, path, checkpoint).awaitTermination()
    return store.read(STG_ATTENDANCE.name)


@query
def raw_full_replace(spark, sf_dir):
    scratch, store = Scratch(spark), Store(spark, new_root(spark))
    pupils = views.raw_pupil(spark, sf_dir)
    marks = deliver(views.raw_attendance(spark, sf_dir), ATTENDANCE_EXTRACT, scratch.path("marks"))
    first = deliver(pupils, PUPIL_EXTRACT, scratch.path("pupils"))
    second = deliver(pupils.withColumn("Status", F.upper("Status")), PUPIL_EXTRACT, scratch.path("pupils"))
    for delivery in (first, second):
        extracts.load_raw(store, delivery, marks)
    return store.read("raw_pupil").groupBy("SnapshotDate", "Status").agg(F.count(F.lit(1)).alias("n"))


def deliver_malformed(marks: DataFrame, path: str) -> str:
    """Attendance lines of which every tenth has a cell too many, one too few, a line break in a quoted cell, or quotes
    and a comma in one."""
    kind, start = F.col("_row") % 10, F.concat_ws(",", "Date", "PupilID")
    lines = (
        F.when(kind == 0, F.array(F.concat_ws(",", start, "Attendance", F.lit("extra"))))
        .when(kind == 1, F.array(start))
        .when(kind == 2, F.array(F.concat(start, F.lit(',"Pre')), F.concat(F.lit("sent, "), F.col("_row").cast("string"), F.lit('"'))))
        .when(kind == 3, F.array(F.concat(start, F.lit(',"a, ""b"""'))))
        .otherwise(F.array(F.concat_ws(",", start, "Attendance")))
    )
    # The lines of a row stay together and in order; the header is the name of the only column.
    rows = marks.select("_row", F.posexplode(lines)).repartitionByRange("_row").sortWithinPartitions("_row", "pos")
    rows.select(F.col("col").alias(",".join(ATTENDANCE_EXTRACT))).write.options(
        header="true", sep="\u0001", quote="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return path


@query
def csv_malformed_rows(spark, sf_dir):
    """Every line ends up as a kept or a rejected row."""
    path = deliver_malformed(views.raw_attendance(spark, sf_dir), Scratch(spark).path("marks"))
    scan = Scratch(spark).keep(extracts.scan_extract(spark, path, ATTENDANCE_EXTRACT), "scan")
    kept = extracts.kept_rows(scan).select(
        *ATTENDANCE_EXTRACT, F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("reason")
    )
    rejected = extracts.rejected_rows(scan, "raw_pupil_attendance").select(
        F.col("first_cell").alias("Date"), F.lit(None).cast("string").alias("PupilID"),
        F.lit(None).cast("string").alias("Attendance"), "text", "reason",
    )
    return kept.unionByName(rejected)


@query
def stream_malformed_rows(spark, sf_dir):
    """The same lines as files of a stream: what is staged, and how many rows were rejected."""
    base, scratch = loaded(spark, sf_dir), Scratch(spark)
    path = deliver_malformed(views.raw_attendance(spark, sf_dir), scratch.path("marks"))
    store = base.branch(new_root(spark), [STG_ATTENDANCE.name, RAW_REJECTED.name])
    for _ in range(2):
        intake.stage_arrivals(store, STG_ATTENDANCE.name, path, scratch.path("progress")).awaitTermination()
    rejected = store.read(RAW_REJECTED.name).agg(F.count(F.lit(1)).alias("rejected"))
    return store.read(STG_ATTENDANCE.name).join(F.broadcast(rejected))


@query
def replace_cut_off(spark, sf_dir):
    """Raw and published rows after a replacement that fails halfway: those of before."""
    base, store, target = loaded(spark, sf_dir), Store(spark, new_root(spark)), ParquetTarget(spark, new_root(spark))
    rows = base.read("raw_pupil")
    broken = rows.withColumn("Status", F.when(F.col("_row") % 1000 == 7, F.raise_error(F.lit("cut off"))).otherwise("lost"))
    for place in (store, target):
        place.replace("raw_pupil", rows.withColumn("Status", F.lit("first")))
        place.replace("raw_pupil", rows)
        try:
            place.replace("raw_pupil", broken)
        except Exception as error:  # noqa: BLE001
            if "cut off" not in str(error):
                raise
    kept = {"raw": store.read("raw_pupil"), "published": target.read("raw_pupil", TABLES["raw_pupil"].schema)}
    return reduce(DataFrame.unionByName, (
        rows.groupBy("SnapshotDate", "Status").agg(F.count(F.lit(1)).alias("n")).withColumn("place", F.lit(place))
        for place, rows in kept.items()
    ))


@query
def stg_pupil_clean(spark, sf_dir):
    return loaded(spark, sf_dir).read(STG_PUPIL.name)


@query
def stg_attendance_clean(spark, sf_dir):
    return loaded(spark, sf_dir).read(STG_ATTENDANCE.name)


@query
def stage_insert_ignore(spark, sf_dir):
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), [STG_PUPIL.name])
    rows = stage.clean_pupil(base.read("raw_pupil"))
    first = rows.where(F.col("snapshot_date") <= DAY % 20)
    second = rows.where(F.col("snapshot_date") >= DAY % 15).withColumn("status", F.upper("status"))
    for batch in (first, second, second):
        insert_ignore(store, STG_PUPIL.name, batch)
    return store.read(STG_PUPIL.name)


@query
def empty_tables_created(spark, sf_dir):
    own = ["dim_date", "dim_pupil", "dim_academy", "dim_grade", "dim_stream", FACT.name]
    store = loaded(spark, sf_dir).branch(new_root(spark), own)
    store.create_missing()
    created = store.create_missing()
    return store.row_counts().withColumn("created_again", F.col("table_name").isin(created))


@query
def truncate_all_counts(spark, sf_dir):
    base, store, scratch = loaded(spark, sf_dir), Store(spark, new_root(spark)), Scratch(spark)
    for name in ("raw_pupil", "raw_pupil_attendance", STG_PUPIL.name, STG_ATTENDANCE.name):
        store.append(name, base.read(name))
    dims.load_dims(store)
    before = scratch.keep(store.row_counts().withColumnRenamed("row_count", "rows_before"), "before")
    store.truncate_all()
    return before.join(store.row_counts().withColumnRenamed("row_count", "rows_after"), "table_name")


@query
def drop_all_counts(spark, sf_dir):
    """Rows per table before all tables are dropped, and whether the tables are there afterwards."""
    base, store, scratch = loaded(spark, sf_dir), Store(spark, new_root(spark)), Scratch(spark)
    for name in ("raw_pupil", "raw_pupil_attendance", STG_PUPIL.name, STG_ATTENDANCE.name, FACT.name):
        store.append(name, base.read(name))
    dims.load_dims(store)
    before = scratch.keep(store.row_counts().withColumnRenamed("row_count", "rows_before"), "before")
    store.drop_all()
    left = [table.name for table in WAREHOUSE if store.exists(table.name)]
    return before.join(store.row_counts().withColumnRenamed("row_count", "rows_after"), "table_name").withColumn(
        "exists_after", F.col("table_name").isin(left)
    )


# Dimensions

def _dimension(name: str):
    return lambda spark, sf_dir: loaded(spark, sf_dir).read(name)


for _query, _table in (
    ("dim_date_build", "dim_date"), ("dim_pupil_build", "dim_pupil"), ("dim_academy_build", "dim_academy"),
    ("dim_grade_build", "dim_grade"), ("dim_stream_build", "dim_stream"),
):
    REGISTRY[_query] = _dimension(_table)


@query
def dim_incremental_keys(spark, sf_dir):
    store = loaded(spark, sf_dir).branch(new_root(spark), ["dim_pupil"])
    staged = store.read(STG_PUPIL.name)
    for rows in (staged.where(F.col("snapshot_date") == DAY % 1), staged, staged):
        dims.extend_dimension(store, dims.PUPIL, rows)
    return store.read("dim_pupil")


ATTRIBUTES = {"dim_academy": "academy_name", "dim_grade": "grade_id", "dim_stream": "stream"}


@query
def dims_two_batches(spark, sf_dir):
    """School, grade and class stream from the first day, then from all others: later members get the next keys."""
    store = loaded(spark, sf_dir).branch(new_root(spark), list(ATTRIBUTES))
    first, *later = store.days(STG_PUPIL.name)
    for days in ([first], later, later):
        dims.load_dims(store.branch(store.root, [*ATTRIBUTES, "dim_date", "dim_pupil"]), days)
    return reduce(DataFrame.unionByName, (
        store.read(name).select(
            F.lit(name).alias("dimension"), F.col(TABLES[name].key[0]).alias("member_key"), F.col(natural).cast("string").alias("member")
        ) for name, natural in ATTRIBUTES.items()
    ))


def renamed_by_day(raw: DataFrame) -> DataFrame:
    """Pupils and grades whose names change from day to day, the middle class among them."""
    day = F.substring("SnapshotDate", 9, 2)
    changing = (F.col("GradeId").cast("long") % 3 == 0) & (day.cast("int") % 2 == 0)
    return raw.withColumns({
        "FirstName": F.concat("FirstName", day), "GradeName": F.when(changing, " middle Class ").otherwise(F.col("GradeName")),
    })


@query
def dim_first_name_wins(spark, sf_dir):
    """Of the names of a pupil or grade the one seen first stays, over several loads."""
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), [STG_PUPIL.name, "dim_date", "dim_pupil", *ATTRIBUTES])
    insert_ignore(store, STG_PUPIL.name, stage.clean_pupil(renamed_by_day(base.read("raw_pupil"))))
    days = store.days(STG_PUPIL.name)
    for part in (days[1:4], days):
        dims.load_dims(store, part)
    pupils = store.read("dim_pupil").select(
        F.lit("pupil").alias("dimension"), F.col("pupil_id").alias("id"), F.concat_ws(" ", "first_name", "last_name").alias("name")
    )
    grades = store.read("dim_grade").select(F.lit("grade").alias("dimension"), F.col("grade_id").alias("id"), F.col("grade_name").alias("name"))
    return pupils.unionByName(grades)


@query
def distinct_multi_col(spark, sf_dir):
    return loaded(spark, sf_dir).read(STG_PUPIL.name).select("pupil_id", "first_name", "last_name").distinct()


# Joins

@query
def join_scalar_config(spark, sf_dir):
    base = loaded(spark, sf_dir)
    config = fact.target_date(base.branch(new_root(spark), [FACT.name]).read(FACT.name), base.read("dim_date"))
    staged = base.read(STG_PUPIL.name)
    return staged.join(F.broadcast(config), F.col("snapshot_date") == F.col("target_date")).select(
        "target_date", "pupil_id", "academy_name", "status"
    )


@query
def join_inner_multikey(spark, sf_dir):
    base = loaded(spark, sf_dir)
    return fact.staged_with_marks(base.read(STG_PUPIL.name), base.read(STG_ATTENDANCE.name)).select(
        "snapshot_date", "pupil_id", "status", "attendance"
    )


@query
def join_left_dims(spark, sf_dir):
    base = loaded(spark, sf_dir)
    return (
        base.read(STG_PUPIL.name)
        .join(base.read("dim_academy"), "academy_name", "left")
        .join(base.read("dim_grade").select("grade_id", "grade_key"), "grade_id", "left")
        .join(base.read("dim_stream"), "stream", "left")
        .select("snapshot_date", "pupil_id", "academy_key", "grade_key", "stream_key")
    )


@query
def semi_join_exists(spark, sf_dir):
    base = loaded(spark, sf_dir)
    marks = base.read(STG_ATTENDANCE.name).withColumnRenamed("attendance_date", "snapshot_date")
    return base.read(STG_PUPIL.name).join(marks, ["snapshot_date", "pupil_id"], "left_semi").select(
        "snapshot_date", "pupil_id", "status"
    )


@query
def anti_join_new_rows(spark, sf_dir):
    base = loaded(spark, sf_dir)
    marks = base.read(STG_ATTENDANCE.name).withColumnRenamed("attendance_date", "snapshot_date")
    return unknown_keys(base.read(STG_PUPIL.name), marks, STG_PUPIL.key).select("snapshot_date", "pupil_id", "status")


# Daily fact

def daily_loads(store: Store, advance: str = fact.STRICT, runs: int | None = None) -> list[fact.LoadResult]:
    """Run daily loads until one loads nothing; each run has the batch id of its place in the sequence."""
    results = []
    for day in store.days(STG_PUPIL.name)[:runs]:
        results.append(fact.load_next(store, day_batch(day), advance))
        if not results[-1].inserted:
            break
    return results


def fact_branch(spark, sf_dir) -> Store:
    return loaded(spark, sf_dir).branch(new_root(spark), [FACT.name])


@query
def fact_target_date(spark, sf_dir):
    base = loaded(spark, sf_dir)
    first = fact_branch(spark, sf_dir).read(FACT.name)
    cases = (("first load", first), ("next load", base.read(FACT.name)))
    return reduce(DataFrame.unionByName, (
        fact.target_date(rows, base.read("dim_date")).select(F.lit(label).alias("load"), "target_date")
        for label, rows in cases
    ))


@query
def fact_first_load(spark, sf_dir):
    store = fact_branch(spark, sf_dir)
    daily_loads(store, runs=1)
    return store.read(FACT.name)


@query
def fact_next_day_load(spark, sf_dir):
    store = fact_branch(spark, sf_dir)
    daily_loads(store, runs=2)
    return store.read(FACT.name)


@query
def fact_full_replay(spark, sf_dir):
    store = fact_branch(spark, sf_dir)
    daily_loads(store)
    return store.read(FACT.name)


@query
def fact_history_load(spark, sf_dir):
    return loaded(spark, sf_dir).read(FACT.name)


@query
def fact_insert_ignore(spark, sf_dir):
    """Days loaded twice, with pupils and schools that their dimension holds twice: one row per day and pupil, the first."""
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), [FACT.name, "dim_pupil", "dim_academy", "attendance_rate"])
    pupils, academies = base.read("dim_pupil"), base.read("dim_academy")
    store.append("dim_pupil", pupils.unionByName(pupils.where(F.col("pupil_id") % 7 == 0)))
    store.append("dim_academy", academies.unionByName(academies.withColumn("academy_key", F.col("academy_key") + 1000)))
    for n, batch in ((1, 1), (2, 2), (2, 3), (1, 1)):
        fact.insert_day(store, date(2024, 1, n), day_batch(date(2024, 1, batch)))
    return store.read(FACT.name)


@query
def fact_load_log(spark, sf_dir):
    """Batch, day and rows of a history load and of three daily loads."""
    store = fact_branch(spark, sf_dir)
    daily_loads(store, runs=3)
    return reduce(DataFrame.unionByName, (
        spark.createDataFrame(log, "prcs_id string, fact_date date, n bigint").withColumn("load", F.lit(load))
        for load, log in (("history", loaded(spark, sf_dir).load_log()), ("daily", store.load_log()))
    ))


@query
def fact_history_gap(spark, sf_dir):
    """A day whose marks belong to nobody who was staged ends a history load where daily loads would stall."""
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), [STG_ATTENDANCE.name, FACT.name])
    stranger = F.when(F.col("attendance_date") == DAY % 10, F.col("pupil_id") + 1_000_000_000).otherwise(F.col("pupil_id"))
    store.append(STG_ATTENDANCE.name, base.read(STG_ATTENDANCE.name).withColumn("pupil_id", stranger))
    fact.load_history(store, calendar.date_key)
    return store.read(FACT.name).groupBy("fact_date").agg(F.count(F.lit(1)).alias("n"))


def school_days(spark, sf_dir) -> Store:
    """A store whose stage has no weekends, which is where strict loading stops."""
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), [STG_PUPIL.name, STG_ATTENDANCE.name, FACT.name])
    for table in (STG_PUPIL, STG_ATTENDANCE):
        store.append(table.name, base.read(table.name).where(~F.dayofweek(table.day).isin(1, 7)))
    return store


def _by_day(store: Store, results: list[fact.LoadResult]) -> DataFrame:
    return store.read(FACT.name).groupBy("fact_date").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "stalled", F.lit(results[-1].stalled)
    )


@query
def fact_gap_stall(spark, sf_dir):
    store = school_days(spark, sf_dir)
    return _by_day(store, daily_loads(store))


@query
def fact_next_available(spark, sf_dir):
    store = school_days(spark, sf_dir)
    return _by_day(store, daily_loads(store, fact.NEXT_AVAILABLE))


@query
def load_summary(spark, sf_dir):
    store = fact_branch(spark, sf_dir)
    return fact.load_summary(store, daily_loads(store, runs=2)[-1])


@query
def late_rows_report(spark, sf_dir):
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), [STG_PUPIL.name, FACT.name])
    rows = stage.clean_pupil(base.read("raw_pupil"))
    late = (F.col("snapshot_date") <= DAY % 5) & (F.col("stream") == "BUILDING")
    insert_ignore(store, STG_PUPIL.name, rows.where(~F.coalesce(late, F.lit(False))))
    fact.load_history(store, calendar.date_key, fact.STRICT)
    insert_ignore(store, STG_PUPIL.name, rows)
    return fact.late_rows(store)


# Whole runs

@query
def daily_run(spark, sf_dir):
    """Two daily runs from extract files: all steps, and the fact after its second day."""
    scratch, store = Scratch(spark), Store(spark, new_root(spark))
    pupils = deliver(views.raw_pupil(spark, sf_dir).orderBy("_row"), PUPIL_EXTRACT, scratch.path("pupils"))
    marks = deliver(views.raw_attendance(spark, sf_dir).orderBy("_row"), ATTENDANCE_EXTRACT, scratch.path("marks"))
    for n in (1, 2):
        daily.run_daily(store, pupils, marks, day_batch(date(2024, 1, n)))
    return store.read(FACT.name)


@query
def reporting_run(spark, sf_dir):
    """Publish, build the marts and list the failing tests instead of raising."""
    own = [table.name for table in MARTS]
    store = loaded(spark, sf_dir).branch(new_root(spark), own)
    result = daily.run_reporting(store, ParquetTarget(spark, new_root(spark)), severity="warn")
    return spark.createDataFrame(
        result.failures, "table_name string, column_name string, test string, failures bigint"
    )


@query
def publish_refused(spark, sf_dir):
    """A reporting run over a dimension with repeated members and one with a missing member: the failing tests of the keys,
    and that nothing was published."""
    base, target = loaded(spark, sf_dir), ParquetTarget(spark, new_root(spark))
    store = base.branch(new_root(spark), [FACT.name, "dim_pupil", "dim_grade", *(table.name for table in MARTS)])
    pupils = base.read("dim_pupil")
    store.append("dim_pupil", pupils.unionByName(pupils.where(F.col("pupil_id") % 7 == 0)))
    store.append("dim_grade", base.read("dim_grade"))
    daily_loads(store, runs=1)
    store.replace("dim_grade", store.read("dim_grade").where(F.col("grade_name") != "Top Class"))
    try:
        daily.run_reporting(store, target, severity="warn")
        failures = []
    except checks.DataTestFailure as refused:
        failures = refused.failures
    found = sum(target.folders.exists(target.path(table.name)) for table in (*sync.PUBLISHED, *MARTS))
    return spark.createDataFrame(
        [*failures, ("published", "", "", found)], "table_name string, column_name string, test string, failures bigint"
    )


@query
def marts_published(spark, sf_dir):
    """The marts as they are read from the target, after it got all days but ten and then all."""
    base, target = loaded(spark, sf_dir), ParquetTarget(spark, new_root(spark))
    store = base.branch(new_root(spark), [FACT.name, *(table.name for table in MARTS)])
    rows = base.read(FACT.name)
    for part in (F.col("fact_date") <= DAY % 20, F.col("fact_date") > DAY % 20):
        store.append(FACT.name, rows.where(part))
        daily.run_reporting(store, target, severity="warn")
    parts = {
        "attendance_rate": ("fact_date", "academy_name", "grade_name", "attendance_rate", "total_pupils_presented"),
        "absenteeism_weekday": ("weekday", None, None, "avg_absenteeism_rate", "academies_count"),
        "academy_benchmarks": ("academy_name", None, None, "overall_attendance_rate", "total_unique_pupils"),
    }
    return reduce(DataFrame.unionByName, (
        target.read(name, TABLES[name].schema).select(
            F.lit(name).alias("mart"),
            *((F.col(c).cast("string") if c else F.lit(None).cast("string")).alias(f"k{i}") for i, c in enumerate(columns[:3], 1)),
            F.round(columns[3], 6).alias("rate"), F.col(columns[4]).alias("n"),
        ) for name, columns in parts.items()
    ))


@query
def marts_from_increments(spark, sf_dir):
    """The two small marts after four builds: ten days, ten more, one day gone again, the rest."""
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), [FACT.name, *(table.name for table in MARTS)])
    rows, day = base.read(FACT.name), F.col("fact_date")
    for part in (day <= DAY % 10, (day > DAY % 10) & (day <= DAY % 20)):
        store.append(FACT.name, rows.where(part))
        marts.build_marts(store)
    store.drop_days(FACT.name, [date(2024, 1, 5)])
    marts.build_marts(store)
    store.append(FACT.name, rows.where(day > DAY % 20))
    marts.build_marts(store)
    weekdays, benchmarks = store.read("absenteeism_weekday"), store.read("academy_benchmarks")
    return weekdays.select(
        F.col("weekday").alias("name"), F.round("avg_absenteeism_rate", 6).alias("rate"),
        F.round("avg_daily_pupils", 6).alias("pupils"), F.col("academies_count").alias("n"),
    ).unionByName(benchmarks.select(
        F.col("academy_name").alias("name"), F.round("overall_attendance_rate", 6).alias("rate"),
        F.col("total_unique_pupils").cast("double").alias("pupils"), F.col("rank").cast("bigint").alias("n"),
    ))


# Marts

@query
def mart_attendance_rate(spark, sf_dir):
    base = loaded(spark, sf_dir)
    return marts.attendance_rate(*(base.read(n) for n in (FACT.name, "dim_academy", "dim_grade", "dim_date")))


@query
def mart_absenteeism_weekday(spark, sf_dir):
    return marts.absenteeism_weekday(loaded(spark, sf_dir).read("attendance_rate")).withColumns({
        c: F.round(c, 6) for c in ("avg_absenteeism_rate", "avg_daily_pupils")
    })


@query
def mart_academy_benchmarks(spark, sf_dir):
    base = loaded(spark, sf_dir)
    return marts.academy_benchmarks(base.read(FACT.name), base.read("dim_academy"), Scratch(spark))


@query
def attendance_rate_ordered(spark, sf_dir):
    rows = loaded(spark, sf_dir).read("attendance_rate")
    return marts.positioned(rows, marts.rate_order(), Scratch(spark)).select(
        "pos", "fact_date", "academy_name", "grade_name", "attendance_rate"
    )


@query
def weekday_ordered(spark, sf_dir):
    rows = loaded(spark, sf_dir).read("absenteeism_weekday").withColumn(
        "avg_absenteeism_rate", F.round("avg_absenteeism_rate", 6)
    )
    return marts.positioned(rows, marts.weekday_order(), Scratch(spark)).select("pos", "weekday", "academies_count")


@query
def benchmarks_ordered(spark, sf_dir):
    rows = loaded(spark, sf_dir).read("academy_benchmarks")
    return marts.positioned(rows, marts.benchmark_order(), Scratch(spark)).select("pos", "academy_name", "rank")


@query
def table_counts(spark, sf_dir):
    # One row per warehouse table, so the window never holds more than ten.
    position = F.row_number().over(Window.orderBy(*layer_order()))
    return loaded(spark, sf_dir).row_counts().withColumn("pos", position)


@query
def literal_union_null(spark, sf_dir):
    ids = loaded(spark, sf_dir).read(STG_PUPIL.name).select(F.col("grade_id").alias("id"))
    return marts.base_model(ids)


@query
def model_chain_filter(spark, sf_dir):
    base = Scratch(spark).keep(literal_union_null(spark, sf_dir), "base_model")
    return marts.child_model(base)


# Data tests

@query
def dq_not_null(spark, sf_dir):
    return checks.not_null_checks(loaded(spark, sf_dir))


@query
def dq_unique(spark, sf_dir):
    base = loaded(spark, sf_dir)
    delivered = stage.clean_pupil(base.read("raw_pupil"))
    return checks.unique_checks(base).unionByName(checks.unique(delivered, "raw_pupil", STG_PUPIL.key))


@query
def dq_primary_keys(spark, sf_dir):
    return checks.key_checks(loaded(spark, sf_dir))


@query
def dq_foreign_keys(spark, sf_dir):
    return checks.foreign_key_checks(loaded(spark, sf_dir))


@query
def dq_foreign_keys_orphans(spark, sf_dir):
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), ["dim_stream", "dim_grade"])
    store.append("dim_grade", base.read("dim_grade").where(F.col("grade_name") != "Top Class"))
    return checks.foreign_key_checks(store)


# Publishing

def _published(target, store: Store) -> DataFrame:
    """Rows per published table and the sum of its first key column."""
    sums = {"dim_date": "date_key", FACT.name: "pupil_key"}
    return reduce(DataFrame.unionByName, (
        target.read(name, TABLES[name].schema).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(sums.get(name, TABLES[name].columns[0])).cast("bigint")).alias("key_sum"),
        ).select(F.lit(name).alias("table_name"), "row_count", "key_sum")
        for name in (table.name for table in sync.PUBLISHED)
    ))


@query
def sync_full(spark, sf_dir):
    base, target = loaded(spark, sf_dir), ParquetTarget(spark, new_root(spark))
    sync.sync_all(base, target)
    sync.sync_all(base, target)
    return _published(target, base)


@query
def sync_batch_only(spark, sf_dir):
    base, target = loaded(spark, sf_dir), ParquetTarget(spark, new_root(spark))
    last = base.days(FACT.name)[-1]
    sync.sync_table(base, FACT.name, target)
    sync.sync_table(base, FACT.name, target, sync.BATCH_REPLACE, day_batch(last), last)
    return target.read(FACT.name, FACT.schema)


@query
def sync_batch_append(spark, sf_dir):
    base, target = loaded(spark, sf_dir), ParquetTarget(spark, new_root(spark))
    first, second = base.days(FACT.name)[:2]
    for day in (first, second, second):
        sync.sync_table(base, FACT.name, target, sync.BATCH_APPEND, day_batch(day))
    return target.read(FACT.name, FACT.schema)


@query
def sync_empty_skipped(spark, sf_dir):
    base, target = loaded(spark, sf_dir), ParquetTarget(spark, new_root(spark))
    sync.sync_all(base, target)
    results = sync.sync_all(fact_branch(spark, sf_dir), target)
    skipped = [r.table for r in results if r.skipped]
    return _published(target, base).withColumn("skipped", F.col("table_name").isin(skipped))


@query
def sync_tsv_roundtrip(spark, sf_dir):
    rows = with_markers(views.raw_pupil(spark, sf_dir)).select(
        F.col("_row").alias("event_id"), "AcademyName", F.concat("Status", F.lit('\t"x" \\')).alias("Status"),
        "MiddleName", "GradeName", "Stream",
    )
    target = TsvTarget(spark, new_root(spark))
    target.replace("extract", rows)
    return target.read("extract", rows.schema)


@query
def adhoc_sql_file(spark, sf_dir):
    base = loaded(spark, sf_dir)
    args = {"status": "purchase"}
    return sqlfile.run_sql_file(base, str(SQL_FILES / "status_report.sql"), args)[-1]


@query
def adhoc_sql_writes(spark, sf_dir):
    """A file that inserts, deletes and updates, with the rows that each statement changed, and two inserts that the keys
    refuse: what the tables hold in the end."""
    base = loaded(spark, sf_dir)
    store = base.branch(new_root(spark), ["dim_stream", "dim_pupil"])
    for name in ("dim_stream", "dim_pupil"):
        store.append(name, base.read(name))
    results = sqlfile.run_statements(store, str(SQL_FILES / "members.sql"), {"suffix": "; x"})
    refused = 0
    for rows in ("SELECT stream_key, 'other' FROM dim_stream", "SELECT stream_key + 5000, stream FROM dim_stream"):
        try:
            sqlfile.run_text(store, f"INSERT INTO dim_stream {rows}")
        except sqlfile.IntegrityError:
            refused += 1
    counts = [(r.kind, r.affected if r.affected is not None else r.rows.first()["n"]) for r in results] + [("refused", refused)]
    held = store.read("dim_stream").select("stream", F.col("stream_key").alias("n")).unionByName(
        store.read("dim_pupil").select(F.concat_ws(" ", "first_name", "last_name").alias("stream"), F.col("pupil_key").alias("n"))
    )
    return held.unionByName(spark.createDataFrame(counts, "stream string, n bigint")).withColumnRenamed("stream", "name")


@query
def sync_full_rows(spark, sf_dir):
    """The published fact, whole rows, after it was published twice."""
    base, target = loaded(spark, sf_dir), ParquetTarget(spark, new_root(spark))
    for _ in range(2):
        sync.sync_table(base, FACT.name, target)
    return target.read(FACT.name, FACT.schema)
