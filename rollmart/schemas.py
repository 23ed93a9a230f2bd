"""Registry of the warehouse tables: schema, key, required columns and day partition of each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, LONG, INT, DATE, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.DoubleType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    day: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# File order of an extract row: file, then split offset inside it, then row inside the split.
ROW_ORDER = ("_file", "_block", "_row")
_ORDER_FIELDS = {"_file": STRING, "_block": LONG, "_row": LONG}

PUPIL_EXTRACT = (
    "SnapshotDate", "AcademyName", "PupilID", "FirstName", "MiddleName",
    "LastName", "Status", "GradeId", "GradeName", "Stream",
)
ATTENDANCE_EXTRACT = ("Date", "PupilID", "Attendance")

RAW_PUPIL = Table("raw_pupil", _struct(**dict.fromkeys(PUPIL_EXTRACT, STRING), **_ORDER_FIELDS))
RAW_ATTENDANCE = Table("raw_pupil_attendance", _struct(**dict.fromkeys(ATTENDANCE_EXTRACT, STRING), **_ORDER_FIELDS))

# What no extract row can be made of; replaced with the raw tables, added to by streams.
RAW_REJECTED = Table(
    "raw_rejected", _struct(extract=STRING, first_cell=STRING, text=STRING, reason=STRING, **_ORDER_FIELDS)
)

STG_PUPIL = Table(
    "stg_pupil",
    _struct(
        snapshot_date=DATE, pupil_id=LONG, academy_name=STRING, first_name=STRING, last_name=STRING,
        status=STRING, grade_id=LONG, grade_name=STRING, stream=STRING,
    ),
    key=("pupil_id", "snapshot_date"),
    required=("snapshot_date", "pupil_id"),
    day="snapshot_date",
)
STG_ATTENDANCE = Table(
    "stg_pupil_attendance",
    _struct(attendance_date=DATE, pupil_id=LONG, attendance=STRING),
    key=("pupil_id", "attendance_date"),
    required=("attendance_date", "pupil_id"),
    day="attendance_date",
)

DIM_DATE = Table(
    "dim_date",
    _struct(date_key=INT, date=DATE, year=INT, month=INT, day=INT, weekday=STRING),
    key=("date_key",), required=("date_key", "date"),
)
DIM_PUPIL = Table(
    "dim_pupil",
    _struct(pupil_key=LONG, pupil_id=LONG, first_name=STRING, last_name=STRING),
    key=("pupil_key",), required=("pupil_id",),
)
DIM_ACADEMY = Table(
    "dim_academy", _struct(academy_key=LONG, academy_name=STRING),
    key=("academy_key",), required=("academy_name",),
)
DIM_GRADE = Table(
    "dim_grade", _struct(grade_key=LONG, grade_id=LONG, grade_name=STRING),
    key=("grade_key",), required=("grade_id", "grade_name"),
)
DIM_STREAM = Table(
    "dim_stream", _struct(stream_key=LONG, stream=STRING),
    key=("stream_key",), required=("stream",),
)

FACT = Table(
    "fact_pupil_attendance_daily",
    _struct(
        fact_date=DATE, date_key=INT, pupil_key=LONG, academy_key=LONG, grade_key=LONG, stream_key=LONG,
        status=STRING, attendance=STRING, prcs_id=STRING,
    ),
    key=("fact_date", "pupil_key"),
    required=("fact_date", "date_key", "pupil_key"),
    day="fact_date",
)

MART_RATE = Table(
    "attendance_rate",
    _struct(
        fact_date=DATE, academy_name=STRING, grade_name=STRING, attendance_rate=DOUBLE,
        total_pupils_presented=LONG, year=INT, month=INT, weekday=STRING,
    ),
    key=("fact_date", "academy_name", "grade_name"),
    day="fact_date",
)
MART_WEEKDAY = Table(
    "absenteeism_weekday",
    _struct(weekday=STRING, avg_absenteeism_rate=DOUBLE, avg_daily_pupils=DOUBLE, academies_count=LONG),
    key=("weekday",),
)
MART_BENCHMARKS = Table(
    "academy_benchmarks",
    _struct(academy_name=STRING, overall_attendance_rate=DOUBLE, total_unique_pupils=LONG, rank=INT),
    key=("academy_name",),
)

# What the marts are kept from, extended by the days that are new: sums per day, and who was ever seen where (0: nowhere).
ACADEMY_SUMS = Table(
    "academy_day_sums", _struct(fact_date=DATE, academy_key=LONG, present=LONG, marks=LONG),
    key=("fact_date", "academy_key"), day="fact_date",
)
ACADEMY_PUPILS = Table(
    "academy_pupils", _struct(academy_key=LONG, pupil_key=LONG), key=("academy_key", "pupil_key"),
)
WEEKDAY_SUMS = Table(
    "weekday_day_sums",
    _struct(fact_date=DATE, weekday=STRING, academy_name=STRING, absent_rates=DOUBLE, pupils=LONG, groups=LONG),
    day="fact_date",
)

WAREHOUSE = (
    RAW_PUPIL, RAW_ATTENDANCE, STG_PUPIL, STG_ATTENDANCE,
    DIM_DATE, DIM_PUPIL, DIM_ACADEMY, DIM_GRADE, DIM_STREAM, FACT,
)
MARTS = (MART_RATE, MART_WEEKDAY, MART_BENCHMARKS)
PUBLISHED = (FACT, DIM_DATE, DIM_PUPIL, DIM_ACADEMY, DIM_GRADE, DIM_STREAM)
STATES = (ACADEMY_SUMS, ACADEMY_PUPILS, WEEKDAY_SUMS)
TABLES = {table.name: table for table in (*WAREHOUSE, *MARTS, *STATES, RAW_REJECTED)}

# Natural keys declared UNIQUE besides the primary keys.
UNIQUE_KEYS = {
    "dim_pupil": ("pupil_id",), "dim_academy": ("academy_name",),
    "dim_grade": ("grade_id",), "dim_stream": ("stream",),
}
# Fact column -> dimension that has to hold its value.
FOREIGN_KEYS = {
    "date_key": "dim_date", "pupil_key": "dim_pupil", "academy_key": "dim_academy",
    "grade_key": "dim_grade", "stream_key": "dim_stream",
}
