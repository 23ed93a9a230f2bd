"""Raw to stage: clean, then insert what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import parse_ymd
from ..functions.cleaning import blank_to_null, grade_name, prefix_int, stream_name
from ..operators.keyed import InsertResult, insert_ignore
from ..schemas import RAW_ATTENDANCE, RAW_PUPIL, ROW_ORDER, STG_ATTENDANCE, STG_PUPIL
from ..session import side_by_side
from ..sources.store import Store


def clean_pupil(raw: DataFrame, unreadable: str = "zero") -> DataFrame:
    """Typed pupil snapshots, still with duplicates and unusable keys, plus the row order."""
    return raw.select(
        parse_ymd(F.col("SnapshotDate")).alias("snapshot_date"),
        prefix_int(F.col("PupilID"), unreadable).alias("pupil_id"),
        blank_to_null(F.col("AcademyName")).alias("academy_name"),
        blank_to_null(F.col("FirstName")).alias("first_name"),
        blank_to_null(F.col("LastName")).alias("last_name"),
        blank_to_null(F.col("Status")).alias("status"),
        prefix_int(F.col("GradeId"), unreadable).alias("grade_id"),
        grade_name(F.col("GradeName")).alias("grade_name"),
        stream_name(F.col("Stream")).alias("stream"),
        *ROW_ORDER,
    )


def clean_attendance(raw: DataFrame, unreadable: str = "zero") -> DataFrame:
    """Typed attendance marks; here a blank pupil id is NULL in either mode."""
    return raw.select(
        parse_ymd(F.col("Date")).alias("attendance_date"),
        prefix_int(blank_to_null(F.col("PupilID")), unreadable).alias("pupil_id"),
        blank_to_null(F.col("Attendance")).alias("attendance"),
        *ROW_ORDER,
    )


def stage_pupils(store: Store, rows: DataFrame) -> InsertResult:
    """Insert cleaned pupil rows; the days that got some stay noted until the dimensions have taken them up.

    If a run stops before they are noted, the step stays open and the next dimension load reads the whole stage.
    """
    cut_off = store.open_step("stage")
    staged = insert_ignore(store, STG_PUPIL.name, rows)
    store.note_days(staged.days)
    if not cut_off:
        store.close_step("stage")
    return staged


def stage_marks(store: Store, rows: DataFrame) -> InsertResult:
    """Insert cleaned attendance marks."""
    return insert_ignore(store, STG_ATTENDANCE.name, rows)


def load_stage(store: Store, unreadable: str = "zero") -> tuple[InsertResult, InsertResult]:
    """Move both raw tables on to the stage; the first row ever seen of a key stays."""
    pupils = clean_pupil(store.read(RAW_PUPIL.name), unreadable)
    marks = clean_attendance(store.read(RAW_ATTENDANCE.name), unreadable)
    staged = side_by_side(
        store.spark,
        lambda: stage_pupils(store, pupils),
        lambda: stage_marks(store, marks),
    )
    return staged[0], staged[1]
