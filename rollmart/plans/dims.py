"""Stage to dimensions: members not yet known get the next surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..operators.keyed import all_present, first_per_key, unknown_keys
from ..operators.numbering import assign_keys
from ..schemas import DIM_DATE, STG_PUPIL
from ..session import side_by_side
from ..sources.store import Store


def calendar(days: DataFrame) -> DataFrame:
    """One calendar row per distinct ``snapshot_date``."""
    return days.select("snapshot_date").distinct().select(*calendar_columns(F.col("snapshot_date")))


def attribute_sets(stage: DataFrame) -> DataFrame:
    """The distinct combinations of school, grade and class stream with the day each was first seen.

    One pass over the stage serves three dimensions; the hash aggregate leaves few rows per task.
    """
    return stage.groupBy("academy_name", "grade_id", "grade_name", "stream").agg(
        F.min("snapshot_date").alias("first_seen")
    )


def distinct_members(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).where(F.col(column).isNotNull()).distinct()


def pupil_members(stage: DataFrame) -> DataFrame:
    """One row per pupil with the names of the earliest snapshot."""
    rows = stage.select("pupil_id", "first_name", "last_name", "snapshot_date")
    return first_per_key(rows, ("pupil_id",), ("snapshot_date",)).drop("snapshot_date")


def grade_members(sets: DataFrame) -> DataFrame:
    """One row per grade id; of several names the one seen earliest, then the alphabetically first."""
    named = sets.where(all_present(("grade_id", "grade_name")))
    pairs = named.groupBy("grade_id", "grade_name").agg(F.min("first_seen").alias("first_seen"))
    return first_per_key(pairs, ("grade_id",), ("first_seen", "grade_name")).drop("first_seen")


@dataclass(frozen=True)
class Dimension:
    table: str
    key: str
    natural: str
    members: Callable[[DataFrame], DataFrame]


PUPIL = Dimension("dim_pupil", "pupil_key", "pupil_id", pupil_members)
# The dimensions whose members come from ``attribute_sets``.
ATTRIBUTES = (
    Dimension("dim_academy", "academy_key", "academy_name", lambda sets: distinct_members(sets, "academy_name")),
    Dimension("dim_grade", "grade_key", "grade_id", grade_members),
    Dimension("dim_stream", "stream_key", "stream", lambda sets: distinct_members(sets, "stream")),
)


def extend_dimension(store: Store, dim: Dimension, rows: DataFrame) -> int:
    """Append the members found in ``rows`` that the dimension lacks; returns how many."""
    known = store.read(dim.table)
    with store.scratch() as scratch:
        unseen = unknown_keys(dim.members(rows), known, (dim.natural,))
        fresh, count = scratch.keep_counted(unseen, dim.table)
        if not count:
            return 0
        start = known.agg(F.max(dim.key)).first()[0] or 0
        keyed = assign_keys(fresh, dim.natural, dim.key, start, scratch)
        return store.append(dim.table, keyed)["rows"]


def extend_calendar(store: Store) -> int:
    """Append the stage days the calendar lacks; the days come from the folder listing."""
    days = [(day,) for day in store.days(STG_PUPIL.name)]
    frame = store.spark.createDataFrame(days, "snapshot_date date")
    fresh = unknown_keys(calendar(frame), store.read(DIM_DATE.name), DIM_DATE.key).coalesce(1)
    if fresh.isEmpty():
        return 0
    return store.append(DIM_DATE.name, fresh)["rows"]


def load_dims(store: Store, days: Collection[date] | None = None) -> dict[str, int]:
    """Extend all dimensions; returns the new members of each.

    ``days`` limits the work to the stage days that received rows; without it the whole stage is read.
    """
    held = store.days(STG_PUPIL.name)
    stage = store.read(STG_PUPIL.name, [day for day in held if days is None or day in days])

    def attributes() -> list[int]:
        with store.scratch() as scratch:
            sets = scratch.keep(attribute_sets(stage), "attribute_sets")
            return side_by_side(store.spark, *(partial(extend_dimension, store, dim, sets) for dim in ATTRIBUTES))

    calendar_days, pupils, others = side_by_side(
        store.spark, lambda: extend_calendar(store), lambda: extend_dimension(store, PUPIL, stage), attributes
    )
    names = [DIM_DATE.name, PUPIL.table, *(dim.table for dim in ATTRIBUTES)]
    return dict(zip(names, [calendar_days, pupils, *others]))
