from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rollmart import session  # noqa: E402
from rollmart.schemas import RAW_ATTENDANCE, RAW_PUPIL  # noqa: E402
from rollmart.sources.store import Store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture(scope="session")
def raw(spark):
    """Builds raw frames from short tuples; the place in the list is the row order."""

    def pupils(*rows):
        # day, pupil id, academy, first name, last name, status, grade id, grade name, stream
        full = [
            (day, academy, pupil, first, None, last, status, grade_id, grade, stream, "f", 0, place)
            for place, (day, pupil, academy, first, last, status, grade_id, grade, stream) in enumerate(rows)
        ]
        return spark.createDataFrame(full, RAW_PUPIL.schema)

    def marks(*rows):
        full = [(day, pupil, mark, "f", 0, place) for place, (day, pupil, mark) in enumerate(rows)]
        return spark.createDataFrame(full, RAW_ATTENDANCE.schema)

    pupils.marks = marks
    return pupils
