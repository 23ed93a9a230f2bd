from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rollmart.functions import calendar, cleaning


def apply(spark, expression, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_parse_ymd(spark):
    texts = {
        "2025/01/05": date(2025, 1, 5), "2025-01-05": date(2025, 1, 5), "2025/01/05 10:00": date(2025, 1, 5),
        "2025x01y05z": date(2025, 1, 5), "2024/02/29": date(2024, 2, 29),
        "2025/1/5": None, "2025-13-01": None, "2025-02-32": None, "2025-02-30": None, "2025-1/-5": None,
        "2025/01/5 ": None, "2025/01/5T": None, "2025/01/5": None, "2025/01/ 5": None, "2025/ 1/05": None,
        " 2025/01/05": None, "+202/01/05": None, "-202/01/05": None, "2025/1 /05": None, "2025/01/0٥": None,
        "0001/01/01": date(1, 1, 1), "2025/00/10": None, "2025/10/00": None,
        "": None, "20250105": None, "abcd/ef/gh": None,
    }
    assert apply(spark, calendar.parse_ymd, [*texts, None]) == [*texts.values(), None]


def test_prefix_int(spark):
    texts = {
        "12": 12, "12abc": 12, "3.7": 3, " 7 ": 7, "\t\n8": 8, "-5x": -5, "+6": 6, "007": 7, "abc": 0, "": 0,
        "  ": 0, "-": 0, "--3": 0, "1 2": 1, "9223372036854775807": 2**63 - 1, "9223372036854775808": 2**63 - 1,
        "-99999999999999999999": -(2**63),
    }
    assert apply(spark, cleaning.prefix_int, [*texts, None]) == [*texts.values(), None]


def test_prefix_int_reject(spark):
    got = apply(spark, lambda c: cleaning.prefix_int(c, "reject"), ["12abc", "abc", "", None, "0", "99999999999999999999"])
    assert got == [12, None, None, None, 0, 2**63 - 1]
    with pytest.raises(ValueError):
        cleaning.prefix_int(F.lit("1"), "drop")


def test_blank_to_null_trims_spaces_only(spark):
    assert apply(spark, cleaning.blank_to_null, ["  ", "", " a b ", "\ta ", None]) == [None, None, "a b", "\ta", None]


def test_grade_name(spark):
    texts = {
        "PRIMARY1": "Primary 1", "primary 7": "Primary 7", " Primary3 ": "Primary 3", "baby class": "Baby Class",
        "MIDDLE CLASS": "Middle Class", " Top Class": "Top Class", "TOPCLASS": None, "PRIMARY8": None,
        "PRIMARY  1": None, "Nursery": None, "": None,
    }
    assert apply(spark, cleaning.grade_name, [*texts, None]) == [*texts.values(), None]


def test_stream_name(spark):
    assert apply(spark, cleaning.stream_name, [" a ", "é", "  ", "", None]) == ["A", "É", None, None, None]


def test_marker_to_null(spark):
    kept = ["NA ", "na", "none", "0", " ", "Nan"]
    assert apply(spark, cleaning.marker_to_null, [*cleaning.NULL_MARKERS, None, *kept]) == (
        [None] * (len(cleaning.NULL_MARKERS) + 1) + kept
    )


def test_is_present_is_exact(spark):
    assert apply(spark, cleaning.is_present, ["Present", "present", "Absent", None]) == [1, 0, 0, 0]


def test_calendar_columns(spark):
    row = spark.sql("SELECT date'2025-01-05' AS d").select(*calendar.calendar_columns(F.col("d"))).first()
    assert tuple(row) == (20250105, date(2025, 1, 5), 2025, 1, 5, "Sunday")


def test_batch_id(spark):
    moment = datetime(2025, 1, 2, 3, 4, 5, 678999)
    want = hashlib.md5(b"2025-01-02 03:04:05.678").hexdigest()
    assert calendar.new_batch_id(moment) == want
    got = spark.sql("SELECT timestamp_ntz'2025-01-02 03:04:05.678999' AS t").select(calendar.batch_id(F.col("t")))
    assert got.first()[0] == want
    assert len(calendar.new_batch_id()) == 32
