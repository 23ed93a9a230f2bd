"""Date and batch-id expressions."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ymd(text: Column) -> Column:
    """Date from positions 1-4, 6-7 and 9-10; any separators, trailing text ignored, NULL if impossible.

    The cast wants four year digits and lets only a day of one digit or with a blank behind it pass, so the
    last position is checked apart.
    """
    iso = F.concat(
        F.substring(text, 1, 4), F.lit("-"), F.substring(text, 6, 2), F.lit("-"), F.substring(text, 9, 2)
    )
    return F.when(F.substring(text, 10, 1).between("0", "9"), iso.try_cast("date"))


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of the date dimension, in table order."""
    return [
        date_key(day).alias("date_key"), day.alias("date"),
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        weekday_name(day).alias("weekday"),
    ]


def batch_id(moment: Column) -> Column:
    """md5 of a timestamp written to the millisecond."""
    return F.md5(F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS").cast("binary"))


def new_batch_id(now: datetime | None = None) -> str:
    """Batch id of a run that starts now (UTC)."""
    now = now or datetime.now(timezone.utc)
    return hashlib.md5(now.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3].encode()).hexdigest()
