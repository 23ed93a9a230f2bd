"""Rows that several tests begin with."""

from __future__ import annotations


def snapshot(day, pupil, academy="North", first="Ann", last="Lee", status="In", grade_id="1", grade="PRIMARY1", stream="a"):
    return (day, pupil, academy, first, last, status, grade_id, grade, stream)
