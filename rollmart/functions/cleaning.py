"""Text cleaning expressions of the staging step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that stand for a missing value in the extracts.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The canonical grade names.
GRADES = (
    "Primary 1", "Primary 2", "Primary 3", "Primary 4", "Primary 5", "Primary 6", "Primary 7",
    "Baby Class", "Middle Class", "Top Class",
)

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def marker_to_null(cell: Column) -> Column:
    return F.when(~cell.isin(*NULL_MARKERS), cell)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def prefix_int(text: Column, unreadable: str = "zero") -> Column:
    """Integer at the start of a text; texts without one give 0 (``zero``) or NULL (``reject``).

    Numbers beyond 64 bits stop at the nearest bound, as the text-to-integer cast being matched does.
    """
    if unreadable not in ("zero", "reject"):
        raise ValueError(f"unreadable must be 'zero' or 'reject', not {unreadable!r}")
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)", 1)
    number = F.coalesce(
        digits.try_cast("bigint"),
        F.when(digits.startswith("-"), F.lit(LONG_MIN)).when(digits != "", F.lit(LONG_MAX)),
    )
    if unreadable == "reject":
        return number
    return F.when(text.isNotNull(), F.coalesce(number, F.lit(0).cast("bigint")))


def grade_name(text: Column) -> Column:
    """Canonical grade name, NULL for anything unknown. Only the numbered grades may lack the space."""
    spoken = F.trim(F.upper(text))
    found = []
    for name in GRADES:
        forms = [name.upper()]
        if name[-1].isdigit():
            forms.append(forms[0].replace(" ", ""))
        found.append(F.when(spoken.isin(*forms), F.lit(name)))
    return F.coalesce(*found)


def stream_name(text: Column) -> Column:
    return F.upper(blank_to_null(text))


def is_present(attendance: Column) -> Column:
    """1 for an exact ``Present``, 0 for any other mark and for none."""
    return F.when(attendance == "Present", 1).otherwise(0)
