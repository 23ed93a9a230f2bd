"""First-wins de-duplication and the insert that ignores known keys."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ROW_ORDER, TABLES, Table
from ..sources.folders import Scratch
from ..sources.store import Store


@dataclass(frozen=True)
class InsertResult:
    table: str
    offered: int
    rejected: int
    inserted: int
    days: tuple[date, ...] = ()


def all_present(columns: tuple[str, ...]) -> Column:
    """True where none of the columns is NULL."""
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def first_per_key(rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The first row of each key.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so every map task sends one row
    per key at most, however many copies a single key has.
    """
    position = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_position", position).where("_position = 1").drop("_position")


def unknown_keys(rows: DataFrame, known: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows whose key is not in ``known``."""
    return rows.join(known.select(*key), list(key), "left_anti")


def possibly_new(
    rows: DataFrame, known: DataFrame, table: Table, days: list[date], other_days: bool, scratch: Scratch,
    order: tuple[str, ...] = ROW_ORDER,
) -> DataFrame | None:
    """The rows of days the table lacks, and of its own ``days`` the first row of each key it lacks; None if neither.

    A full-refresh extract mostly brings rows that are known. Only keys and places of the first rows are shuffled
    to find that out, combined before the shuffle. Whole rows are looked up by key and place: each matches at most
    once, and the copies of a key have different places, so no task gets them all.
    """
    of_known_day = F.col(table.day).isin(days)
    place = F.struct(*order)
    firsts = rows.where(of_known_day).groupBy(*table.key).agg(F.min(place).alias("_place"))
    fresh, count = scratch.keep_counted(unknown_keys(firsts, known, table.key), "keys")
    if not count:
        return rows.where(~of_known_day) if other_days else None
    placed = rows.where(of_known_day).withColumn("_place", place)
    new = placed.join(fresh, [*table.key, "_place"], "left_semi").drop("_place")
    # Rows of other days need no join: the first per key is picked before they are shuffled.
    return new.unionByName(rows.where(~of_known_day)) if other_days else new


def insert_ignore(
    store: Store, name: str, rows: DataFrame, order: tuple[str, ...] = ROW_ORDER
) -> InsertResult:
    """Append the rows of ``rows`` whose key the day-partitioned table lacks.

    Rows with a NULL in a required column are rejected and counted; of several rows with one key the first
    wins; rows of known keys are ignored, so running the same input again adds nothing.
    """
    table = TABLES[name]
    usable = all_present(table.required)
    # One pass over the key columns; one row per calendar day comes to the driver and tells which days of the
    # target are read at all.
    per_day = rows.groupBy(F.when(usable, F.col(table.day)).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    profile = {r["day"]: r["rows"] for r in per_day.collect()}
    offered, rejected = sum(profile.values()), profile.pop(None, 0)
    nothing = InsertResult(name, offered, rejected, 0)
    if not profile:
        return nothing

    rows = rows.where(usable)
    days = [d for d in store.days(name) if d in profile]
    with store.scratch() as scratch:
        if days:
            rows = possibly_new(rows, store.read(name, days), table, days, len(days) < len(profile), scratch, order)
        if rows is None:
            return nothing
        fresh = first_per_key(rows, table.key, order).select(*table.columns)
        # Even files per day: small shuffle partitions are merged and a hot day is split.
        written = store.append(name, fresh.hint("rebalance", table.day))
    return InsertResult(name, offered, rejected, written["rows"], tuple(written["days"]))
