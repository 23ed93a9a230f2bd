"""Publishing warehouse tables to a reporting target."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import unknown_keys
from ..schemas import FACT, PUBLISHED, TABLES
from ..sources.store import Store

FULL, BATCH_REPLACE, BATCH_APPEND = "full", "batch_replace", "batch_append"


@dataclass(frozen=True)
class SyncResult:
    table: str
    rows: int
    skipped: bool


def extract(store: Store, name: str, batch_id: str | None = None, day: date | None = None) -> DataFrame:
    """A whole table, or only one batch of the fact, from the folders of the days that it was loaded to."""
    if name != FACT.name or not batch_id:
        return store.read(name)
    days = batch_days(store, batch_id, day)
    held = None if days is None else [d for d in store.days(name) if d in days]
    return store.read(name, held).where(F.col("prcs_id") == F.lit(batch_id))


def batch_days(store: Store, batch_id: str, day: date | None = None) -> list[date] | None:
    """The days of a batch: the given one, else those of the load log; None for a batch that no load logged."""
    return [day] if day else store.batch_days(batch_id)


def held_rows(store: Store, target, batch_id: str, day: date | None = None) -> DataFrame:
    """What the target holds of a batch of the fact; by day, where the load log knows its days."""
    held = target.read(FACT.name, FACT.schema).where(F.col("prcs_id") == F.lit(batch_id))
    days = batch_days(store, batch_id, day)
    return held if days is None else held.where(F.col(FACT.day).isin(days))


def sync_table(
    store: Store, name: str, target, mode: str = FULL, batch_id: str | None = None, day: date | None = None
) -> SyncResult:
    """Publish one table.

    ``full`` replaces the target by the whole table, ``batch_replace`` by the given batch of the fact, and
    ``batch_append`` adds those rows of the batch the target lacks, so a repeated run adds nothing. The modes
    differ for the fact only. An empty source leaves the target as it is.
    """
    if mode not in (FULL, BATCH_REPLACE, BATCH_APPEND):
        raise ValueError(f"unknown mode {mode!r}")
    if mode != FULL and not batch_id:
        raise ValueError(f"{mode} needs a batch id")
    by_batch = mode != FULL and name == FACT.name
    rows = extract(store, name, batch_id if by_batch else None, day)
    if rows.isEmpty():
        return SyncResult(name, 0, True)
    if not (by_batch and mode == BATCH_APPEND):
        return SyncResult(name, target.replace(name, rows), False)
    held = held_rows(store, target, batch_id, day)
    return SyncResult(name, target.append(name, unknown_keys(rows, held, FACT.key)), False)


def sync_all(
    store: Store, target, mode: str = FULL, batch_id: str | None = None, day: date | None = None
) -> list[SyncResult]:
    """Publish the fact and the dimensions in their fixed order, each on its own."""
    return [sync_table(store, table.name, target, mode, batch_id, day) for table in PUBLISHED]
