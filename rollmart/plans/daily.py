"""The whole runs: extracts to fact, and fact to published tables, marts and tests."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from ..functions.calendar import new_batch_id
from ..operators.keyed import InsertResult
from ..sources.extracts import AUTO, load_raw
from ..schemas import MARTS
from ..sources.store import Store
from . import fact
from .checks import check_keys, run_checks
from .dims import load_dims
from .marts import build_marts
from .stage import load_stage
from .sync import FULL, SyncResult, sync_all


@dataclass(frozen=True)
class DailyResult:
    raw: dict[str, int]
    stage: tuple[InsertResult, InsertResult]
    dims: dict[str, int]
    fact: fact.LoadResult
    rejected: dict[str, int]


@dataclass(frozen=True)
class ReportingResult:
    synced: list[SyncResult]
    marts: dict[str, int]
    failures: list[tuple[str, str, str, int]]
    published_marts: dict[str, int]


def load_stage_and_dims(
    store: Store, unreadable: str = "zero"
) -> tuple[tuple[InsertResult, InsertResult], dict[str, int]]:
    """Stage, then the dimensions over all days that got rows since they were last extended, be it by this run, by
    one that was cut off or by a stream.

    After a run that was cut off while staging, those days are not known and the whole stage is read.
    """
    staged = load_stage(store, unreadable)
    noted = store.noted_days()
    if store.is_open("stage"):
        added = load_dims(store)
    elif noted:
        added = load_dims(store, noted)
    else:
        added = {}
    store.strike_days(noted)
    store.close_step("stage")
    return staged, added


def run_daily(
    store: Store, pupil_csv: str, attendance_csv: str, batch_id: str,
    advance: str = fact.STRICT, unreadable: str = "zero", multiline: bool | str = AUTO, malformed: str = "reject",
) -> DailyResult:
    """One daily run: tables, raw, stage, dimensions, next fact day, and the test of its keys.

    Every step may be repeated. A repeated key or a missing member raises; the day then stays in doubt, and no
    reporting run publishes anything before it passes.
    """
    store.create_missing()
    raw = load_raw(store, pupil_csv, attendance_csv, multiline, malformed)
    staged, added = load_stage_and_dims(store, unreadable)
    result = fact.load_next(store, batch_id, advance)
    check_keys(store)
    return DailyResult(raw.rows, staged, added, result, raw.rejected)


def run_reporting(
    store: Store, target, mode: str = FULL, batch_id: str | None = None, day: date | None = None,
    severity: str = "error", rebuild: bool = False,
) -> ReportingResult:
    """Test the keys of new fact days, publish the tables, build and publish the marts, and only then test these; a
    failing test fails the run."""
    check_keys(store)
    synced = sync_all(store, target, mode, batch_id, day)
    marts = build_marts(store, rebuild)
    published = {mart.name: target.replace(mart.name, store.read(mart.name)) for mart in MARTS}
    return ReportingResult(synced, marts, run_checks(store, severity), published)


def run_day(
    store: Store, pupil_csv: str, attendance_csv: str, target, mode: str = FULL, severity: str = "error", **options
) -> tuple[DailyResult, ReportingResult]:
    """A daily run and the reporting run it hands its batch id to."""
    batch_id = new_batch_id()
    loaded = run_daily(store, pupil_csv, attendance_csv, batch_id, **options)
    day = loaded.fact.target if loaded.fact.inserted else None
    return loaded, run_reporting(store, target, mode, batch_id, day, severity)
