"""The loaded warehouse that the registered queries read, built once per application and data folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollmart.plans import daily, fact, marts
from rollmart.schemas import RAW_ATTENDANCE, RAW_PUPIL
from rollmart.session import shared_folder
from rollmart.sources.store import Store

from . import views

_built: dict[tuple[str, str], Store] = {}


def batch_of(day: Column) -> Column:
    """Batch id of the run that loads a day; the real one hashes the clock, this one the day."""
    return F.md5(day.cast("string").cast("binary"))


def new_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/rollmart-store-{uuid4().hex}"


def load_raw(store: Store, sf_dir: str) -> None:
    store.replace(RAW_PUPIL.name, views.raw_pupil(store.spark, sf_dir))
    store.replace(RAW_ATTENDANCE.name, views.raw_attendance(store.spark, sf_dir))


def load_fact(store: Store) -> None:
    fact.load_history(store, batch_of)


STEPS = {
    "raw": load_raw,
    "stage_and_dims": lambda store, sf_dir: daily.load_stage_and_dims(store),
    "fact_history": lambda store, sf_dir: load_fact(store),
    "marts": lambda store, sf_dir: marts.build_marts(store),
}


def fresh(spark: SparkSession) -> Store:
    return Store(spark, new_root(spark))


def keep(spark: SparkSession, sf_dir: str, store: Store) -> None:
    _built[spark.sparkContext.applicationId, sf_dir] = store


def loaded(spark: SparkSession, sf_dir: str) -> Store:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        store = fresh(spark)
        for step in STEPS.values():
            step(store, sf_dir)
        keep(spark, sf_dir, store)
    return _built[key]
