"""What several operators share: the word definition, the supplied tables and plain expressions."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return; every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """All words of a text in order; an empty array for NULL."""
    # Splitting at one plain character is the cheap case.
    return F.array_remove(F.split(F.regexp_replace(whole(text), r"[\x09-\x0D]+", " "), " "), "")


def ratio(part: Column, total: Column) -> Column:
    """part / total, 0 where the total is 0."""
    return F.when(total > 0, part / total).otherwise(0.0)


def worker_memory() -> dict:
    """What a Python worker keeps from one task to the next; it may be gone at any time."""
    return sys.modules.setdefault("_rollmart_worker_memory", ModuleType("_rollmart_worker_memory")).__dict__


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each job in this block removes its shuffle files when it ends, instead of when the driver happens to collect garbage.

    For many jobs in a row that hand on stored tables; a lost executor within a job is mended as ever.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release_worker_memory() -> None:
    """For tasks that need room themselves: a worker of another operator may be used again with all that it kept."""
    worker_memory().clear()
