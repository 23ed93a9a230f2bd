"""Session settings the plans are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Key columns unpack to several times their file size; broadcasts are judged by the unpacked size.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def build(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("rollmart")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def side_by_side(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run independent steps at the same time, so that one's tasks fill the executors the other leaves idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def shared_folder(spark: SparkSession) -> str:
    """The cluster's own checkpoint folder; a machine-local one only for an unset local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@lru_cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="rollmart-")
