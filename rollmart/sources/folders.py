"""Folder operations on whatever file system a path names, and scratch tables on the shared one."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

Result = TypeVar("Result")


class Folders:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        location = self._path(path)
        return location.getFileSystem(self._conf), location

    def exists(self, path: str) -> bool:
        fs, location = self._at(path)
        return fs.exists(location)

    def make(self, path: str) -> None:
        fs, location = self._at(path)
        fs.mkdirs(location)

    def remove(self, path: str) -> None:
        fs, location = self._at(path)
        fs.delete(location, True)

    def names(self, path: str) -> list[str]:
        fs, location = self._at(path)
        if not fs.exists(location):
            return []
        return [status.getPath().getName() for status in fs.listStatus(location)]


class Versions:
    """Whole tables below ``base`` that are replaced by publishing another folder.

    The first rows lie in ``base`` itself. What replaces them is written beside them and published by one marker, the last
    step, which is made or not made. The version before it stays for whoever reads it still; older ones go. A version
    that was cut off has no marker and is overwritten by the next attempt.
    """

    _MARK = "_published-"

    def __init__(self, folders: Folders, base: str):
        self.folders, self.base = folders, base

    def _published(self) -> int:
        marks = (n for n in self.folders.names(self.base) if n.startswith(self._MARK))
        return max((int(n.removeprefix(self._MARK)) for n in marks), default=0)

    def _folder(self, version: int) -> str:
        return f"{self.base}/v{version:08d}" if version else self.base

    def current(self) -> str:
        """The folder to read, and to append to."""
        return self._folder(self._published())

    def replace(self, write: Callable[[str], Result]) -> Result:
        """Run ``write`` with the folder of the next version, and publish that."""
        if not self.folders.names(self.base):
            return write(self.base)
        version = self._published() + 1
        result = write(self._folder(version))
        self.folders.make(f"{self.base}/{self._MARK}{version:08d}")
        kept = {f"{kind}{v:08d}" for kind in ("v", self._MARK) for v in (version - 1, version)}
        for name in self.folders.names(self.base) if version > 1 else ():
            if name not in kept:
                self.folders.remove(f"{self.base}/{name}")
        return result


class Scratch:
    """Intermediate tables in the shared folder.

    A written table cuts the lineage, so a lost executor costs a re-read and never a second evaluation
    that might come out in another order. As a context manager the folder is removed at the end; without
    ``with`` the tables stay for frames that are still to be evaluated.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_folder(spark)}/rollmart-scratch-{uuid4().hex}"

    def path(self, label: str) -> str:
        return f"{self.root}/{label}-{uuid4().hex[:8]}"

    def keep(self, rows: DataFrame, label: str) -> DataFrame:
        return self.keep_counted(rows, label)[0]

    def keep_counted(self, rows: DataFrame, label: str) -> tuple[DataFrame, int]:
        """The stored rows and how many they are."""
        path, seen = self.path(label), Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path), seen.get["rows"]

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        Folders(self.spark).remove(self.root)
