"""The warehouse: one Parquet folder per table, the large ones partitioned by day."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from functools import reduce
from urllib.parse import quote, unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import (
    ACADEMY_PUPILS, ACADEMY_SUMS, FACT, MART_RATE, MARTS, RAW_REJECTED, STATES, STG_ATTENDANCE, STG_PUPIL, TABLES, WAREHOUSE, WEEKDAY_SUMS,
)
from .folders import Folders, Scratch, Versions


class Store:
    """Tables below ``root``. ``elsewhere`` maps table names to folders of another store (read there only)."""

    def __init__(self, spark: SparkSession, root: str, elsewhere: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.elsewhere = elsewhere or {}
        self.folders = Folders(spark)

    def branch(self, root: str, own: list[str]) -> "Store":
        """A store that keeps the tables in ``own`` itself and reads all others from this one.

        One with a fact or marts of its own keeps what its marts are made from itself, too.
        """
        made = {FACT.name, *(mart.name for mart in MARTS)}
        states = [state.name for state in STATES] if made & set(own) else []
        shared = {name: self.base(name) for name in TABLES if name not in own and name not in states}
        return Store(self.spark, root, shared)

    def base(self, name: str) -> str:
        return self.elsewhere.get(name, f"{self.root}/{TABLES[name].name}")

    def own_base(self, name: str) -> str:
        if name in self.elsewhere:
            raise PermissionError(f"{name} belongs to another store")
        return self.base(name)

    def path(self, name: str) -> str:
        """Where the rows are: day-partitioned tables swap days, all others whole versions."""
        return self.base(name) if TABLES[name].day else Versions(self.folders, self.base(name)).current()

    def scratch(self) -> Scratch:
        return Scratch(self.spark)

    # reading

    def exists(self, name: str) -> bool:
        return self.folders.exists(self.base(name))

    def read(self, name: str, days: list[date] | None = None) -> DataFrame:
        """The table, or an empty frame with its schema when nothing was written yet.

        With ``days`` (as ``days()`` lists them) only those day folders are listed and read, so a daily load
        does not have to index the files of the whole history first.
        """
        table, path = TABLES[name], self.path(name)
        if days == [] or not self.exists(name):
            return self.spark.createDataFrame([], table.schema)
        reader = self.spark.read.schema(table.schema)
        if not table.day:
            return reader.parquet(path)
        if days is None:
            rows = reader.parquet(path)
        else:
            rows = reader.option("basePath", path).parquet(*(f"{path}/{table.day}={day}" for day in days))
        return rows.select(*table.columns)  # the scan puts the partition column last

    def days(self, name: str) -> list[date]:
        """Days a partitioned table holds, from the folder listing alone (no Spark job)."""
        prefix = f"{TABLES[name].day}="
        found = (n[len(prefix):] for n in self.folders.names(self.path(name)) if n.startswith(prefix))
        return sorted(date.fromisoformat(day) for day in found)

    def drop_days(self, name: str, days: list[date]) -> None:
        for day in days:
            self.folders.remove(f"{self.own_base(name)}/{TABLES[name].day}={day}")

    def register_views(self, names: Collection[str] = tuple(TABLES)) -> None:
        """Temporary views over the tables, for SQL text."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    # writing

    def _write(self, name: str, rows: DataFrame, mode: str, path: str | None = None, **options: str) -> dict:
        table = TABLES[name]
        self.own_base(name)
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("rows")]
        if table.day:
            # As many values as calendar days, written as one text.
            measures.append(F.concat_ws(",", F.collect_set(F.col(table.day).cast("string"))).alias("days"))
        writer = rows.select(*table.columns).observe(seen, *measures).write.mode(mode).options(**options)
        if table.day:
            writer = writer.partitionBy(table.day)
        writer.parquet(path or self.path(name))
        result = seen.get
        days = sorted(date.fromisoformat(day) for day in result.get("days", "").split(",") if day)
        return {"rows": result["rows"], "days": days}

    def append(self, name: str, rows: DataFrame) -> dict:
        """Add rows; returns their number and the days they belong to, measured in the writing stage itself.

        Rows staged for a day that the fact has passed are late: the day is noted. After an append that was cut off all
        days are.
        """
        if name not in (STG_PUPIL.name, STG_ATTENDANCE.name):
            return self._write(name, rows, "append")
        cut_off = self.open_step(f"append-{name}")
        written = self._write(name, rows, "append")
        self.note_late(self.days(name) if cut_off else written["days"])
        self.close_step(f"append-{name}")
        return written

    def replace(self, name: str, rows: DataFrame) -> dict:
        """Put other rows in the place of the whole table.

        They are written beside it and published at the end, so a failing write leaves the old rows, and ``rows`` may
        read the table itself. Of a day-partitioned table each day is swapped on its own.
        """
        if TABLES[name].day:
            before = self.days(name)
            written = self.put_days(name, rows)
            self.drop_days(name, [day for day in before if day not in written["days"]])
            return written
        versions = Versions(self.folders, self.own_base(name))
        return versions.replace(lambda path: self._write(name, rows, "overwrite", path))

    def put_days(self, name: str, rows: DataFrame) -> dict:
        """Write whole days; a day already there is swapped, other days stay.

        Each day is staged aside and moved into place as one folder, so a day is there whole or not at all.
        """
        return self._write(name, rows, "overwrite", partitionOverwriteMode="dynamic")

    # steps of more than one write

    def open_step(self, step: str) -> bool:
        """Mark a step as begun; True when an earlier run began it and never closed it."""
        marker = f"{self.root}/_open-{step}"
        cut_off = self.folders.exists(marker)
        self.folders.make(marker)
        return cut_off

    def close_step(self, step: str) -> None:
        self.folders.remove(f"{self.root}/_open-{step}")

    def is_open(self, step: str) -> bool:
        return self.folders.exists(f"{self.root}/_open-{step}")

    # staged days that the dimensions have not taken up yet

    def note_days(self, days: Collection[date]) -> None:
        for day in days:
            self.folders.make(f"{self.root}/_noted/{day}")

    def noted_days(self) -> list[date]:
        return sorted(date.fromisoformat(day) for day in self.folders.names(f"{self.root}/_noted"))

    def strike_days(self, days: Collection[date]) -> None:
        for day in days:
            self.folders.remove(f"{self.root}/_noted/{day}")

    # notes beside the fact: its days that no check has passed yet, its late days, and the days of each batch

    def _beside_fact(self, note: str) -> str:
        return f"{self.base(FACT.name).rpartition('/')[0]}/{note}"

    def doubt_days(self, days: Collection[date]) -> None:
        for day in days:
            self.folders.make(f"{self._beside_fact('_unchecked')}/{day}")

    def doubted_days(self) -> list[date]:
        return sorted(date.fromisoformat(day) for day in self.folders.names(self._beside_fact("_unchecked")))

    def trust_days(self, days: Collection[date]) -> None:
        for day in days:
            self.folders.remove(f"{self._beside_fact('_unchecked')}/{day}")

    def note_late(self, days: Collection[date]) -> None:
        """Notes those of the days that the fact has passed."""
        self.folders.make(self._beside_fact("_late"))
        loaded = self.days(FACT.name)
        for day in days:
            if loaded and day <= loaded[-1]:
                self.folders.make(f"{self._beside_fact('_late')}/{day}")

    def late_days(self) -> list[date] | None:
        """The days that got rows after the fact had passed them; None where nobody took notes."""
        if not self.folders.exists(self._beside_fact("_late")):
            return None
        return sorted(date.fromisoformat(day) for day in self.folders.names(self._beside_fact("_late")))

    def settle_late(self, day: date) -> None:
        self.folders.remove(f"{self._beside_fact('_late')}/{day}")

    def _counted(self) -> str:
        return f"{self.base(ACADEMY_PUPILS.name).rpartition('/')[0]}/_counted"

    def note_counted(self, days: Collection[date]) -> None:
        """The days whose pupils the pairs of academy and pupil hold."""
        for day in days:
            self.folders.make(f"{self._counted()}/{day}")

    def counted_days(self) -> list[date]:
        return sorted(date.fromisoformat(day) for day in self.folders.names(self._counted()))

    def forget_counted(self) -> None:
        self.folders.remove(self._counted())

    def touch_days(self, days: Collection[date]) -> None:
        """The fact changed on these days: what is kept of them is made anew by the next build of the marts."""
        for name in (MART_RATE.name, ACADEMY_SUMS.name, WEEKDAY_SUMS.name):
            if name not in self.elsewhere:
                self.drop_days(name, list(days))

    def announce_batch(self, batch_id: str, day: date) -> None:
        """Noted before a batch writes to a day, so that the log never lacks one of its days."""
        self.folders.make(f"{self._beside_fact('_batches')}/{quote(batch_id, safe='')}/{day}")

    def log_batch(self, batch_id: str, day: date, rows: int) -> None:
        """Noted when its rows are there."""
        self.folders.make(f"{self._beside_fact('_batches')}/{quote(batch_id, safe='')}/{day}+{rows}+{uuid4().hex[:8]}")

    def batch_days(self, batch_id: str) -> list[date] | None:
        """The days a batch may have written to; None if no load logged it."""
        found = self.folders.names(f"{self._beside_fact('_batches')}/{quote(batch_id, safe='')}")
        return sorted({date.fromisoformat(name.partition("+")[0]) for name in found}) or None

    def load_log(self) -> list[tuple[str, date, int]]:
        """Batch, day and rows of all loads that came to their end."""
        rows: dict[tuple[str, date], int] = {}
        for batch in self.folders.names(self._beside_fact("_batches")):
            for name in self.folders.names(f"{self._beside_fact('_batches')}/{batch}"):
                day, done, count = name.partition("+")
                if done:
                    key = unquote(batch), date.fromisoformat(day)
                    rows[key] = rows.get(key, 0) + int(count.partition("+")[0])
        return sorted((batch, day, n) for (batch, day), n in rows.items())

    # maintenance

    def create_missing(self) -> list[str]:
        """Create the folders of absent warehouse tables; returns the names created."""
        absent = [table.name for table in WAREHOUSE if not self.exists(table.name)]
        for name in absent:
            self.folders.make(self.own_base(name))
        return absent

    def forget(self, name: str) -> None:
        """Remove a derived table, so that the next build makes all of it; one of another store stays."""
        if name not in self.elsewhere:
            self.folders.remove(self.base(name))

    def truncate_all(self) -> None:
        """Empty all warehouse tables, fact first; surrogate keys start again at 1."""
        self.drop_all()
        self.create_missing()

    def drop_all(self) -> None:
        """Drop all warehouse tables, fact first; absent ones are passed over. The marts lose their basis."""
        for table in reversed(WAREHOUSE):
            self.folders.remove(self.own_base(table.name))
        for table in (*MARTS, *STATES, RAW_REJECTED):
            self.forget(table.name)
        self.strike_days(self.noted_days())
        self.forget_counted()
        for note in ("_unchecked", "_late", "_batches"):
            self.folders.remove(self._beside_fact(note))

    def row_counts(self) -> DataFrame:
        """Rows per warehouse table."""
        parts = [
            self.read(table.name).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table.name).alias("table_name"), "row_count")
            for table in WAREHOUSE
        ]
        return reduce(DataFrame.unionByName, parts)


def layer_order() -> list[Column]:
    """Order of a table report: raw, stage, dimension, fact, others; by name inside a layer."""
    name = F.col("table_name")
    layer = F.lit(5)
    for place, prefix in reversed(list(enumerate(("raw_%", "stg_%", "dim_%", "fact_%"), start=1))):
        layer = F.when(name.ilike(prefix), place).otherwise(layer)
    return [layer, name]
