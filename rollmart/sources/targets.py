"""Reporting targets a table can be published to: a JDBC database, a Parquet folder, tab-separated files."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TABLES
from .folders import Folders, Versions

# Declared type name -> column type of the reporting database; anything else is TEXT.
DECLARED_TYPES = {
    "INTEGER": "INTEGER", "TEXT": "TEXT", "REAL": "DOUBLE PRECISION", "NUMERIC": "NUMERIC", "BLOB": "BYTEA",
}


def declared_type(name: str) -> str:
    """Reporting type of a declared type name, by its beginning."""
    for declared, target in DECLARED_TYPES.items():
        if name.upper().startswith(declared):
            return target
    return "TEXT"


def column_type(kind: T.DataType) -> str:
    """Reporting type of a Spark type."""
    if isinstance(kind, T.LongType):
        return "BIGINT"
    if isinstance(kind, T.DateType):
        return "DATE"
    if isinstance(kind, T.TimestampType):
        return "TIMESTAMP"
    if isinstance(kind, T.DecimalType):
        return f"NUMERIC({kind.precision},{kind.scale})"
    for spark_type, declared in (
        (T.IntegralType, "INTEGER"), (T.FractionalType, "REAL"), (T.BinaryType, "BLOB"),
    ):
        if isinstance(kind, spark_type):
            return declared_type(declared)
    return declared_type("TEXT")


def create_table_sql(name: str, schema: T.StructType) -> str:
    columns = ", ".join(f'"{f.name}" {column_type(f.dataType)}' for f in schema.fields)
    return f'CREATE TABLE "{name}" ({columns})'


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class JdbcTarget:
    """Tables of a database, written by parallel batched inserts; at most ``connections`` at a time."""

    def __init__(self, spark: SparkSession, url: str, connections: int = 16, batch_size: int = 10_000, **options: str):
        self.spark = spark
        self.options = {
            "url": url, "numPartitions": str(connections), "batchsize": str(batch_size), **options,
        }

    def settings(self, name: str) -> dict[str, str]:
        return {**self.options, "dbtable": name}

    def replace(self, name: str, rows: DataFrame) -> int:
        """Drop, create with real column types, load."""
        return self._write(name, rows, "overwrite")

    def append(self, name: str, rows: DataFrame) -> int:
        return self._write(name, rows, "append")

    def _write(self, name: str, rows: DataFrame, mode: str) -> int:
        rows, seen = _counted(rows)
        rows.write.format("jdbc").mode(mode).options(**self.settings(name)).save()
        return seen.get["rows"]

    def exists_query(self, name: str) -> str:
        schema, _, table = name.rpartition(".")
        query = f"SELECT table_name FROM information_schema.tables WHERE table_name = '{table}'"
        return f"{query} AND table_schema = '{schema}'" if schema else query

    def exists(self, name: str) -> bool:
        options = {k: v for k, v in self.options.items() if k != "numPartitions"}
        found = self.spark.read.format("jdbc").options(**options).option("query", self.exists_query(name)).load()
        return not found.isEmpty()

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The table, or an empty frame before it was first written. Filters on it run in the database."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.format("jdbc").options(**self.settings(name)).load()
        return rows.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


class ParquetTarget:
    """Tables as Parquet folders; the fact and the rate mart by day.

    A replaced table is written beside the old one and published by one last step, so a failing write leaves the old
    rows, and whoever reads the old ones can end. ``path`` names the folder to read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folders = Folders(spark)

    def _versions(self, name: str) -> Versions:
        return Versions(self.folders, f"{self.root}/{name}")

    def path(self, name: str) -> str:
        return self._versions(name).current()

    def replace(self, name: str, rows: DataFrame) -> int:
        return self._versions(name).replace(lambda path: self._write(name, rows, "overwrite", path))

    def append(self, name: str, rows: DataFrame) -> int:
        return self._write(name, rows, "append", self.path(name))

    def _write(self, name: str, rows: DataFrame, mode: str, path: str) -> int:
        rows, seen = _counted(rows)
        self._save(name, rows.write.mode(mode).option("partitionOverwriteMode", "static"), path)
        return seen.get["rows"]

    def _save(self, name: str, writer: DataFrameWriter, path: str) -> None:
        day = TABLES[name].day if name in TABLES else None
        (writer.partitionBy(day) if day else writer).parquet(path)

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The table, or an empty frame before it was first written. A filter on the day reads the folders of that day."""
        path = self.path(name)
        if not self.folders.exists(path):
            return self.spark.createDataFrame([], schema)
        return self._load(schema, path).select(*schema.fieldNames())

    def _load(self, schema: T.StructType, path: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)


class TsvTarget(ParquetTarget):
    r"""Tables as tab-separated files for a bulk load; NULL is ``\N``, quotes inside a cell are doubled."""

    OPTIONS = {
        "sep": "\t", "header": "false", "nullValue": "\\N", "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }

    def _save(self, name: str, writer: DataFrameWriter, path: str) -> None:
        writer.options(**self.OPTIONS, emptyValue='""').csv(path)

    def _load(self, schema: T.StructType, path: str) -> DataFrame:
        return self.spark.read.schema(schema).options(**self.OPTIONS, emptyValue="").csv(path)

    def load_script(self, name: str, schema: T.StructType) -> str:
        """SQL that recreates the table; the files are then copied in one by one."""
        options = r"FORMAT CSV, DELIMITER E'\t', NULL '\N', HEADER FALSE"
        return "\n".join((
            f'DROP TABLE IF EXISTS "{name}";',
            f"{create_table_sql(name, schema)};",
            f'-- for each file below {self.path(name)}:',
            f"""-- COPY "{name}" FROM STDIN WITH ({options});""",
        ))
