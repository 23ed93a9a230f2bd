"""CSV extracts and the raw layer.

A row that is no row of its extract never shifts into other columns and never vanishes: it goes to the table of rejected
rows with its text and the reason, and is counted. That is a row with more cells than the header, or one whose quoted cell
has no end. A row with fewer cells is a row whose last cells are missing. Quoted cells may hold line breaks.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import marker_to_null
from ..schemas import ATTENDANCE_EXTRACT, PUPIL_EXTRACT, RAW_ATTENDANCE, RAW_PUPIL, RAW_REJECTED, ROW_ORDER
from ..session import side_by_side
from .store import Store

CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "quote": '"', "escape": '"'}
AUTO = "auto"
TEXT, REASON = "_text", "_reason"
UNCLOSED = "a quoted cell has no end"
# A comma and the cell behind it, and a row with a comma ahead. Possessive, so that long cells need no stack.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_CELL = rf',(?:{_QUOTED}|[^,]*+)'
_ROW = rf'^(?:,(?:{_QUOTED}[^,]*+|(?:[^",][^,]*+)?+))*+$'


class MalformedExtract(Exception):
    """An extract holds rows that are no rows of it."""


@dataclass(frozen=True)
class RawResult:
    """Rows loaded and rows rejected, per raw table."""

    rows: dict[str, int]
    rejected: dict[str, int]


def row_order() -> list:
    """File order of the rows of a file scan; splits of one file and rows inside a split both sort."""
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def _paths(path: str | Iterable[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def files_with_open_lines(spark: SparkSession, path: str | Iterable[str]) -> dict[str, bool]:
    """Files with a line that has an odd number of quotes, where a quoted cell may go on in the next line, and whether
    all their quotes come in pairs.

    One scan of the plain lines; a row for each such file comes to the driver.
    """
    lines = spark.read.text(_paths(path)).select("value", F.col("_metadata.file_path").alias("_file"))
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    found = lines.where(quotes % 2 == 1).groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["_file"]: r["n"] % 2 == 0 for r in found}


def _reason(text: Column, cells: int) -> Column:
    """Why a row that the reader calls malformed is none; NULL for a row whose last cells are missing."""
    row = F.concat(F.lit(","), text)
    found = F.regexp_count(row, F.lit(_CELL))
    return F.when(~row.rlike(_ROW), UNCLOSED).when(
        found > cells, F.concat(found.cast("string"), F.lit(f" cells instead of {cells}"))
    )


def _open_end(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rejects the last row of files whose quotes come in no pairs, if it has a line break: its last cell has no end, and
    the reader takes in what follows without a word."""
    last = F.max("_row").over(Window.partitionBy("_file")) == F.col("_row")
    broken = F.concat_ws("", *columns).rlike(r"[\r\n]")
    return rows.withColumn("_swallows", last & broken & F.col(REASON).isNull()).withColumns({
        TEXT: F.when(F.col("_swallows"), F.to_csv(F.struct(*columns))).otherwise(F.col(TEXT)),
        REASON: F.when(F.col("_swallows"), UNCLOSED).otherwise(F.col(REASON)),
    }).drop("_swallows")


def scan_extract(
    spark: SparkSession, path: str | Iterable[str], columns: tuple[str, ...], multiline: bool | str = AUTO
) -> DataFrame:
    """All rows with ``columns``, the row order, and for rejected rows their text and the reason.

    Columns are matched by name to the header line, which all files share; cells are text, missing-value markers NULL.
    ``auto`` reads a file as one piece only if a quoted cell may reach over lines in it; all other files are split between
    tasks. ``True`` and ``False`` do without looking.
    """
    paths = _paths(path)
    header = spark.read.options(**CSV_OPTIONS).csv(paths).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{', '.join(paths)} lacks the columns {missing}")
    # With a schema of its own and a column for the text the reader marks every row whose cells do not match the header.
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, TEXT)])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS, columnNameOfCorruptRecord=TEXT, columnPruning="false")

    def rows(of: list[str], whole: bool) -> DataFrame:
        read = reader.option("multiLine", whole).csv(of)
        # Marked rows are few; the others skip the patterns.
        reason = F.when(F.col(TEXT).isNotNull(), _reason(F.col(TEXT), len(header)))
        return read.select(*(marker_to_null(F.col(c)).alias(c) for c in columns), TEXT, reason.alias(REASON), *row_order())

    if multiline != AUTO:
        return rows(paths, multiline)
    open_files = files_with_open_lines(spark, paths)
    if not open_files:
        return rows(paths, False)
    scanned = rows(paths, False).where(~F.col("_file").isin(list(open_files)))
    for balanced in sorted(set(open_files.values())):
        pieces = rows([unquote(file) for file, even in open_files.items() if even == balanced], True)
        scanned = scanned.unionByName(pieces if balanced else _open_end(pieces, columns))
    return scanned


def read_extract(
    spark: SparkSession, path: str | Iterable[str], columns: tuple[str, ...], multiline: bool | str = AUTO
) -> DataFrame:
    """The rows of an extract, without the rejected ones, in ``columns`` and the row order."""
    return kept_rows(scan_extract(spark, path, columns, multiline))


def kept_rows(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col(REASON).isNull()).drop(TEXT, REASON)


def rejected_rows(scanned: DataFrame, extract: str) -> DataFrame:
    """The rejected rows as rows of the reject table."""
    # The reader does not give the text alone; the first cell tells what the row was about.
    first = F.col(scanned.columns[0]).alias("first_cell")
    return scanned.where(F.col(REASON).isNotNull()).select(
        F.lit(extract).alias("extract"), first, F.col(TEXT).alias("text"), F.col(REASON).alias("reason"), *ROW_ORDER
    )


def load_raw(
    store: Store, pupil_path: str, attendance_path: str, multiline: bool | str = AUTO, malformed: str = "reject"
) -> RawResult:
    """Replace both raw tables by the extracts, and the reject table by what is no row of them.

    Rejected rows are counted while the others are written; the files are read again only if there are any. With
    ``malformed="fail"`` they raise before anything is replaced.
    """
    if malformed not in ("reject", "fail"):
        raise ValueError(f"malformed must be 'reject' or 'fail', not {malformed!r}")
    spark = store.spark
    scans = dict(zip((RAW_PUPIL.name, RAW_ATTENDANCE.name), side_by_side(
        spark, lambda: scan_extract(spark, pupil_path, PUPIL_EXTRACT, multiline),
        lambda: scan_extract(spark, attendance_path, ATTENDANCE_EXTRACT, multiline),
    )))
    if malformed == "fail":
        # The reader counts no texts alone, so the first cell is read with them.
        counts = [F.count(F.lit(1)).alias("n"), F.max("first_cell")]
        found = {name: rejected_rows(scan, name).agg(*counts).first()["n"] for name, scan in scans.items()}
        if any(found.values()):
            raise MalformedExtract(", ".join(f"{name}: {n} rows" for name, n in found.items() if n))

    def load(name: str) -> tuple[int, int]:
        seen = Observation()
        counted = scans[name].observe(seen, F.count_if(F.col(REASON).isNotNull()).alias("rejected"))
        return store.replace(name, kept_rows(counted))["rows"], seen.get["rejected"]

    loaded = dict(zip(scans, side_by_side(spark, *(lambda name=name: load(name) for name in scans))))
    rejected = {name: n for name, (_, n) in loaded.items()}
    if any(rejected.values()) or not store.read(RAW_REJECTED.name).isEmpty():
        parts = (rejected_rows(scan, name) for name, scan in scans.items())
        store.replace(RAW_REJECTED.name, reduce(DataFrame.unionByName, parts))
    return RawResult({name: n for name, (n, _) in loaded.items()}, rejected)
