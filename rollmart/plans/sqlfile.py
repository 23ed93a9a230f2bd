"""Ad-hoc SQL files over the warehouse tables: queries as they are, writes by the rules of the tables.

Spark parses each statement; what kind it is and which tables it names is read from its plan. Only those tables become
views. ``INSERT INTO``, ``DELETE FROM`` and ``UPDATE`` go through the store, under the declared keys: a row that repeats a
key, lacks a required column or refers to no member, and a member that the fact still refers to, is an error and changes
nothing. Everything else that would write is refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import all_present
from ..schemas import FACT, FOREIGN_KEYS, MARTS, STATES, STG_PUPIL, TABLES, UNIQUE_KEYS, Table
from ..sources.folders import Scratch
from ..sources.store import Store

# A quoted text, a comment, a semicolon or any other single character.
_PIECES = re.compile(r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|.""", re.DOTALL)
_LOGICAL = "org.apache.spark.sql.catalyst.plans.logical"
WRITES = {"InsertIntoStatement": "insert", "DeleteFromTable": "delete", "UpdateTable": "update"}
# Statements that are no queries and change no table.
HARMLESS = {"CreateViewCommand", "DescribeRelation", "DescribeQueryCommand", "ExplainCommand", "ShowColumns", "ShowTables"}


class IntegrityError(Exception):
    """A write that a key, a required column or a reference forbids; nothing was changed."""


@dataclass(frozen=True)
class StatementResult:
    """What a statement gave: its rows, and for a write how many rows it changed (``rows`` then holds that number)."""

    kind: str
    text: str
    rows: DataFrame
    affected: int | None = None


def statements(text: str) -> list[str]:
    """The statements of a text; semicolons in quotes and comments do not separate, comments are left out."""
    found = [""]
    for piece in _PIECES.findall(text):
        if piece == ";":
            found.append("")
        elif piece.startswith(("--", "/*")):
            found[-1] += " "
        else:
            found[-1] += piece
    return [s.strip() for s in found if s.strip()]


def _listed(values) -> list:
    """A Scala sequence as a list."""
    return [values.apply(i) for i in range(values.size())]


class Statement:
    """A statement and Spark's plan of it."""

    def __init__(self, store: Store, text: str):
        self.store, self.text = store, text
        self.plan = store.spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        name = self.plan.getClass().getSimpleName()
        gateway = store.spark.sparkContext._gateway
        if name in WRITES:
            self.kind = WRITES[name]
        elif any(is_instance_of(gateway, self._inner(), f"{_LOGICAL}.{c}") for c in ("Command", "ParsedStatement")):
            self.kind = "command" if name in HARMLESS else "refused"
        else:
            self.kind = "query"

    def _inner(self):
        """The plan below its common table expressions."""
        plan = self.plan
        while plan.getClass().getSimpleName() == "UnresolvedWith":
            plan = plan.child()
        return plan

    def tables(self) -> list[str]:
        """The warehouse tables that the plan names anywhere, subqueries included."""
        named = re.findall(r"Unresolved(?:Relation|TableOrView) \[(\w+)\]", self.plan.treeString())
        return sorted(set(named) & set(TABLES))

    def part(self, node) -> str:
        """The text that a node of the plan was parsed from."""
        origin = node.origin()
        return self.text[origin.startIndex().get() : origin.stopIndex().get() + 1]

    def rest_from(self, node) -> str:
        """The text from the first thing that was parsed into a plan or the plans below it to the end."""
        starts, todo = [], [node]
        while todo:
            plan = todo.pop()
            if plan.origin().startIndex().isDefined():
                starts.append(plan.origin().startIndex().get())
            todo += _listed(plan.children())
        return self.text[min(starts):]

    def target(self) -> Table:
        """The table that is written to."""
        relation = self.plan.table()
        name = relation.multipartIdentifier().mkString(".") if hasattr(relation, "multipartIdentifier") else None
        if relation.getClass().getSimpleName() != "UnresolvedRelation" or name not in TABLES:
            raise PermissionError(f"only warehouse tables, named without alias, are written to: {self.text}")
        if TABLES[name] in (*MARTS, *STATES):
            raise PermissionError(f"{name} is made from other tables")
        self.store.own_base(name)
        return TABLES[name]


def _refuse(problems: list[str]) -> None:
    if problems:
        raise IntegrityError("; ".join(problems))


def _repeated(rows: DataFrame, key: tuple[str, ...]) -> int:
    """Key values that several rows have."""
    return rows.where(all_present(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()


def _insert(store: Store, statement: Statement, args: dict, scratch: Scratch) -> int:
    plan, table = statement.plan, statement.target()
    if plan.overwrite() or plan.ifPartitionNotExists() or not plan.partitionSpec().isEmpty() or plan.byName():
        raise PermissionError(f"only INSERT INTO with a list of columns or all of them: {statement.text}")
    columns = _listed(plan.userSpecifiedCols()) or table.columns
    given = store.spark.sql(statement.rest_from(plan.query()), args=args)
    if len(given.columns) != len(columns) or set(columns) - set(table.columns):
        raise ValueError(f"{len(given.columns)} values for the columns {columns} of {table.name}")
    named = given.toDF(*columns)
    rows = scratch.keep(named.select(*(
        (F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema
    )), "inserted")

    problems = [f"{table.name}.{c} is NULL" for c in table.required if not rows.where(F.col(c).isNull()).isEmpty()]
    for key in filter(None, (table.key, UNIQUE_KEYS.get(table.name))):
        # Only the days that get rows can hold the same keys.
        held = store.read(table.name)
        if table.day:
            held = held.join(F.broadcast(rows.select(table.day).distinct()), table.day, "left_semi")
        again = _repeated(rows, key) + rows.join(held.select(*key), list(key), "left_semi").count()
        if again:
            problems.append(f"{again} values of {table.name}.{','.join(key)} are there already")
    if table == FACT:
        for column, dimension in FOREIGN_KEYS.items():
            used = rows.select(column).where(F.col(column).isNotNull()).distinct()
            orphans = used.join(store.read(dimension).select(column), column, "left_anti").count()
            if orphans:
                problems.append(f"{orphans} values of {table.name}.{column} are not in {dimension}")
    _refuse(problems)
    written = store.append(table.name, rows)
    _note(store, table, written["days"])
    return written["rows"]


def _note(store: Store, table: Table, days: list) -> None:
    """Leaves word of changed days for the steps that follow on a table."""
    if table == STG_PUPIL:
        store.note_days(days)
    if table == FACT:
        store.doubt_days(days)
        store.touch_days(days)


def _swap(store: Store, table: Table, hit: DataFrame, after: DataFrame) -> None:
    """Puts the rows ``after`` in the place of the table; of a day-partitioned one only days with a row in ``hit``."""
    if not table.day:
        store.replace(table.name, after)
        return
    days = [r[0] for r in hit.select(table.day).distinct().collect()]  # one row per calendar day
    written = store.put_days(table.name, after.where(F.col(table.day).isin(days)))
    store.drop_days(table.name, [day for day in days if day not in written["days"]])
    _note(store, table, days)


def _condition(statement: Statement) -> str:
    found = statement.plan.condition()
    if found.getClass().getSimpleName() in ("Some", "None$"):
        return f"({statement.part(found.get())})" if found.isDefined() else "true"
    return "true" if found.toString() == "true" else f"({statement.part(found)})"


def _delete(store: Store, statement: Statement, args: dict, scratch: Scratch) -> int:
    table, spark = statement.target(), store.spark
    condition = _condition(statement)
    hit, n = scratch.keep_counted(spark.sql(f"SELECT * FROM {table.name} WHERE {condition}", args=args), "deleted")
    referring = next((c for c, dimension in FOREIGN_KEYS.items() if dimension == table.name), None)
    if referring:
        gone = hit.select(F.col(referring).cast("bigint").alias("_gone"))
        used = store.read(FACT.name).join(gone, F.col(referring) == F.col("_gone"), "left_semi").count()
        _refuse([f"{used} rows of {FACT.name} refer to deleted members of {table.name}"] * bool(used))
    if n:
        _swap(store, table, hit, spark.sql(f"SELECT * FROM {table.name} WHERE NOT coalesce({condition}, false)", args=args))
    return n


def _update(store: Store, statement: Statement, args: dict, scratch: Scratch) -> int:
    table, spark = statement.target(), store.spark
    values = {a.key().name(): statement.part(a.value()) for a in _listed(statement.plan.assignments())}
    fixed = {*table.key, *UNIQUE_KEYS.get(table.name, ()), *(FOREIGN_KEYS if table == FACT else ())}
    if set(values) & fixed or set(values) - set(table.columns):
        raise PermissionError(f"keys and references are not updated: {statement.text}")
    condition = _condition(statement)
    hit, n = scratch.keep_counted(spark.sql(f"SELECT * FROM {table.name} WHERE {condition}", args=args), "updated")
    changed = ", ".join(
        f"CAST(CASE WHEN {condition} THEN ({values[f.name]}) ELSE {f.name} END AS {f.dataType.simpleString()}) AS {f.name}"
        if f.name in values else f.name for f in table.schema
    )
    if n:
        after = spark.sql(f"SELECT {changed} FROM {table.name}", args=args)
        empty = [c for c in table.required if c in values and not after.where(F.col(c).isNull()).isEmpty()]
        _refuse([f"{table.name}.{c} is NULL" for c in empty])
        _swap(store, table, hit, after)
    return n


_ROUTES = {"insert": _insert, "delete": _delete, "update": _update}


def run_statements(store: Store, path: str, args: dict | None = None) -> list[StatementResult]:
    """Run the statements of a file in order."""
    if not path:
        raise ValueError("no SQL file given")
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(path)
    found = run_text(store, file.read_text(encoding="utf-8"), args)
    if not found:
        raise ValueError(f"{path} holds no statement")
    return found


def run_text(store: Store, text: str, args: dict | None = None) -> list[StatementResult]:
    """Run the statements of a text in order.

    Values go in as named parameters (``:batch_id``); a parameter without a value is an error. Rows of queries are lazy;
    in a text that also writes they are stored at their turn, so that later statements do not change them.
    """
    parts = [Statement(store, part) for part in statements(text)]
    refused = [part.text for part in parts if part.kind == "refused"]
    if refused:
        raise PermissionError(f"not run here: {'; '.join(refused)}")
    writes = any(part.kind in _ROUTES for part in parts)
    kept, results = store.scratch(), []
    for part in parts:
        store.register_views(part.tables())
        if part.kind in _ROUTES:
            with store.scratch() as scratch:
                affected = _ROUTES[part.kind](store, part, args or {}, scratch)
            rows = store.spark.createDataFrame([(affected,)], "affected_rows bigint")
            results.append(StatementResult(part.kind, part.text, rows, affected))
            continue
        rows = store.spark.sql(part.text, args=args or {})
        rows = kept.keep(rows, "result") if writes and part.kind == "query" else rows
        results.append(StatementResult(part.kind, part.text, rows))
    return results


def run_sql_file(store: Store, path: str, args: dict | None = None) -> list[DataFrame]:
    """The rows that each statement of a file gives."""
    return [result.rows for result in run_statements(store, path, args)]
