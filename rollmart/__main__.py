"""Command line: ``python -m rollmart --root FOLDER {run,report,sql,counts,truncate,drop}``."""

from __future__ import annotations

import argparse

from . import session
from .functions.calendar import new_batch_id
from .plans import daily, fact, sqlfile, sync
from .sources import extracts
from .sources.store import Store, layer_order
from .sources.targets import JdbcTarget, ParquetTarget, TsvTarget


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rollmart")
    top.add_argument("--root", required=True, help="folder of the warehouse")
    top.add_argument("--master", help="Spark master, where spark-submit does not set it")
    steps = top.add_subparsers(dest="step", required=True)

    run = steps.add_parser("run", help="extracts to the next fact day")
    run.add_argument("pupils")
    run.add_argument("attendance")
    run.add_argument("--batch-id")
    run.add_argument("--advance", choices=(fact.STRICT, fact.NEXT_AVAILABLE), default=fact.STRICT)
    run.add_argument("--unreadable", choices=("zero", "reject"), default="zero")
    run.add_argument("--multiline", action="store_true", help="read every file as one piece; left out, only those that need it")
    run.add_argument("--malformed", choices=("reject", "fail"), default="reject")

    report = steps.add_parser("report", help="publish the tables, build and test the marts")
    report.add_argument("target", help="jdbc:..., parquet:FOLDER or tsv:FOLDER")
    report.add_argument("--mode", choices=(sync.FULL, sync.BATCH_REPLACE, sync.BATCH_APPEND), default=sync.FULL)
    report.add_argument("--batch-id")
    report.add_argument("--severity", choices=("error", "warn"), default="error")
    report.add_argument("--rebuild", action="store_true", help="recompute all days of the marts")
    report.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="JDBC option")

    sql = steps.add_parser("sql", help="run a SQL file over the tables")
    sql.add_argument("file")
    sql.add_argument("--arg", action="append", default=[], metavar="NAME=VALUE")
    sql.add_argument("--rows", type=int, help="rows to print of each result; all if left out")

    for name in ("counts", "truncate", "drop"):
        steps.add_parser(name)
    return top


def pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def target_of(spark, name: str, options: dict[str, str]):
    kind, _, folder = name.partition(":")
    if kind == "jdbc":
        return JdbcTarget(spark, name, **options)
    if kind in ("parquet", "tsv"):
        return (ParquetTarget if kind == "parquet" else TsvTarget)(spark, folder)
    raise SystemExit(f"unknown target {name!r}")


def show(result: sqlfile.StatementResult, limit: int | None) -> None:
    """Prints the rows of a statement, a partition at a time, and how many there are or were changed."""
    if result.affected is not None:
        print(f"{result.kind}: {result.affected} rows affected")
    elif result.rows.columns:
        rows, n = result.rows, 0

        def line(cells) -> str:
            return "|" + "|".join(f"{cell!s:<{len(name)}}" for cell, name in zip(cells, rows.columns)) + "|"

        print(line(rows.columns))
        for row in (rows if limit is None else rows.limit(limit)).toLocalIterator():
            print(line("NULL" if cell is None else cell for cell in row))
            n += 1
        print(f"{n} rows")


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = session.build(args.master)
    store = Store(spark, args.root)
    if args.step == "run":
        batch = args.batch_id or new_batch_id()
        print(daily.run_daily(
            store, args.pupils, args.attendance, batch, args.advance, args.unreadable,
            args.multiline or extracts.AUTO, args.malformed
        ))
    elif args.step == "report":
        target = target_of(spark, args.target, pairs(args.option))
        print(daily.run_reporting(
            store, target, args.mode, args.batch_id, severity=args.severity, rebuild=args.rebuild
        ))
    elif args.step == "sql":
        for result in sqlfile.run_statements(store, args.file, pairs(args.arg)):
            show(result, args.rows)
    elif args.step == "counts":
        store.row_counts().orderBy(*layer_order()).show(truncate=False)
    elif args.step == "truncate":
        store.truncate_all()
    else:
        store.drop_all()


if __name__ == "__main__":
    main()
