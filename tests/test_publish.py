from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import types as T

from rollmart.plans import sqlfile, sync
from rollmart.schemas import TABLES
from rollmart.sources import targets
from rollmart.sources.targets import JdbcTarget, ParquetTarget, TsvTarget

FACT = "fact_pupil_attendance_daily"


def fact_rows(spark, *days, status="In"):
    rows = [
        (date(2025, 1, d), 20250100 + d, p, None, 1, 1, status, "Present", f"batch{d}") for d in days for p in (1, 2)
    ]
    return spark.createDataFrame(rows, TABLES[FACT].schema)


@pytest.fixture
def filled(store, spark):
    store.append(FACT, fact_rows(spark, 1, 2, 3))
    store.append("dim_academy", spark.createDataFrame([(1, "North")], TABLES["dim_academy"].schema))
    return store


@pytest.fixture
def target(spark, tmp_path):
    return ParquetTarget(spark, str(tmp_path / "target"))


def batches(target):
    rows = target.read(FACT, TABLES[FACT].schema).groupBy("prcs_id").count().collect()
    return {r["prcs_id"]: r["count"] for r in rows}


def test_full_and_batch_modes(filled, target):
    assert sync.sync_table(filled, FACT, target).rows == 6
    assert batches(target) == {"batch1": 2, "batch2": 2, "batch3": 2}
    assert sync.sync_table(filled, FACT, target, sync.BATCH_REPLACE, "batch2").rows == 2
    assert batches(target) == {"batch2": 2}
    for _ in range(2):
        last = sync.sync_table(filled, FACT, target, sync.BATCH_APPEND, "batch3", date(2025, 1, 3))
    assert (last.rows, last.skipped) == (0, False)
    assert batches(target) == {"batch2": 2, "batch3": 2}


def test_append_completes_a_half_written_batch(filled, target, spark):
    target.append(FACT, fact_rows(spark, 1).limit(1))
    assert sync.sync_table(filled, FACT, target, sync.BATCH_APPEND, "batch1").rows == 1
    assert batches(target) == {"batch1": 2}


def test_keys_keep_their_type(filled, target):
    sync.sync_all(filled, target)
    got = target.read(FACT, TABLES[FACT].schema)
    assert dict(got.dtypes)["academy_key"] == "bigint"
    assert got.where("academy_key IS NULL").count() == 6


def test_empty_source_leaves_the_target(filled, target):
    sync.sync_all(filled, target)
    result = sync.sync_table(filled, FACT, target, sync.BATCH_REPLACE, "no such batch")
    assert (result.rows, result.skipped) == (0, True)
    assert batches(target) == {"batch1": 2, "batch2": 2, "batch3": 2}
    results = {r.table: r for r in sync.sync_all(filled, target)}
    assert results["dim_academy"].rows == 1 and results["dim_pupil"].skipped


def test_dimensions_are_always_full(filled, target):
    results = sync.sync_all(filled, target, sync.BATCH_APPEND, "batch1")
    assert {r.table: r.rows for r in results if not r.skipped} == {FACT: 2, "dim_academy": 1}


def test_sync_arguments(filled, target):
    with pytest.raises(ValueError):
        sync.sync_table(filled, FACT, target, "append")
    with pytest.raises(ValueError):
        sync.sync_table(filled, FACT, target, sync.BATCH_APPEND)


def test_tsv_roundtrip(spark, tmp_path):
    rows = [
        (1, None, date(2025, 1, 1)), (2, "", None), (3, " a\tb ", None), (4, 'say "x", \\ y', None), (5, "NULL", None),
    ]
    frame = spark.createDataFrame(rows, "id bigint, t string, d date")
    target = TsvTarget(spark, str(tmp_path))
    assert target.replace("texts", frame) == 5
    assert sorted(map(tuple, target.read("texts", frame.schema).collect())) == rows
    lines = "".join(p.read_text() for p in (tmp_path / "texts").glob("part-*"))
    assert "1\t\\N\t2025-01-01\n" in lines and '2\t""\t\\N\n' in lines and '4\t"say ""x"", \\ y"\t\\N\n' in lines
    assert target.read("absent", frame.schema).count() == 0


def test_tsv_load_script(spark):
    script = TsvTarget(spark, "/out").load_script("dim_date", TABLES["dim_date"].schema)
    assert script.splitlines()[:2] == [
        'DROP TABLE IF EXISTS "dim_date";',
        'CREATE TABLE "dim_date" ("date_key" INTEGER, "date" DATE, "year" INTEGER, "month" INTEGER, "day" INTEGER, '
        '"weekday" TEXT);',
    ]


def test_column_types():
    assert [targets.declared_type(t) for t in ("integer", "TEXT", "Real", "NUMERIC(9,2)", "blob", "object", "int64")] == [
        "INTEGER", "TEXT", "DOUBLE PRECISION", "NUMERIC", "BYTEA", "TEXT", "TEXT",
    ]
    kinds = {
        T.LongType(): "BIGINT", T.IntegerType(): "INTEGER", T.ShortType(): "INTEGER", T.StringType(): "TEXT",
        T.DoubleType(): "DOUBLE PRECISION", T.FloatType(): "DOUBLE PRECISION", T.DecimalType(9, 2): "NUMERIC(9,2)",
        T.BinaryType(): "BYTEA", T.DateType(): "DATE", T.TimestampType(): "TIMESTAMP", T.BooleanType(): "TEXT",
    }
    assert {kind: targets.column_type(kind) for kind in kinds} == kinds


def test_jdbc_settings(spark):
    # No database is started here; only the options that reach Spark's writer are checked.
    target = JdbcTarget(spark, "jdbc:postgresql://host/db", connections=4, user="u")
    assert target.settings("dim_date") == {
        "url": "jdbc:postgresql://host/db", "numPartitions": "4", "batchsize": "10000", "user": "u",
        "dbtable": "dim_date",
    }


def test_jdbc_table_lookup(spark):
    target = JdbcTarget(spark, "jdbc:postgresql://host/db")
    base = "SELECT table_name FROM information_schema.tables WHERE table_name = 'dim_date'"
    assert target.exists_query("dim_date") == base
    assert target.exists_query("public.dim_date") == base + " AND table_schema = 'public'"


def test_statements():
    text = """-- a; comment
    SELECT ';' AS a, "x;y" AS b /* ; */ ; SELECT 'it''s; -- no comment' ;
    ;
    SELECT `a;b`;"""
    assert sqlfile.statements(text) == [
        "SELECT ';' AS a, \"x;y\" AS b", "SELECT 'it''s; -- no comment'", "SELECT `a;b`",
    ]


def test_sql_file(filled, tmp_path):
    file = tmp_path / "report.sql"
    file.write_text(
        "CREATE OR REPLACE TEMPORARY VIEW one AS SELECT * FROM fact_pupil_attendance_daily WHERE day(fact_date) = 1;\n"
        "SELECT count(*) AS n FROM one;\nSELECT count(*) AS n FROM fact_pupil_attendance_daily WHERE prcs_id = :prcs_id;"
    )
    results = sqlfile.run_sql_file(filled, str(file), {"prcs_id": "batch3"})
    assert [r.collect()[0][0] for r in results[1:]] == [2, 2]
    assert sqlfile.run_sql_file(filled, str(file), {"prcs_id": "x' OR 'x' = 'x"})[2].collect()[0][0] == 0
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        sqlfile.run_sql_file(filled, str(file))


def test_sql_file_errors(filled, tmp_path):
    with pytest.raises(ValueError):
        sqlfile.run_sql_file(filled, "")
    with pytest.raises(FileNotFoundError):
        sqlfile.run_sql_file(filled, str(tmp_path / "absent.sql"))
    empty = tmp_path / "empty.sql"
    empty.write_text("-- nothing; here\n")
    with pytest.raises(ValueError):
        sqlfile.run_sql_file(filled, str(empty))


def sql(store, tmp_path, text, **args):
    file = tmp_path / "statements.sql"
    file.write_text(text)
    return sqlfile.run_statements(store, str(file), args)


def test_statements_tell_kind_rows_and_counts(filled, tmp_path, spark):
    results = sql(filled, tmp_path, f"""
        SELECT count(*) AS n FROM {FACT};
        INSERT INTO dim_academy VALUES (2, 'South'), (3, :third);
        UPDATE {FACT} SET status = upper(status) WHERE pupil_key = 1 AND fact_date <= DATE '2025-01-02';
        DELETE FROM {FACT} WHERE fact_date = DATE '2025-01-03' AND pupil_key IN (SELECT 2);
        WITH one AS (SELECT * FROM dim_academy) SELECT max(academy_key) AS k FROM one WHERE academy_name = :third;
        SELECT status, count(*) AS n FROM {FACT} GROUP BY status ORDER BY status;
        DELETE FROM {FACT}""", third="West; 'x'")
    assert [r.kind for r in results] == ["query", "insert", "update", "delete", "query", "query", "delete"]
    assert [r.affected for r in results] == [None, 2, 2, 1, None, None, 5]
    # Results are those of their turn.
    assert [tuple(r) for i in (0, 4, 5) for r in results[i].rows.collect()] == [(6,), (3,), ("IN", 2), ("In", 3)]
    assert filled.read(FACT).count() == 0 and filled.days(FACT) == []
    assert filled.doubted_days()


@pytest.mark.parametrize("text, problem", [
    ("INSERT INTO dim_academy VALUES (1, 'South')", "academy_key"), ("INSERT INTO dim_academy VALUES (5, 'North')", "academy_name"),
    ("INSERT INTO dim_academy SELECT 7, 'a' UNION ALL SELECT 7, 'b'", "academy_key"),
    ("INSERT INTO dim_academy (academy_key) VALUES (9)", "academy_name is NULL"),
    ("INSERT INTO dim_academy WITH w AS (SELECT 1 AS k) (SELECT k, 'z' FROM w) UNION ALL SELECT 1, 'y' FROM w ORDER BY 1", "academy_key"),
    (f"INSERT INTO {FACT} SELECT * FROM {FACT} LIMIT 1", "fact_date,pupil_key"),
    (f"INSERT INTO {FACT} (fact_date, date_key, pupil_key, stream_key) VALUES (DATE '2025-01-09', 20250109, 1, 77)", "stream_key"),
    ("DELETE FROM dim_academy WHERE academy_key = 1", "refer to deleted"),
])
def test_writes_that_break_a_rule_change_nothing(filled, tmp_path, spark, text, problem):
    filled.append(FACT, fact_rows(spark, 4).selectExpr("fact_date", "date_key", "pupil_key", "1L AS academy_key", "grade_key", "stream_key", "status", "attendance", "prcs_id"))
    before = {name: sorted(map(str, filled.read(name).collect())) for name in ("dim_academy", FACT)}
    with pytest.raises(sqlfile.IntegrityError, match=problem):
        sql(filled, tmp_path, text)
    assert {name: sorted(map(str, filled.read(name).collect())) for name in before} == before


@pytest.mark.parametrize("text", [
    "DROP TABLE dim_academy", "TRUNCATE TABLE dim_academy", "CREATE TABLE t AS SELECT 1 AS a", "INSERT OVERWRITE dim_academy SELECT 1, 'a'",
    "WITH a AS (SELECT 1 AS k) INSERT INTO dim_academy SELECT k, 'x' FROM a", "INSERT INTO attendance_rate SELECT * FROM attendance_rate",
    "UPDATE dim_academy SET academy_key = 5", "INSERT INTO elsewhere VALUES (1)",
])
def test_other_writes_are_refused(filled, tmp_path, text):
    with pytest.raises(PermissionError):
        sql(filled, tmp_path, text)


def test_only_named_tables_become_views(filled, tmp_path, spark):
    for name in TABLES:
        spark.catalog.dropTempView(name)
    sql(filled, tmp_path, "SELECT * FROM dim_academy WHERE academy_key IN (SELECT stream_key FROM dim_stream)")
    assert {t.name for t in spark.catalog.listTables()} & set(TABLES) == {"dim_academy", "dim_stream"}


def test_replacing_swaps_whole_versions(filled, target, spark):
    schema = TABLES["dim_academy"].schema
    old = filled.read("dim_academy")
    broken = spark.createDataFrame([(2, "South")], schema).selectExpr("academy_key", "if(academy_key = 2, raise_error('cut off'), '') AS academy_name")
    for place in (filled, target):
        place.replace("dim_academy", old)
        with pytest.raises(Exception, match="cut off"):
            place.replace("dim_academy", broken)
    for n in range(2, 6):
        # A table may be replaced by what is read from it, and readers of the version before go on.
        reader = filled.read("dim_academy")
        filled.replace("dim_academy", reader.unionAll(spark.createDataFrame([(n, f"A{n}")], schema)))
        assert reader.count() == n - 1 and filled.read("dim_academy").count() == n
    assert [tuple(r) for r in target.read("dim_academy", schema).collect()] == [(1, "North")]
    folder = filled.base("dim_academy")
    assert sum(name.startswith("v") for name in filled.folders.names(folder)) == 2
    filled.append("dim_academy", spark.createDataFrame([(9, "New")], schema))
    assert filled.read("dim_academy").count() == 6


def test_batch_append_reads_the_days_of_the_batch_alone(spark, store, target, raw):
    from samples import snapshot

    from rollmart.plans import daily, fact

    days = [f"2025/01/0{d}" for d in range(1, 6)]
    store.replace("raw_pupil", raw(*[snapshot(d, p) for d in days for p in "123"]))
    store.replace("raw_pupil_attendance", raw.marks(*[(d, p, "Present") for d in days for p in "123"]))
    daily.load_stage_and_dims(store)
    for n in range(5):
        fact.load_next(store, f"batch/{n}")
    assert store.load_log() == [(f"batch/{n}", date(2025, 1, n + 1), 3) for n in range(5)]
    for n in (0, 1, 1):
        sync.sync_table(store, FACT, target, sync.BATCH_APPEND, f"batch/{n}")
    assert batches(target) == {"batch/0": 3, "batch/1": 3}
    source = sync.extract(store, FACT, "batch/1")
    assert len(source.inputFiles()) < len(store.read(FACT).inputFiles())
    held = sync.held_rows(store, target, "batch/1")
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fact_date" in plan and "2025-01-02" in plan
    assert sync.extract(store, FACT, "unknown batch").count() == 0
