"""The registered queries as SQL over the supplied tables, built from shared common table expressions."""

from __future__ import annotations

ISO = "substr({c},1,4)||'-'||substr({c},6,2)||'-'||substr({c},9,2)"


def parsed_date(column: str) -> str:
    iso = ISO.format(c=column)
    return rf"CASE WHEN regexp_full_match({iso}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN TRY_CAST({iso} AS DATE) END"


def prefix_number(column: str) -> str:
    digits = rf"regexp_extract({column}, '^\s*([+-]?\d+)', 1)"
    return (
        f"CASE WHEN {column} IS NULL OR {digits} = '' THEN NULL WHEN TRY_CAST({digits} AS BIGINT) IS NOT NULL "
        f"THEN TRY_CAST({digits} AS BIGINT) WHEN {digits} LIKE '-%' THEN -9223372036854775808 "
        "ELSE 9223372036854775807 END"
    )


def whole_number(column: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN coalesce({prefix_number(column)}, 0) END"


def blank_null(column: str) -> str:
    return f"nullif(trim({column}, ' '), '')"


GRADE_CASE = """CASE
  WHEN regexp_full_match(trim(upper(GradeName), ' '), 'PRIMARY ?[1-7]') THEN 'Primary ' || right(trim(GradeName, ' '), 1)
  WHEN trim(upper(GradeName), ' ') = 'BABY CLASS' THEN 'Baby Class'
  WHEN trim(upper(GradeName), ' ') = 'MIDDLE CLASS' THEN 'Middle Class'
  WHEN trim(upper(GradeName), ' ') = 'TOP CLASS' THEN 'Top Class' END"""

MARKED_NAME = """CASE WHEN Status = 'signup' THEN 'Ann "A", O''Neil' WHEN Status = 'purchase' THEN ' ' END"""

PARTS = {
    "raw_pupil": """
SELECT e.event_id AS ord, strftime(e.ts, '%Y/%m/%d') AS SnapshotDate,
  CASE WHEN e.user_id % 17 = 0 THEN '   ' ELSE '  ' || n.n_name || ' ' END AS AcademyName,
  CAST(e.user_id AS VARCHAR) AS PupilID, substr(c.c_name, 1, 8) AS FirstName, substr(c.c_name, 10) AS LastName,
  e.event_type AS Status, CAST(e.user_id % 11 AS VARCHAR) AS GradeId,
  CASE WHEN e.user_id % 11 BETWEEN 1 AND 7
       THEN CASE WHEN e.event_id % 2 = 0 THEN 'primary' ELSE ' Primary ' END || CAST(e.user_id % 11 AS VARCHAR)
       WHEN e.user_id % 11 = 8 THEN 'baby class' WHEN e.user_id % 11 = 9 THEN ' TOP CLASS '
       WHEN e.user_id % 11 = 10 THEN 'Nursery' END AS GradeName,
  CASE WHEN e.user_id % 5 = 0 THEN '' ELSE ' ' || lower(c.c_mktsegment) END AS Stream
FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "raw_marks": """
SELECT event_id AS ord, strftime(ts, '%Y/%m/%d') AS Date, CAST(user_id AS VARCHAR) AS PupilID,
  CASE event_type WHEN 'error' THEN ' ' WHEN 'purchase' THEN 'Absent' ELSE 'Present' END AS Attendance
FROM events WHERE event_type <> 'signup'""",
    "clean_pupil": f"""
SELECT ord, {parsed_date('SnapshotDate')} AS snapshot_date, {whole_number('PupilID')} AS pupil_id,
  {blank_null('AcademyName')} AS academy_name, {blank_null('FirstName')} AS first_name,
  {blank_null('LastName')} AS last_name, {blank_null('Status')} AS status,
  {whole_number('GradeId')} AS grade_id, {GRADE_CASE} AS grade_name,
  upper({blank_null('Stream')}) AS stream
FROM raw_pupil""",
    "stg_pupil": """
SELECT snapshot_date, pupil_id, academy_name, first_name, last_name, status, grade_id, grade_name, stream
FROM clean_pupil WHERE snapshot_date IS NOT NULL AND pupil_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY pupil_id, snapshot_date ORDER BY ord) = 1""",
    "stg_marks": f"""
SELECT attendance_date, pupil_id, attendance FROM (
  SELECT ord, {parsed_date('Date')} AS attendance_date, {whole_number(blank_null('PupilID'))} AS pupil_id,
    {blank_null('Attendance')} AS attendance FROM raw_marks)
WHERE attendance_date IS NOT NULL AND pupil_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY pupil_id, attendance_date ORDER BY ord) = 1""",
    "dim_date": """
SELECT CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS date_key, snapshot_date AS date,
  CAST(year(snapshot_date) AS INTEGER) AS year, CAST(month(snapshot_date) AS INTEGER) AS month,
  CAST(day(snapshot_date) AS INTEGER) AS day, dayname(snapshot_date) AS weekday
FROM (SELECT DISTINCT snapshot_date FROM stg_pupil)""",
    "dim_pupil": """
SELECT row_number() OVER (ORDER BY pupil_id) AS pupil_key, pupil_id, first_name, last_name FROM (
  SELECT * FROM stg_pupil QUALIFY row_number() OVER (PARTITION BY pupil_id ORDER BY snapshot_date) = 1)""",
    "dim_academy": """
SELECT row_number() OVER (ORDER BY academy_name) AS academy_key, academy_name
FROM (SELECT DISTINCT academy_name FROM stg_pupil WHERE academy_name IS NOT NULL)""",
    "dim_grade": """
SELECT row_number() OVER (ORDER BY grade_id) AS grade_key, grade_id, grade_name FROM (
  SELECT * FROM stg_pupil WHERE grade_id IS NOT NULL AND grade_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY grade_id ORDER BY snapshot_date, grade_name) = 1)""",
    "dim_stream": """
SELECT row_number() OVER (ORDER BY stream) AS stream_key, stream
FROM (SELECT DISTINCT stream FROM stg_pupil WHERE stream IS NOT NULL)""",
    "fact": """
SELECT s.snapshot_date AS fact_date, d.date_key, p.pupil_key, a.academy_key, g.grade_key, t.stream_key,
  s.status, m.attendance, md5(CAST(s.snapshot_date AS VARCHAR)) AS prcs_id
FROM stg_pupil s JOIN stg_marks m ON m.attendance_date = s.snapshot_date AND m.pupil_id = s.pupil_id
JOIN dim_date d ON d.date = s.snapshot_date JOIN dim_pupil p ON p.pupil_id = s.pupil_id
LEFT JOIN dim_academy a ON a.academy_name = s.academy_name LEFT JOIN dim_grade g ON g.grade_id = s.grade_id
LEFT JOIN dim_stream t ON t.stream = s.stream""",
    "rate": """
SELECT d.date AS fact_date, r.academy_name, r.grade_name, r.attendance_rate, r.total_pupils_presented,
  d.year, d.month, d.weekday
FROM (SELECT f.fact_date, a.academy_name, g.grade_name,
        CAST(sum(CASE WHEN f.attendance = 'Present' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS attendance_rate,
        count(*) AS total_pupils_presented
      FROM fact f LEFT JOIN dim_academy a USING (academy_key) LEFT JOIN dim_grade g USING (grade_key)
      GROUP BY f.fact_date, a.academy_name, g.grade_name) r
JOIN dim_date d ON d.date = r.fact_date""",
    "weekdays": """
SELECT weekday, round(avg(1 - attendance_rate), 6) AS avg_absenteeism_rate,
  round(avg(total_pupils_presented), 6) AS avg_daily_pupils, count(DISTINCT academy_name) AS academies_count
FROM rate GROUP BY weekday""",
    "benchmarks": """
SELECT academy_name, overall_attendance_rate, total_unique_pupils,
  CAST(rank() OVER (ORDER BY overall_attendance_rate DESC) AS INTEGER) AS rank
FROM (SELECT a.academy_name,
        CAST(sum(CASE WHEN f.attendance = 'Present' THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
          AS overall_attendance_rate,
        count(DISTINCT f.pupil_key) AS total_unique_pupils
      FROM fact f LEFT JOIN dim_academy a USING (academy_key) GROUP BY a.academy_name)""",
}
NAMES = list(PARTS)
WITH = ",\n".join(f"{name} AS ({body})" for name, body in PARTS.items())


def over(select: str) -> str:
    return f"WITH {WITH}\n{select}"


COUNTED = {
    "raw_pupil": "raw_pupil", "raw_pupil_attendance": "raw_marks", "stg_pupil": "stg_pupil",
    "stg_pupil_attendance": "stg_marks", "dim_date": "dim_date", "dim_pupil": "dim_pupil",
    "dim_academy": "dim_academy", "dim_grade": "dim_grade", "dim_stream": "dim_stream",
    "fact_pupil_attendance_daily": "fact",
}
LAYERED = sorted(COUNTED, key=lambda name: (("raw", "stg", "dim", "fac").index(name[:3]), name))


def union(rows) -> str:
    return "\nUNION ALL\n".join(rows)


def counts(alias: str = "row_count", absent: tuple[str, ...] = ()) -> dict[str, str]:
    return {
        name: f"SELECT '{name}' AS table_name, " + (f"CAST(0 AS BIGINT) AS {alias}" if part in absent else f"count(*) AS {alias}")
        for name, part in COUNTED.items()
    }


def null_check(table: str, part: str, columns: str) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS test, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {part}" for c in columns.split()
    ]


def repeat_check(table: str, part: str, key: str, test: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in key.split(","))
    return (
        f"SELECT '{table}' AS table_name, '{key}' AS column_name, '{test}' AS test, count(*) AS failures FROM "
        f"(SELECT {key} FROM {part} WHERE {present} GROUP BY {key} HAVING count(*) > 1)"
    )


def orphan_check(key: str, dim: str) -> str:
    return (
        f"SELECT 'fact_pupil_attendance_daily' AS table_name, '{key}' AS column_name, 'foreign_key' AS test, "
        f"count(*) AS failures FROM fact f WHERE f.{key} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})"
    )


def dims_by_key() -> list[tuple[str, str]]:
    return [
        ("date_key", "dim_date"), ("pupil_key", "dim_pupil"), ("academy_key", "dim_academy"),
        ("grade_key", "dim_grade"), ("stream_key", "dim_stream"),
    ]


def published(skipped: str = "") -> str:
    tables = [("fact_pupil_attendance_daily", "fact", "pupil_key")] + [(d, d, k) for k, d in dims_by_key()]
    return union(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum({k}) AS BIGINT) AS key_sum"
        + (f", {'true' if t == skipped else 'false'} AS skipped" if skipped else "")
        + f" FROM {part}" for t, part, k in tables
    )


FACT_COLUMNS = "fact_date, date_key, pupil_key, academy_key, grade_key, stream_key, status, attendance, prcs_id"
WEEKEND = "dayname(fact_date) IN ('Saturday', 'Sunday')"

# Marks as the malformed lines hold them: without the rows that have a cell too many.
MALFORMED = """SELECT ord, Date, PupilID, CASE ord % 10 WHEN 1 THEN NULL
  WHEN 2 THEN 'Pre' || chr(10) || 'sent, ' || CAST(ord AS VARCHAR) WHEN 3 THEN 'a, "b"' ELSE Attendance END AS Attendance
FROM raw_marks WHERE ord % 10 <> 0"""


def over_with(changed: dict[str, str], select: str) -> str:
    """Like ``over``, with other bodies for some of the parts; a body may read the part it replaces as ``given``."""
    bodies = {**PARTS, **{name: body.replace("given", f"({PARTS[name]})") for name, body in changed.items()}}
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in bodies.items()) + f"\n{select}"


def members_by_batch(dim: str, natural: str) -> str:
    named = " AND grade_name IS NOT NULL" if dim == "dim_grade" else ""
    return (
        f"SELECT '{dim}' AS dimension, row_number() OVER (ORDER BY seen > DATE '2024-01-01', {natural}) AS member_key, "
        f"CAST({natural} AS VARCHAR) AS member FROM (SELECT {natural}, min(snapshot_date) AS seen FROM stg_pupil "
        f"WHERE {natural} IS NOT NULL{named} GROUP BY {natural})"
    )


ORACLE = {
    "date_text_parse": rf"""
SELECT event_id, text, {parsed_date('text')} AS parsed FROM (
  SELECT event_id, '2024' || sep || lpad(CAST(user_id % 14 AS VARCHAR), 2, '0') || sep
    || lpad(CAST(event_id % 33 AS VARCHAR), 2, '0') || ' 10:00' AS text
  FROM (SELECT *, CASE event_type WHEN 'click' THEN '-' WHEN 'view' THEN '' ELSE '/' END AS sep FROM events))""",
    "cast_prefix_int": f"""
SELECT event_id, text, {whole_number('text')} AS number, {prefix_number('text')} AS number_or_null FROM (
  SELECT event_id, CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) || 'abc'
    WHEN 'view' THEN '  -' || CAST(event_id AS VARCHAR) || '.7 '
    WHEN 'signup' THEN CAST(user_id AS VARCHAR) || '99999999999999999999'
    WHEN 'purchase' THEN props END AS text FROM events)""",
    "blank_to_null": f"""
SELECT event_id, {blank_null('raw')} AS text FROM (
  SELECT event_id, CASE event_type WHEN 'click' THEN '   ' WHEN 'view' THEN ''
    WHEN 'signup' THEN chr(9) || props || '  ' ELSE ' ' || props END AS raw FROM events)""",
    "grade_name_normalise": over(f"SELECT ord AS event_id, GradeName, {GRADE_CASE} AS grade_name FROM raw_pupil"),
    "stream_normalise": over(f"SELECT ord AS event_id, upper({blank_null('Stream')}) AS stream FROM raw_pupil"),
    "batch_id_md5": "SELECT event_id, md5(strftime(ts, '%Y-%m-%d %H:%M:%S.%g')) AS prcs_id FROM events",
    "csv_raw_load": over(f"""
SELECT SnapshotDate, AcademyName, PupilID, FirstName, {MARKED_NAME} AS MiddleName, LastName, Status, GradeId,
  GradeName, nullif(Stream, '') AS Stream FROM raw_pupil"""),
    "csv_attendance_load": over("SELECT Date, PupilID, Attendance FROM raw_marks"),
    "csv_to_stage": over("SELECT * FROM stg_pupil"),
    "stream_to_stage": over("SELECT * FROM stg_marks"),
    "raw_full_replace": over(
        "SELECT SnapshotDate, upper(Status) AS Status, count(*) AS n FROM raw_pupil GROUP BY ALL"),
    "stg_pupil_clean": over("SELECT * FROM stg_pupil"),
    "stg_attendance_clean": over("SELECT * FROM stg_marks"),
    "stage_insert_ignore": over("""
SELECT * REPLACE (CASE WHEN snapshot_date <= DATE '2024-01-20' THEN status ELSE upper(status) END AS status)
FROM stg_pupil"""),
    "empty_tables_created": over(union(
        f"{sql}, false AS created_again"
        + ("" if name.startswith(("dim", "fact")) else f" FROM {COUNTED[name]}")
        for name, sql in counts(absent=tuple(n for n in NAMES if n.startswith(("dim", "fact")))).items())),
    "truncate_all_counts": over(union(
        f"{sql}, CAST(0 AS BIGINT) AS rows_after" + ("" if name.startswith("fact") else f" FROM {COUNTED[name]}")
        for name, sql in counts("rows_before", absent=("fact",)).items())),
    "dim_date_build": over("SELECT * FROM dim_date"),
    "dim_pupil_build": over("SELECT * FROM dim_pupil"),
    "dim_academy_build": over("SELECT * FROM dim_academy"),
    "dim_grade_build": over("SELECT * FROM dim_grade"),
    "dim_stream_build": over("SELECT * FROM dim_stream"),
    "dim_incremental_keys": over("""
SELECT row_number() OVER (ORDER BY seen > DATE '2024-01-01', pupil_id) AS pupil_key, pupil_id, first_name, last_name
FROM (SELECT *, snapshot_date AS seen FROM stg_pupil
      QUALIFY row_number() OVER (PARTITION BY pupil_id ORDER BY snapshot_date) = 1)"""),
    "distinct_multi_col": over("SELECT DISTINCT pupil_id, first_name, last_name FROM stg_pupil"),
    "join_scalar_config": over("""
SELECT c.target_date, s.pupil_id, s.academy_name, s.status
FROM (SELECT min(date) AS target_date FROM dim_date) c JOIN stg_pupil s ON s.snapshot_date = c.target_date"""),
    "join_inner_multikey": over("""
SELECT s.snapshot_date, s.pupil_id, s.status, m.attendance
FROM stg_pupil s JOIN stg_marks m ON m.attendance_date = s.snapshot_date AND m.pupil_id = s.pupil_id"""),
    "join_left_dims": over("""
SELECT s.snapshot_date, s.pupil_id, a.academy_key, g.grade_key, t.stream_key
FROM stg_pupil s LEFT JOIN dim_academy a ON a.academy_name = s.academy_name
LEFT JOIN dim_grade g ON g.grade_id = s.grade_id LEFT JOIN dim_stream t ON t.stream = s.stream"""),
    "semi_join_exists": over("""
SELECT snapshot_date, pupil_id, status FROM stg_pupil s WHERE EXISTS
  (SELECT 1 FROM stg_marks m WHERE m.attendance_date = s.snapshot_date AND m.pupil_id = s.pupil_id)"""),
    "anti_join_new_rows": over("""
SELECT snapshot_date, pupil_id, status FROM stg_pupil s WHERE NOT EXISTS
  (SELECT 1 FROM stg_marks m WHERE m.attendance_date = s.snapshot_date AND m.pupil_id = s.pupil_id)"""),
    "fact_target_date": over("""
SELECT 'first load' AS load, min(date) AS target_date FROM dim_date UNION ALL
SELECT 'next load', max(fact_date) + 1 FROM fact"""),
    "fact_first_load": over("SELECT * FROM fact WHERE fact_date = DATE '2024-01-01'"),
    "fact_next_day_load": over("SELECT * FROM fact WHERE fact_date <= DATE '2024-01-02'"),
    "fact_full_replay": over("SELECT * FROM fact"),
    "fact_history_load": over("SELECT * FROM fact"),
    "fact_gap_stall": over(f"""
SELECT fact_date, count(*) AS n, true AS stalled FROM fact
WHERE fact_date < (SELECT min(fact_date) FROM fact WHERE {WEEKEND}) GROUP BY fact_date"""),
    "fact_next_available": over(f"""
SELECT fact_date, count(*) AS n, false AS stalled FROM fact WHERE NOT {WEEKEND} GROUP BY fact_date"""),
    "load_summary": over("""
SELECT 'INCREMENTAL LOAD RESULT' AS status, count(*) AS total_fact_rows, max(fact_date) AS last_loaded_date,
  count(*) FILTER (WHERE fact_date = DATE '2024-01-02') AS rows_inserted_this_run
FROM fact WHERE fact_date <= DATE '2024-01-02'"""),
    "late_rows_report": over("""
SELECT s.snapshot_date, s.pupil_id, m.attendance
FROM stg_pupil s JOIN stg_marks m ON m.attendance_date = s.snapshot_date AND m.pupil_id = s.pupil_id
WHERE s.snapshot_date <= DATE '2024-01-05' AND s.stream = 'BUILDING'"""),
    "daily_run": over("SELECT * FROM fact WHERE fact_date <= DATE '2024-01-02'"),
    "reporting_run": over("SELECT * FROM (\n" + union(
        null_check("attendance_rate", "rate", "fact_date academy_name grade_name attendance_rate total_pupils_presented")
        + null_check("absenteeism_weekday", "weekdays", "weekday avg_absenteeism_rate avg_daily_pupils academies_count")
        + null_check("academy_benchmarks", "benchmarks",
                     "academy_name overall_attendance_rate total_unique_pupils rank")
        + [repeat_check("absenteeism_weekday", "weekdays", "weekday", "unique")]
    ) + "\n) WHERE failures > 0"),
    "mart_attendance_rate": over("SELECT * FROM rate"),
    "mart_absenteeism_weekday": over("SELECT * FROM weekdays"),
    "mart_academy_benchmarks": over("SELECT * FROM benchmarks"),
    "attendance_rate_ordered": over("""
SELECT row_number() OVER (ORDER BY fact_date DESC NULLS FIRST, academy_name ASC NULLS LAST,
  grade_name ASC NULLS LAST) AS pos, fact_date, academy_name, grade_name, attendance_rate FROM rate"""),
    "weekday_ordered": over("""
SELECT row_number() OVER (ORDER BY avg_absenteeism_rate DESC NULLS FIRST, weekday ASC NULLS LAST) AS pos,
  weekday, academies_count FROM weekdays"""),
    "benchmarks_ordered": over("""
SELECT row_number() OVER (ORDER BY rank ASC NULLS LAST, academy_name ASC NULLS LAST) AS pos, academy_name, rank
FROM benchmarks"""),
    "table_counts": over(union(
        f"{counts()[name]}, CAST({pos} AS INTEGER) AS pos FROM {COUNTED[name]}"
        for pos, name in enumerate(LAYERED, start=1))),
    "literal_union_null": over("SELECT grade_id AS id FROM stg_pupil UNION ALL SELECT NULL FROM stg_pupil"),
    "model_chain_filter": over("""
SELECT * FROM (SELECT grade_id AS id FROM stg_pupil UNION ALL SELECT NULL FROM stg_pupil) WHERE id = 1"""),
    "dq_not_null": over(union(
        null_check("attendance_rate", "rate", "fact_date academy_name grade_name attendance_rate total_pupils_presented")
        + null_check("absenteeism_weekday", "weekdays", "weekday avg_absenteeism_rate avg_daily_pupils academies_count")
        + null_check("academy_benchmarks", "benchmarks",
                     "academy_name overall_attendance_rate total_unique_pupils rank"))),
    "dq_unique": over(union((
        repeat_check("absenteeism_weekday", "weekdays", "weekday", "unique"),
        repeat_check("raw_pupil", "clean_pupil", "pupil_id,snapshot_date", "unique")))),
    "dq_primary_keys": over(union(
        [repeat_check("stg_pupil", "stg_pupil", "pupil_id,snapshot_date", "primary_key"),
         repeat_check("stg_pupil_attendance", "stg_marks", "pupil_id,attendance_date", "primary_key"),
         repeat_check("fact_pupil_attendance_daily", "fact", "fact_date,pupil_key", "primary_key")]
        + [repeat_check(dim, dim, key, "primary_key") for key, dim in dims_by_key()]
        + [repeat_check(dim, dim, key, "unique") for dim, key in (
            ("dim_pupil", "pupil_id"), ("dim_academy", "academy_name"), ("dim_grade", "grade_id"),
            ("dim_stream", "stream"))])),
    "dq_foreign_keys": over(union(orphan_check(key, dim) for key, dim in dims_by_key())),
    "dq_foreign_keys_orphans": over(union(
        orphan_check(key, {
            "dim_stream": "(SELECT * FROM dim_stream WHERE false)",
            "dim_grade": "(SELECT * FROM dim_grade WHERE grade_name <> 'Top Class')",
        }.get(dim, dim)) for key, dim in dims_by_key())),
    "sync_full": over(published()),
    "sync_batch_only": over("SELECT * FROM fact WHERE fact_date = (SELECT max(fact_date) FROM fact)"),
    "sync_batch_append": over("SELECT * FROM fact WHERE fact_date <= DATE '2024-01-02'"),
    "sync_empty_skipped": over(published("fact_pupil_attendance_daily")),
    "sync_tsv_roundtrip": over(rf"""
SELECT ord AS event_id, AcademyName, Status || chr(9) || '"x" \' AS Status,
  CASE WHEN Status = 'click' THEN 'NA' WHEN Status = 'view' THEN 'NULL' WHEN Status = 'error' THEN 'n/a'
    ELSE {MARKED_NAME} END AS MiddleName, GradeName, Stream FROM raw_pupil"""),
    "adhoc_sql_file": over("""
SELECT d.weekday, ';' AS separator, f.attendance, count(*) AS marks, count(DISTINCT f.pupil_key) AS pupils
FROM fact f JOIN dim_date d ON d.date_key = f.date_key WHERE f.status = 'purchase'
GROUP BY d.weekday, f.attendance"""),
    "csv_malformed_rows": over(f"""
SELECT Date, PupilID, Attendance, NULL AS text, NULL AS reason FROM ({MALFORMED}) UNION ALL
SELECT Date, NULL, NULL, Date || ',' || PupilID || ',' || Attendance || ',extra', '4 cells instead of 3'
FROM raw_marks WHERE ord % 10 = 0"""),
    "stream_malformed_rows": over_with({"raw_marks": """
SELECT ord, Date, PupilID, CASE ord % 10 WHEN 1 THEN NULL
  WHEN 2 THEN 'Pre' || chr(10) || 'sent, ' || CAST(ord AS VARCHAR) WHEN 3 THEN 'a, "b"' ELSE Attendance END AS Attendance
FROM given WHERE ord % 10 <> 0"""}, """
SELECT *, (SELECT count(*) FROM events WHERE event_type <> 'signup' AND event_id % 10 = 0) AS rejected FROM stg_marks"""),
    "replace_cut_off": over("""
SELECT SnapshotDate, Status, count(*) AS n, place FROM raw_pupil, (VALUES ('raw'), ('published')) p(place) GROUP BY ALL"""),
    "drop_all_counts": over(union(
        f"{sql}, CAST(0 AS BIGINT) AS rows_after, false AS exists_after FROM {COUNTED[name]}"
        for name, sql in counts("rows_before").items())),
    "dims_two_batches": over(union(members_by_batch(dim, natural) for dim, natural in (
        ("dim_academy", "academy_name"), ("dim_grade", "grade_id"), ("dim_stream", "stream")))),
    "dim_first_name_wins": over_with({"raw_pupil": """
SELECT * REPLACE (FirstName || substr(SnapshotDate, 9, 2) AS FirstName,
  CASE WHEN CAST(GradeId AS BIGINT) % 3 = 0 AND CAST(substr(SnapshotDate, 9, 2) AS INTEGER) % 2 = 0
    THEN ' middle Class ' ELSE GradeName END AS GradeName) FROM given"""}, """
SELECT 'pupil' AS dimension, pupil_id AS id, first_name || ' ' || last_name AS name FROM stg_pupil
QUALIFY row_number() OVER (
  PARTITION BY pupil_id ORDER BY snapshot_date NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-04', snapshot_date) = 1
UNION ALL
SELECT 'grade', grade_id, grade_name FROM stg_pupil WHERE grade_id IS NOT NULL AND grade_name IS NOT NULL
QUALIFY row_number() OVER (
  PARTITION BY grade_id ORDER BY snapshot_date NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-04', snapshot_date, grade_name) = 1"""),
    "fact_insert_ignore": over("SELECT * FROM fact WHERE fact_date <= DATE '2024-01-02'"),
    "fact_load_log": over("""
SELECT prcs_id, fact_date, count(*) AS n, load FROM fact, (VALUES ('history'), ('daily')) l(load)
WHERE load = 'history' OR fact_date <= DATE '2024-01-03' GROUP BY ALL"""),
    "fact_history_gap": over("SELECT fact_date, count(*) AS n FROM fact WHERE fact_date < DATE '2024-01-10' GROUP BY fact_date"),
    "publish_refused": over("""
SELECT * FROM (
  SELECT 'dim_pupil' AS table_name, 'pupil_key' AS column_name, 'primary_key' AS test, count(*) AS failures
  FROM dim_pupil WHERE pupil_id % 7 = 0 UNION ALL
  SELECT 'dim_pupil', 'pupil_id', 'unique', count(*) FROM dim_pupil WHERE pupil_id % 7 = 0 UNION ALL
  SELECT 'fact_pupil_attendance_daily', 'grade_key', 'foreign_key', count(*)
  FROM fact JOIN dim_grade USING (grade_key) WHERE fact_date = DATE '2024-01-01' AND grade_name = 'Top Class'
) WHERE failures > 0 UNION ALL SELECT 'published', '', '', 0"""),
    "marts_published": over("""
SELECT 'attendance_rate' AS mart, CAST(fact_date AS VARCHAR) AS k1, academy_name AS k2, grade_name AS k3,
  round(attendance_rate, 6) AS rate, total_pupils_presented AS n FROM rate UNION ALL
SELECT 'absenteeism_weekday', weekday, NULL, NULL, avg_absenteeism_rate, academies_count FROM weekdays UNION ALL
SELECT 'academy_benchmarks', academy_name, NULL, NULL, round(overall_attendance_rate, 6), total_unique_pupils FROM benchmarks"""),
    "marts_from_increments": over_with({"fact": "SELECT * FROM given WHERE fact_date <> DATE '2024-01-05'"}, """
SELECT weekday AS name, avg_absenteeism_rate AS rate, avg_daily_pupils AS pupils, academies_count AS n FROM weekdays UNION ALL
SELECT academy_name, round(overall_attendance_rate, 6), CAST(total_unique_pupils AS DOUBLE), rank FROM benchmarks"""),
    "adhoc_sql_writes": over("""
SELECT stream AS name, stream_key AS n FROM dim_stream UNION ALL
SELECT 'NEW ' || academy_name, 1000 + academy_key FROM dim_academy WHERE academy_name NOT LIKE 'A%' UNION ALL
SELECT CASE WHEN pupil_id % 3 = 0 THEN first_name || ' ' || upper(first_name) || '; x'
  ELSE first_name || ' ' || last_name END, pupil_key FROM dim_pupil UNION ALL
SELECT 'insert', count(*) FROM dim_academy UNION ALL
SELECT 'delete', count(*) FROM dim_academy WHERE academy_name LIKE 'A%' UNION ALL
SELECT 'update', count(*) FROM dim_pupil WHERE pupil_id % 3 = 0 UNION ALL
SELECT 'query', (SELECT count(*) FROM dim_stream) + (SELECT count(*) FROM dim_academy WHERE academy_name NOT LIKE 'A%')
UNION ALL SELECT 'refused', 2"""),
    "sync_full_rows": over("SELECT * FROM fact"),
}
