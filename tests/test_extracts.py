"""The rejecting reader: kept and rejected rows of malformed extracts, in batch and stream."""

from __future__ import annotations

import pytest

from rollmart.plans import daily
from rollmart.schemas import ATTENDANCE_EXTRACT, PUPIL_EXTRACT
from rollmart.sources import extracts
from rollmart.streaming.intake import stage_arrivals

MARKS = """Date,PupilID,Attendance
2025/01/01,1,Present
2025/01/01,2,Present,extra
2025/01/01,3
2025/01/01,"4",in "quotes" here
"2025/01/01",5,"a
b, ""c"", d
e"

2025/01/01,6,Absent
2025/01/01,7,,
"""


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def kept(scan):
    return sorted(tuple(r)[:3] for r in extracts.kept_rows(scan).collect())


def rejected(scan):
    return sorted((r["text"], r["reason"]) for r in extracts.rejected_rows(scan, "marks").collect())


KEPT = [
    ("2025/01/01", "1", "Present"), ("2025/01/01", "3", None), ("2025/01/01", "4", 'in "quotes" here'),
    ("2025/01/01", "5", 'a\nb, "c", d\ne'), ("2025/01/01", "6", "Absent"),
]
LONG = [("2025/01/01,2,Present,extra", "4 cells instead of 3"), ("2025/01/01,7,,", "4 cells instead of 3")]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_every_row_is_kept_or_rejected(spark, tmp_path, ends):
    path = write(tmp_path / "marks.csv", MARKS.replace("\n", ends))
    scan = extracts.scan_extract(spark, path, ATTENDANCE_EXTRACT)
    assert [tuple(v and v.replace("\r\n", "\n") for v in row) for row in kept(scan)] == sorted(KEPT, key=lambda r: r[1])
    assert rejected(scan) == LONG


def test_only_files_with_open_lines_are_read_as_one_piece(spark, tmp_path):
    folder = tmp_path / "marks of + 100%"
    folder.mkdir()
    write(folder / "a b.csv", MARKS)
    write(folder / "plain.csv", "Date,PupilID,Attendance\n" + "2025/01/02,8,x\n" * 3000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        scan = extracts.scan_extract(spark, str(folder), ATTENDANCE_EXTRACT)
        assert [f.rpartition("/")[2] for f in extracts.files_with_open_lines(spark, str(folder))] == ["a%20b.csv"]
        assert scan.rdd.getNumPartitions() > 4
        assert len(kept(scan)) == 3000 + len(KEPT) and rejected(scan) == LONG
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_cell_without_an_end(spark, tmp_path):
    path = write(tmp_path / "marks.csv", 'Date,PupilID,Attendance\n2025/01/01,1,x\n2025/01/01,2,"Present\n2025/01/01,3,y\n')
    scan = extracts.scan_extract(spark, path, ATTENDANCE_EXTRACT)
    assert kept(scan) == [("2025/01/01", "1", "x")]
    [(text, reason)] = rejected(scan)
    assert reason == extracts.UNCLOSED and "2025/01/01,3,y" in text


def test_long_cells_and_an_empty_extract(spark, tmp_path):
    long = "word, " * 20_000
    path = write(tmp_path / "long.csv", f'Date,PupilID,Attendance\n2025/01/01,1,"{long}"\n2025/01/01,2,{"x" * 100_000}\n1,2,3,"{long}"\n')
    scan = extracts.scan_extract(spark, path, ATTENDANCE_EXTRACT)
    assert [len(r[2]) for r in kept(scan)] == [len(long), 100_000] and len(rejected(scan)) == 1
    empty = extracts.scan_extract(spark, write(tmp_path / "empty.csv", "Date,PupilID,Attendance\n"), ATTENDANCE_EXTRACT)
    assert kept(empty) == [] and rejected(empty) == []


def test_raw_load_counts_and_keeps_rejects(spark, store, tmp_path):
    pupils = write(tmp_path / "pupils.csv", ",".join(PUPIL_EXTRACT) + "\n2025/01/01,North,1,Ann,,Lee,In,1,PRIMARY1,a\n2025/01/01,North,2\n,,,,,,,,,,,\n")
    marks = write(tmp_path / "marks.csv", MARKS)
    with pytest.raises(extracts.MalformedExtract, match="raw_pupil: 1 rows, raw_pupil_attendance: 2 rows"):
        extracts.load_raw(store, pupils, marks, malformed="fail")
    assert not store.exists("raw_pupil")
    run = daily.run_daily(store, pupils, marks, "b1")
    assert run.raw == {"raw_pupil": 2, "raw_pupil_attendance": 5}
    assert run.rejected == {"raw_pupil": 1, "raw_pupil_attendance": 2}
    found = store.read("raw_rejected").orderBy("extract", "text").collect()
    assert [(r["extract"], r["first_cell"], r["reason"]) for r in found] == [
        ("raw_pupil", None, "12 cells instead of 10"), ("raw_pupil_attendance", "2025/01/01", "4 cells instead of 3"),
        ("raw_pupil_attendance", "2025/01/01", "4 cells instead of 3"),
    ]
    clean = write(tmp_path / "clean.csv", "Date,PupilID,Attendance\n2025/01/01,1,Present\n")
    assert extracts.load_raw(store, clean.replace("clean", "pupils"), clean).rejected == {"raw_pupil": 1, "raw_pupil_attendance": 0}
    assert store.read("raw_rejected").count() == 1
    with pytest.raises(ValueError):
        extracts.load_raw(store, pupils, marks, malformed="ignore")


def test_stream_reads_line_breaks_and_keeps_rejects_once(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", MARKS)
    write(folder / "b.csv", "Attendance,Date,PupilID\nPresent,2025/01/02,1\n".replace("Attendance,Date,PupilID", "Date,PupilID,Attendance").replace("Present,2025/01/02,1", "2025/01/02,1,Present"))
    for progress in ("p1", "p1", "p2"):
        stage_arrivals(store, "stg_pupil_attendance", str(folder), str(tmp_path / progress)).awaitTermination()
    rows = {(r["attendance_date"].day, r["pupil_id"]): r["attendance"] for r in store.read("stg_pupil_attendance").collect()}
    assert len(rows) == 6 and rows[1, 5] == 'a\nb, "c", d\ne'
    assert sorted((r["text"], r["reason"]) for r in store.read("raw_rejected").collect()) == LONG
