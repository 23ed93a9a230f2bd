from __future__ import annotations

import csv

import pytest

from rollmart import __main__ as command
from rollmart.plans.checks import DataTestFailure
from rollmart.schemas import ATTENDANCE_EXTRACT, PUPIL_EXTRACT


@pytest.fixture
def files(tmp_path):
    def write(name, header, rows):
        with open(tmp_path / name, "w", newline="") as out:
            csv.writer(out).writerows([header, *rows])
        return str(tmp_path / name)

    return (
        write("p.csv", PUPIL_EXTRACT, [("2025/01/01", "", p, "A", "", "B", "In", 1, "primary1", "x") for p in (1, 2)]),
        write("a.csv", ATTENDANCE_EXTRACT, [("2025/01/01", p, "Present") for p in (1, 2)]),
    )


def test_commands(spark, tmp_path, files, capsys):
    root = str(tmp_path / "store")

    def call(*arguments):
        command.main(["--root", root, *arguments])
        return capsys.readouterr().out

    assert "inserted=2, stalled=False" in call("run", *files, "--batch-id", "b1")
    assert "inserted=0, stalled=False" in call("run", *files)
    counts = call("counts").splitlines()
    assert [line.split("|")[2].strip() for line in counts if line.startswith("|") and "table" not in line] == [
        "2", "2", "2", "2", "0", "1", "1", "2", "1", "2",
    ]
    target = f"parquet:{tmp_path / 'out'}"
    with pytest.raises(DataTestFailure, match="attendance_rate.academy_name not_null: 1"):
        call("report", target)
    assert "batch" not in call("report", target, "--mode", "batch_append", "--batch-id", "b1", "--severity", "warn")
    assert "rows=2, skipped=False" in call("report", f"tsv:{tmp_path / 'tsv'}", "--severity", "warn", "--rebuild")
    query = tmp_path / "q.sql"
    query.write_text("SELECT count(*) AS marks FROM fact_pupil_attendance_daily WHERE prcs_id = :b;")
    assert "|2    |" in call("sql", str(query), "--arg", "b=b1")
    call("truncate")
    assert set(line.split("|")[2].strip() for line in call("counts").splitlines() if "_" in line and "table" not in line) == {"0"}
    call("drop")
    assert not (tmp_path / "store" / "dim_date").exists()
    with pytest.raises(SystemExit):
        call("report", "ftp:x")
