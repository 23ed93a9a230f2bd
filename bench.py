"""Times the load steps, the 30-day replay, the marts and the other headline queries; prints one JSON line.

The load steps are timed as one warehouse is built; the queries then read it. Results go to the noop sink, so
every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rollmart import session  # noqa: E402
from workload import warehouse  # noqa: E402
from workload.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "mart_attendance_rate", "mart_absenteeism_weekday", "mart_academy_benchmarks", "attendance_rate_ordered",
    "csv_raw_load", "stage_insert_ignore", "dim_incremental_keys", "join_inner_multikey", "join_left_dims",
    "anti_join_new_rows", "fact_first_load", "fact_full_replay", "late_rows_report", "table_counts",
    "dq_primary_keys", "dq_foreign_keys", "sync_full", "sync_batch_append", "adhoc_sql_file",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()

    seconds: dict[str, float] = {}

    def timed(name, run):
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)

    store = warehouse.fresh(spark)
    for name, step in warehouse.STEPS.items():
        timed(f"load_{name}", lambda step=step: step(store, sf_dir))
    warehouse.keep(spark, sf_dir, store)
    for name in HEADLINE:
        timed(name, lambda name=name: REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    rows = store.read("raw_pupil").count()
    staging = seconds["load_raw"] + seconds["load_stage_and_dims"]
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(Path(sf_dir).name.removeprefix("sf")),
        "raw_rows": rows, "staged_rows_per_sec": round(rows / staging, 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
