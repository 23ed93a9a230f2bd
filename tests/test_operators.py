from __future__ import annotations

from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from samples import snapshot
from rollmart.operators import keyed, numbering
from rollmart.plans import stage
from rollmart.sources.folders import Scratch

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_trims_before_the_shuffle(spark):
    rows = spark.range(10_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    first = keyed.first_per_key(rows, ("k",), ("id",))
    text = plan(first)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert first.where("k = 0").collect()[0]["id"] == 0
    assert first.count() == rows.select("k").distinct().count()


def test_first_per_key_does_not_depend_on_partitions(spark):
    rows = spark.range(3000).withColumn("k", F.col("id") % 70)
    want = sorted(map(tuple, keyed.first_per_key(rows, ("k",), ("id",)).collect()))
    for parts in (1, 3, 16):
        shuffled = rows.orderBy(F.rand(parts)).repartition(parts)
        assert sorted(map(tuple, keyed.first_per_key(shuffled, ("k",), ("id",)).collect())) == want


def test_insert_ignore(store, raw):
    first = raw(
        snapshot("2025/01/01", "1", status="one"), snapshot("2025/01/01", "1", status="two"),
        snapshot("2025/01/01", "2"), snapshot("bad", "3"), snapshot("2025/01/02", None),
    )
    result = keyed.insert_ignore(store, "stg_pupil", stage.clean_pupil(first))
    assert (result.offered, result.rejected, result.inserted) == (5, 2, 2)
    assert result.days == (date(2025, 1, 1),)

    again = keyed.insert_ignore(store, "stg_pupil", stage.clean_pupil(first))
    assert (again.inserted, again.days) == (0, ())

    second = raw(snapshot("2025/01/01", "1", status="new"), snapshot("2025/01/03", "1", status="new"))
    third = keyed.insert_ignore(store, "stg_pupil", stage.clean_pupil(second))
    assert (third.inserted, third.days) == (1, (date(2025, 1, 3),))
    rows = {(r["snapshot_date"].day, r["pupil_id"]): r["status"] for r in store.read("stg_pupil").collect()}
    assert rows == {(1, 1): "one", (1, 2): "In", (3, 1): "new"}


def test_insert_ignore_without_usable_rows(store, raw):
    result = keyed.insert_ignore(store, "stg_pupil", stage.clean_pupil(raw(snapshot("x", "1"))))
    assert (result.offered, result.rejected, result.inserted) == (1, 1, 0)
    assert store.read("stg_pupil").count() == 0


def test_insert_ignore_with_one_key_holding_a_third(store, raw, spark):
    rows = raw(*[snapshot("2025/01/01", "0" if i % 3 == 0 else str(i), status=str(i)) for i in range(600)])
    assert keyed.insert_ignore(store, "stg_pupil", stage.clean_pupil(rows.repartition(8))).inserted == 401
    assert store.read("stg_pupil").where("pupil_id = 0").first()["status"] == "0"


def numbered(rows, column):
    return [tuple(r) for r in rows.orderBy(column).collect()]


def test_number_rows_in_ranges_equals_one_window(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    order = [F.col("v").desc()]
    scratch = Scratch(spark)
    ranged = numbering.number_rows(rows, order, "n", scratch)
    assert "SinglePartition" not in plan(ranged.drop("_offset")).split("Window")[0]
    window = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    assert numbered(ranged, "n") == numbered(rows.withColumn("n", window), "n")


def test_number_rows_uses_several_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(2000).withColumn("w", F.col("id") * 3)
        got = numbering.number_rows(rows, [F.col("id")], "n", Scratch(spark))
        assert [tuple(r) for r in got.orderBy("id").collect()] == [(i, 3 * i, i + 1) for i in range(2000)]
        above = numbering.sum_before(rows, [F.desc("id")], "w", "s", Scratch(spark))
        total, want = 0, {}
        for i in reversed(range(2000)):
            want[i], total = total, total + 3 * i
        assert {r["id"]: r["s"] for r in above.collect()} == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@FEW
@given(st.lists(st.sampled_from([0.0, 0.25, 0.5, 0.75, 1.0]), min_size=1, max_size=40))
def test_rank_descending_equals_brute_force(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    want = {i: 1 + sum(other > v for other in values) for i, v in enumerate(values)}
    got = numbering.rank_descending(rows, "v", "rank", Scratch(spark))
    assert {r["i"]: r["rank"] for r in got.collect()} == want
    assert got.schema["rank"].dataType.simpleString() == "int"


def test_scratch_is_removed_at_the_end(spark, tmp_path):
    with Scratch(spark, str(tmp_path)) as scratch:
        kept, count = scratch.keep_counted(spark.range(5).toDF("id"), "five")
        assert (kept.count(), count) == (5, 5)
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())
