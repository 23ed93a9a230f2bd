"""Global running sums, row numbers, ranks and surrogate keys without a single sorting task.

The rows are range-partitioned and sorted once and kept as a scratch table together with their slot
(partition and row inside it). Sums per partition, one row each, give every partition its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import Scratch

# monotonically_increasing_id() holds the partition above bit 33 and the row number below it.
SLOT_BITS = 33


def _ranged(rows: DataFrame, order: list[Column], scratch: Scratch, label: str) -> DataFrame:
    slotted = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = scratch.keep(slotted.withColumn("_slot", F.monotonically_increasing_id()), label)
    return kept.withColumn("_range", F.shiftright("_slot", SLOT_BITS))


def _offsets(totals: DataFrame) -> DataFrame:
    # One row per range partition: bounded by the shuffle partition setting, not by the data.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_total").over(earlier), F.lit(0))
    return F.broadcast(totals.select("_range", offset.alias("_offset")))


def number_rows(rows: DataFrame, order: list[Column], column: str, scratch: Scratch) -> DataFrame:
    """Adds 1..N in the given order, which has to be total for a repeatable numbering."""
    ranged = _ranged(rows, order, scratch, column)
    offsets = _offsets(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_total")))
    row = F.col("_slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    return ranged.join(offsets, "_range").select(*rows.columns, (F.col("_offset") + row + 1).alias(column))


def sum_before(rows: DataFrame, order: list[Column], value: str, column: str, scratch: Scratch) -> DataFrame:
    """Adds the sum of ``value`` over all rows that come earlier in the given total order."""
    ranged = _ranged(rows, order, scratch, column)
    offsets = _offsets(ranged.groupBy("_range").agg(F.sum(value).alias("_total")))
    earlier = Window.partitionBy("_range").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(value).over(earlier), F.lit(0))
    return ranged.withColumn(column, within).join(offsets, "_range").select(
        *rows.columns, (F.col(column) + F.col("_offset")).alias(column)
    )


def rank_descending(rows: DataFrame, measure: str, column: str, scratch: Scratch) -> DataFrame:
    """``RANK() OVER (ORDER BY measure DESC)``: ties share a rank and leave a gap behind them.

    The rank of a value is one more than the number of rows above it, so only distinct values are sorted.
    ``rows`` is read twice and should be a stored table; ``measure`` must not be NULL.
    """
    levels = rows.groupBy(measure).agg(F.count(F.lit(1)).alias("_rows"))
    above = sum_before(levels, [F.desc(measure)], "_rows", "_above", scratch)
    return rows.join(above.drop("_rows"), measure).select(
        *rows.columns, (F.col("_above") + 1).cast("int").alias(column)
    )


def assign_keys(members: DataFrame, natural: str, key: str, start: int, scratch: Scratch) -> DataFrame:
    """Dense surrogate keys start+1.. in the order of the natural key, which is unique in ``members``."""
    numbered = number_rows(members, [F.col(natural).asc()], key, scratch)
    return numbered.withColumn(key, F.col(key) + F.lit(start))
