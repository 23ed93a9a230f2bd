"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VIRTUAL`` points of the ring; a key belongs to the arc that ends at the next point clockwise. A shard
takes the keys of its own arcs up to its capacity, in ring order; the others continue clockwise to the next shard with
room. Capacities add up to the number of rows, so shard sizes differ by one row at most, and a shard that joins moves
little besides the rows it takes.

Only the counts per arc, as many numbers as the ring has points, come to the driver, where the overflow is settled. Rows
are numbered round the ring once, over range partitions, so an arc that a third of all rows fall into is spread over many
tasks; the number tells the rank inside the arc, and the rank the segment. The key
is ``doc_id``; a row without one is placed by its text. Repeated rows each take a place of their own; an empty table has
no rows to place.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import blake2b
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..sources.folders import Scratch
from .common import whole

VIRTUAL = 128
RING_BITS = 62
CELL_BITS = 12


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, clockwise. A shard's points do not depend on the other shards."""
    def position(shard: int, node: int) -> int:
        return int.from_bytes(blake2b(f"{shard}/{node}".encode(), digest_size=8).digest(), "big") >> (64 - RING_BITS)

    return sorted((position(shard, node), shard) for shard in range(shards) for node in range(virtual))


def arcs_by_cell(points: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(cell, from, to, arc): the arcs cut at the borders of 2**CELL_BITS equal cells, so that a position finds its arc
    by an equality on the cell. The arc of a position is the first point at or after it."""
    positions = [p for p, _ in points]
    width = 1 << (RING_BITS - CELL_BITS)
    pieces = []
    for cell in range(1 << CELL_BITS):
        low, high = cell * width, (cell + 1) * width
        while low < high:
            arc = bisect_left(positions, low)
            end = min(high, positions[arc] + 1) if arc < len(positions) else high
            pieces.append((cell, low, end, arc % len(positions)))
            low = end
    return pieces


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def settle(counts: dict[int, int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, to, shard, slot): which ranks of an arc go to which shard, and the slot of the first of them."""
    room = list(capacity)
    placed: list[tuple[int, int, int, int]] = []
    waiting: list[tuple[int, int, int]] = []
    for arc in sorted(counts):
        owner = owners[arc]
        home = min(counts[arc], room[owner])
        room[owner] -= home
        if home:
            placed.append((arc, 0, home, owner))
        if home < counts[arc]:
            waiting.append((arc, home, counts[arc]))
    for arc, start, end in waiting:
        at = arc
        while start < end:
            at = (at + 1) % len(owners)
            taken = min(room[owners[at]], end - start)
            if taken:
                room[owners[at]] -= taken
                placed.append((arc, start, start + taken, owners[at]))
                start += taken
    slots = [0] * len(capacity)
    segments = []
    for arc, start, end, shard in sorted(placed):
        segments.append((arc, start, end, shard, slots[shard]))
        slots[shard] += end - start
    return segments


def assign(rows: DataFrame, shards: int, scratch: Scratch, virtual: int = VIRTUAL) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``rows`` has ``doc_id`` and ``_spare``, a number that places rows without an id and orders rows with the same one.
    """
    spark, points = rows.sparkSession, ring(shards, virtual)
    # As many rows as the ring has points and cells.
    pieces = spark.createDataFrame(arcs_by_cell(points), "_cell int, _low long, _high long, _arc int")
    position = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id"), F.col("_spare"))), 64 - RING_BITS)
    placed = rows.withColumn("_position", position).withColumn(
        "_cell", F.shiftright("_position", RING_BITS - CELL_BITS).cast("int")
    )
    inside = (F.col("_position") >= F.col("_low")) & (F.col("_position") < F.col("_high"))
    placed = placed.join(F.broadcast(pieces.withColumnRenamed("_cell", "_of")), (F.col("_cell") == F.col("_of")) & inside)
    # The place orders rows that nothing else tells apart, and lets their range be cut.
    placed = placed.drop("_cell", "_of", "_low", "_high").withColumn("_place", F.monotonically_increasing_id())
    placed = scratch.keep(placed, "arcs")

    counts = {r["_arc"]: r["count"] for r in placed.groupBy("_arc").count().collect()}
    segments = settle(counts, [shard for _, shard in points], capacities(sum(counts.values()), shards))
    ahead = dict(zip(sorted(counts), accumulate((counts[arc] for arc in sorted(counts)), initial=0)))
    # At most as many rows as arcs, shards and overflowing arcs together.
    settled = F.broadcast(spark.createDataFrame(
        [(*segment, ahead[segment[0]]) for segment in segments], "_of long, _first long, _last long, shard int, _slot long, _ahead long"
    ))
    order = [F.col(c) for c in ("_arc", "_position", "doc_id", "_spare", "_place")]
    ranked = number_rows(placed, order, "_number", scratch)
    rank = F.col("_number") - 1 - F.col("_ahead")
    within = (rank >= F.col("_first")) & (rank < F.col("_last"))
    return ranked.join(settled, (F.col("_arc") == F.col("_of")) & within).select(
        *(c for c in rows.columns if c != "_spare"), "shard", (F.col("_slot") + rank - F.col("_first")).alias("slot")
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, none for NULL, plus 8) and CRC-32 of the text (0 for NULL)."""
    return docs.select(
        "doc_id", (F.octet_length(whole(F.col("text"))) + 8).cast("long").alias("size"),
        F.crc32(whole(F.col("text")).cast("binary")).alias("text_crc32"),
        F.xxhash64(whole(F.col("text"))).alias("_spare"),
    )


def write_shards(docs: DataFrame, path: str, shards: int, rows_per_file: int = 100_000) -> None:
    """Writes the documents, whole, into one folder per shard, ordered by slot and cut into files by slot."""
    given = [c for c in docs.columns if c.lower() not in {"shard", "slot", "_spare"}]
    marked = docs.select(*given).withColumn("_spare", F.xxhash64(whole(F.col("text"))))
    placed = assign(marked, shards, Scratch(docs.sparkSession))
    cut = placed.withColumn("_file", F.floor(F.col("slot") / rows_per_file)).repartition("shard", "_file")
    cut.sortWithinPartitions("shard", "slot").drop("_file").write.partitionBy("shard").parquet(path)
