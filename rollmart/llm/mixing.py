"""Mixing sources to target weights: Sainte-Lague apportionment of equal blocks of words.

Targets share the size of the whole corpus by weight; none exceeds ``MAX_REPEATS`` times its source, what is above goes
to the others by weight. The corpus is a number of equal blocks; they are dealt to the sources by highest quotients
target / (2 seats + 1), and each source's blocks in the same way to its shards by their words. A shard orders its
documents by a seeded hash and reads its stream of blocks, again from the start if need be, until the quota is met. The mix
as documents takes the one at which the quota is met whole or not at all; the difference goes to the next shard.

Only one row per source comes to the driver (a mix lists its sources). Large sources are split into shards of about
``SHARD_WORDS`` words and ``SHARD_ROWS`` rows, up to ``MAX_SHARDS`` of them, so no task holds a source, also if its texts
are empty; rows without ``doc_id`` are spread by their text. NULL texts have no words and are never
taken; NULL sources are one source, the last; repeated rows are documents of their own; reruns agree because nothing
depends on the order of the input; an empty table gives an empty mix.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import Scratch
from .common import whole, words

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 17
SHARD_WORDS = 250_000
SHARD_ROWS = 50_000
MAX_SHARDS = 1 << 16
MAX_BLOCK = 256


def targets(sizes: Sequence[int], weights: Sequence[float], repeats: int = MAX_REPEATS) -> list[float]:
    """What each source should give; all together the sum of the sizes, none above ``repeats`` times its size."""
    found = [0.0] * len(sizes)
    open_ones, left = set(range(len(sizes))), float(sum(sizes))
    while open_ones:
        share = left / sum(weights[i] for i in open_ones)
        above = {i for i in open_ones if share * weights[i] > repeats * sizes[i]}
        if not above:
            for i in open_ones:
                found[i] = share * weights[i]
            break
        for i in above:
            found[i] = float(repeats * sizes[i])
            left -= found[i]
        open_ones -= above
    return found


def apportion(votes: Sequence[float], seats: int) -> list[int]:
    """Sainte-Lague: every seat goes to the highest votes / (2 seats + 1), ties to the earlier one.

    Seats by the rounded quota are right up to a few, which are then given or taken one by one.
    """
    total = float(sum(votes))
    if not total or not seats:
        return [0] * len(votes)
    held = [int(v * seats / total + 0.5) for v in votes]
    missing = seats - sum(held)
    if missing > 0:
        heap = [(-v / (2 * s + 1), i) for i, (v, s) in enumerate(zip(votes, held)) if v]
        heapq.heapify(heap)
        for _ in range(missing):
            _, i = heap[0]
            held[i] += 1
            heapq.heapreplace(heap, (-votes[i] / (2 * held[i] + 1), i))
    elif missing < 0:
        heap = [(v / (2 * s - 1), -i) for i, (v, s) in enumerate(zip(votes, held)) if s]
        heapq.heapify(heap)
        for _ in range(-missing):
            _, i = heapq.heappop(heap)
            held[-i] -= 1
            if held[-i]:
                heapq.heappush(heap, (votes[-i] / (2 * held[-i] - 1), i))
    return held


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def spare(text: Column) -> Column:
    """A number that spreads and orders rows which their ids do not tell apart."""
    return F.xxhash64(whole(text))


def _source_key(source: Column) -> Column:
    """A text that is never NULL and different for every source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def plan(sized: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Per source and shard: _key, _shard, _shards, source_size, target, _words and _quota (words the mix takes of it).

    ``sized`` has _key, _bucket (0 to MAX_SHARDS - 1) and size.
    """
    spark = sized.sparkSession
    buckets = sized.groupBy("_key", "_bucket").agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
    buckets = scratch.keep(buckets, "buckets")
    found = buckets.groupBy("_key").agg(F.sum("_words").alias("n"), F.sum("_rows").alias("rows")).collect()
    sizes, counts = ({r["_key"]: r[c] for r in found} for c in ("n", "rows"))
    names = sorted(sizes, key=lambda key: (not key, key))
    aims = targets([sizes[k] for k in names], [weights[i % len(weights)] for i in range(len(names))])
    block = max(1, min([MAX_BLOCK, *(int(aim) // 200 for aim in aims if aim)]))
    quotas = apportion(aims, round(sum(aims) / block))

    def shards(key: str) -> int:
        """A power of two, so that buckets are dealt evenly."""
        wanted = max(-(-sizes[key] // SHARD_WORDS), -(-counts[key] // SHARD_ROWS))
        return min(MAX_SHARDS, 1 << max(0, wanted - 1).bit_length())

    rows = [(k, shards(k), sizes[k], aim, q) for k, aim, q in zip(names, aims, quotas)]
    sources = spark.createDataFrame(rows, "_key string, _shards int, source_size long, target double, _blocks long")
    # One row per source, as the driver has just made them.
    per_shard = buckets.join(F.broadcast(sources), "_key").groupBy(
        "_key", (F.col("_bucket") % F.col("_shards")).alias("_shard"), "_shards", "source_size", "target", "_blocks"
    ).agg(F.sum("_words").alias("_words"))

    def deal(source: pd.DataFrame) -> pd.DataFrame:
        # At most MAX_SHARDS rows.
        source = source.sort_values("_shard")
        held = apportion(source["_words"].tolist(), int(source["_blocks"].iloc[0]))
        quota = pd.Series(held, index=source.index, dtype="int64") * block
        return source.assign(_quota=quota.clip(upper=source["_words"] * MAX_REPEATS))

    schema = "_key string, _shard int, _shards int, source_size long, target double, _blocks long, _words long, _quota long"
    return scratch.keep(per_shard.groupBy("_key").applyInPandas(deal, schema), "plan")


def take(rows: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Adds source_size, target, taken, the whole passes (_passes) that ``taken`` holds, and _key and _shard.

    ``rows`` has doc_id, source, size and _spare, a number that spreads rows without an id, and is evaluated twice.
    """
    # Seeded by the id alone where there is one.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "_spare")).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
    keyed = rows.withColumns({
        "_key": _source_key(F.col("source")), "_bucket": F.pmod(spread, F.lit(MAX_SHARDS)).cast("int"),
    })
    dealt = plan(keyed.select("_key", "_bucket", "size"), scratch, weights)
    per_source = dealt.select("_key", "_shards").distinct()
    sharded = keyed.join(per_source, "_key").withColumn("_shard", F.col("_bucket") % F.col("_shards")).drop("_shards")
    order = [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id"), F.col("size"), F.col("_spare")]
    before = Window.partitionBy("_key", "_shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    streamed = sharded.withColumn("_start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    planned = streamed.join(dealt.drop("_shards", "_blocks"), ["_key", "_shard"])
    passes = F.when(F.col("_words") > 0, F.floor(F.col("_quota") / F.col("_words"))).otherwise(0).cast("long")
    rest = F.col("_quota") - F.col("_passes") * F.col("_words")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))
    return planned.withColumn("_passes", passes).select(
        *(c for c in rows.columns if c != "_spare"), "source_size", "target", (F.col("_passes") * F.col("size") + part).cast("long").alias("taken"),
        "_passes", "_key", "_shard",
    )


def _settle(borders: pd.DataFrame) -> pd.DataFrame:
    """Which documents at the borders of a source's shards, one a shard, are taken: what is owed or ahead is carried on."""
    borders = borders.sort_values("_at")
    owed, whole = 0, []
    for size, piece in zip(borders["_size"], borders["_piece"]):
        owed += piece
        whole.append(2 * owed >= size)
        owed -= size * whole[-1]
    return borders.assign(_whole=pd.Series(whole, index=borders.index, dtype="bool"))[["_of", "_at", "_whole"]]


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row for each time a document is taken, always as a whole.

    A source differs from its target by half of a document at a shard's border at most, and by what rounding to blocks leaves.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), "doc_id", "source", n_words(F.col("text")).alias("size"), spare(F.col("text")).alias("_spare")
    )
    piece = F.col("taken") - F.col("_passes") * F.col("size")
    taken = take(rows, scratch, weights, seed).where("taken > 0").withColumn("_piece", piece)
    cut = (F.col("_piece") > 0) & (F.col("_piece") < F.col("size"))
    borders = taken.where(cut).select(
        F.col("_key").alias("_of"), F.col("_shard").alias("_at"), F.col("size").alias("_size"), "_piece"
    )
    # At most MAX_SHARDS rows a source.
    settled = scratch.keep(borders.groupBy("_of").applyInPandas(_settle, "_of string, _at int, _whole boolean"), "borders")
    joined = taken.join(settled, cut & (F.col("_key") == F.col("_of")) & (F.col("_shard") == F.col("_at")), "left")
    whole = (F.col("_piece") == F.col("size")) | F.coalesce("_whole", F.lit(False))
    times = (F.col("_passes") + whole.cast("long")).cast("int")
    return joined.select("_row", F.explode(F.array_repeat(F.lit(0), times))).select("_row.*")
