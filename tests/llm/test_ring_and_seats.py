"""Sharding against a plain walk round the ring, mixing against seat-by-seat apportionment, hot keys in both."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rollmart.llm import mixing, sharding
from rollmart.sources.folders import Folders, Scratch


def walk(positions, shards, virtual):
    """Shards by position, position by position: a full shard passes a key on clockwise."""
    points = sharding.ring(shards, virtual)
    n = len(positions)
    room = [n // shards + (s < n % shards) for s in range(shards)]

    def arc_of(position):
        return next((i for i, (p, _) in enumerate(points) if p >= position), 0)

    by_arc = defaultdict(list)
    for key in sorted(positions):
        by_arc[arc_of(key[0])].append(key)
    placed, waiting = {}, []
    for arc in sorted(by_arc):
        for key in by_arc[arc]:
            owner = points[arc][1]
            if room[owner]:
                room[owner] -= 1
                placed[key] = owner
            else:
                waiting.append((arc, key))
    for arc, key in waiting:
        at = arc
        while key not in placed:
            at = (at + 1) % len(points)
            if room[points[at][1]]:
                room[points[at][1]] -= 1
                placed[key] = points[at][1]
    return placed


@pytest.mark.parametrize("shards, virtual", [(3, 2), (5, 4), (7, 1)])
def test_shards_equal_a_walk_round_the_ring(spark, documents, shards, virtual):
    rng = random.Random(shards)
    rows = documents(*[(i, f"text {rng.randrange(9)}") for i in rng.sample(range(10_000), 300)])
    got = sharding.assign(sharding.digests(rows), shards, Scratch(spark), virtual).collect()
    shift = 64 - sharding.RING_BITS
    hashes = rows.select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id"), shift).alias("p")).collect()
    want = walk([(r["p"], r["doc_id"]) for r in hashes], shards, virtual)
    assert {r["doc_id"]: r["shard"] for r in got} == {key[1]: shard for key, shard in want.items()}


def test_a_hot_arc_is_ranked_by_many_tasks(spark, documents):
    rows = documents(*[(None, "the same")] * 4000, *[(7, "one id")] * 4000, *[(i, "x") for i in range(4000)])
    scratch = Scratch(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = sharding.assign(sharding.digests(rows), 24, scratch)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    slots = defaultdict(list)
    for r in placed.collect():
        slots[r["shard"]].append(r["slot"])
    assert sum(map(len, slots.values())) == 12_000 and all(sorted(s) == list(range(500)) for s in slots.values())
    # Read again by range: no partition of the numbering holds a hot key.
    [table] = [t for t in Folders(spark).names(scratch.root) if t.startswith("_number")]
    files = spark.read.parquet(f"{scratch.root}/{table}").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 6 and max(r["count"] for r in files) < 3500


def seat_by_seat(votes, seats):
    held = [0] * len(votes)
    for _ in range(seats if sum(votes) else 0):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
        held[best] += 1
    return held


@pytest.mark.parametrize("seed", range(5))
def test_quotas_equal_seat_by_seat(seed):
    rng = random.Random(seed)
    votes = [rng.choice((0, 1, 5, 5, rng.randrange(1, 10_000))) for _ in range(rng.randrange(1, 40))]
    for seats in (0, 1, 7, 200, 1500):
        assert mixing.apportion(votes, seats) == seat_by_seat(votes, seats)


def mixed(spark, documents, rows):
    docs = documents(*rows)
    sized = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), mixing.spare(F.col("text")).alias("_spare"))
    scratch = Scratch(spark)
    return mixing.take(scratch.keep(sized, "sizes"), scratch)


def test_targets_of_odd_sources(spark, documents):
    rows = [(i, "a b c d", None) for i in range(300)] + [(1000 + i, "e f g " * 5, "big") for i in range(900)]
    rows += [(5000 + i, "", "empty") for i in range(50)] + [(None, "null id words", "x"), (6000, None, "x")] + [(7, "tie tie", "x")] * 3
    found = mixed(spark, documents, rows).collect()
    assert len(found) == len(rows)
    by_source = defaultdict(list)
    for r in found:
        by_source[r["source"]].append(r)
    total = sum(r["size"] for r in found)
    # Names by code point, the missing one last: big 1, empty 2, x 3, none 1.
    sizes = {s: sum(r["size"] for r in of) for s, of in by_source.items()}
    aims = mixing.targets([sizes[s] for s in ("big", "empty", "x", None)], (1, 2, 3, 1))
    assert aims[1] == 0 and aims[2] == 3 * sizes["x"] and sum(aims) == pytest.approx(total)
    for source, aim in zip(("big", "empty", "x", None), aims):
        taken = sum(r["taken"] for r in by_source[source])
        assert abs(taken - aim) <= mixing.MAX_BLOCK and all(r["taken"] <= 3 * r["size"] for r in by_source[source])


def test_a_source_of_empty_texts_or_without_ids_is_split(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_ROWS", 100)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 100)
    rows = [(i, "", "empty") for i in range(3000)] + [(None, f"text number {i}", "unnamed") for i in range(3000)]
    found = mixed(spark, documents, rows)
    shards = Counter((r["_key"], r["_shard"]) for r in found.collect())
    assert max(shards.values()) < 400 and len(shards) > 60
