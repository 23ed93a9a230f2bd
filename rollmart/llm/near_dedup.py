"""MinHash near-dedup: BagMinHash signatures of word 5-shingle multisets, bands, exact verification, components.

Two texts are near copies if the multisets of their runs of five words (lower-cased; a text of one to four words is one
run) have a weighted Jaccard similarity, sum of minima by sum of maxima, of at least ``THRESHOLD``. Their classes are the
connected components; a document without a near copy is a class of its own.

1. Equal texts become one unit, numbered. A unit's signature holds, per register, the first of its points: every run of
   count c emits points of a Poisson process over the levels [0, c), laid out in dyadic blocks [0, 1), [1, 2), [2, 4) ...
   whose points carry a level each, so that blocks are shared by all counts above them and a point counts if its level
   lies below c. Points come in ascending order, and a run stops at the text's largest register.
2. Units that agree in all rows of a band share a bucket. Buckets are worked off in rounds: in each one a bucket compares
   one unit (another one every round) with those that are not in its component yet, so that a group of k copies costs
   about k comparisons. Links are verified on the whole texts, components are drawn up, and the next round begins. What
   the rounds leave is compared completely, between different components only and in blocks where buckets are large.

NULL and blank texts have no runs: equal ones are still one class, others are classes of their own. Repeated rows belong
to the class of their text. An empty table has no classes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..sources.folders import Scratch
from .common import WORD, release_worker_memory, shuffles_removed, whole, words

SHINGLE = 5
THRESHOLD = 0.8
# A pair at the threshold misses all bands with a chance of (1 - 0.8**5)**26 = 3e-5.
BANDS, ROWS = 26, 5
REGISTERS = BANDS * ROWS
# Pairs whose signatures agree in fewer registers are not verified: six standard deviations below the threshold.
LEAST_AGREEING = int(REGISTERS * THRESHOLD - 6 * (REGISTERS * THRESHOLD * (1 - THRESHOLD)) ** 0.5)
# Words whose texts are hashed together.
BATCH_WORDS = 300_000
ROUNDS = 4
# Buckets of up to LISTED units list their pairs at the end; larger ones are compared in blocks of about this many words.
LISTED, BLOCK_WORDS = 32, 400_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, SHINGLE + 1, dtype=np.uint64) * _GOLDEN


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted_shingles(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash of the run, count) of word hashes laid end to end, texts of the given lengths."""
    runs = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
    text = np.repeat(np.arange(len(lengths)), runs)
    begin = np.cumsum(lengths) - lengths
    at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + begin[text]
    end = (begin + lengths)[text]
    run = np.zeros(len(text), dtype=np.uint64)
    for k in range(SHINGLE):
        inside = at + k < end
        word = np.where(inside, tokens[np.minimum(at + k, max(len(tokens) - 1, 0))], np.uint64(0)) if len(tokens) else run
        run = _mix(run * np.uint64(31) + word + _STEPS[k])
    order = np.lexsort((run, text))
    text, run = text[order], run[order]
    first = np.ones(len(run), dtype=bool)
    first[1:] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(first)
    return text[starts], run[starts], np.diff(np.append(starts, len(run)))


def signatures(text: np.ndarray, run: np.ndarray, count: np.ndarray, texts: int) -> np.ndarray:
    """Register values (texts x REGISTERS) of weighted runs; 0 everywhere for a text without runs."""
    # Block b > 0 holds the levels from 2**(b - 1) up to 2**b, block 0 the level 0.
    blocks = np.frexp((count - 1).astype(float))[1] + 1
    owner = np.repeat(np.arange(len(run)), blocks)
    block = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0)
    width = np.maximum(low, 1).astype(np.uint64)
    seed = _mix(run[owner] + (block.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    rate = width.astype(float) * REGISTERS
    doc, limit = text[owner], (count[owner] - low).astype(np.uint64)

    best = np.full(texts * REGISTERS, np.inf)
    value = np.zeros(texts * REGISTERS, dtype=np.uint64)
    x = np.zeros(len(owner))
    active, step = np.arange(len(owner)), 0
    while len(active):
        # A few points at once when few processes are left.
        ahead = int(np.clip(50_000 // len(active), 1, 64))
        points = _mix(seed[active][:, None] + np.arange(step + 1, step + ahead + 1, dtype=np.uint64) * _GOLDEN)
        step += ahead
        other = _mix(points ^ _GOLDEN)
        gaps = -np.log(((points >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
        when = x[active][:, None] + np.cumsum(gaps, axis=1) / rate[active][:, None]
        register = (other >> np.uint64(32)) % np.uint64(REGISTERS)
        level = (other & np.uint64(0xFFFFFFFF)) % width[active][:, None]
        place = doc[active][:, None] * REGISTERS + register.astype(np.int64)
        hit = (level < limit[active][:, None]) & (when < best[place])
        place, moment, name = place[hit], when[hit], points[hit]
        order = np.argsort(-moment, kind="stable")  # the earliest is written last
        best[place[order]], value[place[order]] = moment[order], name[order]
        x[active] = when[:, -1]
        slowest = best.reshape(texts, REGISTERS).max(axis=1)
        active = active[x[active] < slowest[doc[active]]]
    return value.reshape(texts, REGISTERS)


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bands and 16 bits of every register, for rows of key, doc_id and word hashes."""
    release_worker_memory()
    for batch in batches:
        sizes = batch["hashes"].map(len).to_numpy()
        group = np.cumsum(sizes) // BATCH_WORDS
        for _, rows in batch.groupby(group, sort=False):
            lengths = rows["hashes"].map(len).to_numpy()
            tokens = np.concatenate([np.asarray(h, dtype=np.int64) for h in rows["hashes"]]).view(np.uint64)
            found = signatures(*weighted_shingles(tokens, lengths), len(rows))
            keys = np.zeros((len(rows), BANDS), dtype=np.uint64)
            for row in range(ROWS):
                keys = _mix(keys * np.uint64(31) + found[:, row::ROWS] + _GOLDEN)
            keys = _mix(keys + np.arange(BANDS, dtype=np.uint64) * _GOLDEN).view(np.int64)
            short = (found >> np.uint64(48)).astype("<u2")
            yield pd.DataFrame({
                "text_key": rows["text_key"], "doc_id": rows["doc_id"].astype("Int64"),
                "bands": [k if n else k[:0] for k, n in zip(keys, lengths)],
                "registers": [s.tobytes() for s in short],
            })


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the digest that stands for equal texts."""
    text = whole(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("text_key"), text.alias("text"))


def text_key(text: Column) -> Column:
    """The SHA-256 that stands for a text."""
    return F.unhex(F.sha2(text, 256))


def word_hashes(text: Column) -> Column:
    """A hash of every word of a lower-cased text, in order."""
    return F.transform(words(text), lambda word: F.xxhash64(word))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def units(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per distinct text: unit (a number), text_key, doc_id (the smallest), bands, registers."""
    hashed = keyed(docs).select(
        "text_key", "doc_id", word_hashes(F.lower("text")).alias("hashes")
    )
    schema = "text_key binary, doc_id long, bands array<long>, registers binary"
    described = scratch.keep(hashed.mapInPandas(_describe, schema), "signatures")
    # Equal texts have equal signatures: any of them will do.
    distinct = described.groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("registers").alias("registers")
    )
    return number_rows(scratch.keep(distinct, "texts"), [F.col("text_key")], "unit", scratch)


def _agreeing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose signatures agree in enough registers."""
    for batch in batches:
        if not len(batch):
            continue
        sides = [np.frombuffer(b"".join(batch[c]), dtype="<u2").reshape(len(batch), REGISTERS) for c in ("ra", "rb")]
        alike = (sides[0] == sides[1]).sum(axis=1) >= LEAST_AGREEING
        yield batch.loc[alike, ["a", "b"]]


def shingle_counts(text: str) -> Counter:
    """The multiset of runs of a lower-cased text."""
    tokens = re.findall(WORD, text)
    if len(tokens) < SHINGLE:
        return Counter([tuple(tokens)] if tokens else [])
    return Counter(zip(*(tokens[k:] for k in range(SHINGLE))))


def similarity(one: Counter, other: Counter) -> float:
    """Sum of the smaller counts by sum of the larger ones; 0 if there are none."""
    if len(one) > len(other):
        one, other = other, one
    common = sum(min(n, other[run]) for run, n in one.items() if run in other)
    total = one.total() + other.total() - common
    return common / total if total else 0.0


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of texts that are similar enough."""
    release_worker_memory()
    last, counts = None, Counter()
    for batch in batches:
        links = []
        for a, b, text_a, text_b in batch[["a", "b", "text_a", "text_b"]].itertuples(index=False):
            if a != last:  # pairs arrive sorted by their first text
                last, counts = a, shingle_counts(text_a)
            if similarity(counts, shingle_counts(text_b)) >= THRESHOLD:
                links.append((a, b))
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _compare_block(rows: pd.DataFrame) -> pd.DataFrame:
    """For every asking text a link to each component that holds a near copy of it in this block, by the hashes of the
    runs; links are verified on the texts afterwards."""
    release_worker_memory()
    asks, units, roots = rows["asks"].to_numpy(), rows["unit"].to_numpy(), rows["root"].to_numpy()

    def runs_of(of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [np.asarray(h, dtype=np.int64) for h in rows["hashes"].to_numpy()[of]]
        tokens = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        return weighted_shingles(tokens.view(np.uint64), np.array([len(p) for p in parts], dtype=np.int64))

    members, asking = np.flatnonzero(~asks), np.flatnonzero(asks)
    owner, runs, times = runs_of(members)
    totals = np.bincount(owner, times, len(members))
    questioner, asked, weights = runs_of(asking)
    borders = np.searchsorted(questioner, np.arange(len(asking) + 1))
    links = []
    for q, start, end in zip(asking, borders, borders[1:]):
        keys, weight = asked[start:end], weights[start:end]
        if not len(keys) or not len(runs):
            continue
        place = np.minimum(np.searchsorted(keys, runs), len(keys) - 1)
        shared = np.where(keys[place] == runs, np.minimum(weight[place], times), 0)
        common = np.bincount(owner, shared, len(members))
        near = common >= THRESHOLD * (totals + weight.sum() - common) - 1e-9
        for root in set(roots[members[near]]) - {roots[q]}:
            other = units[members[near & (roots[members] == root)]].min()
            links.append((min(units[q], other), max(units[q], other)))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(unit, root) for every end of an edge; root is the smallest unit of the component.

    Alternates between hanging all neighbours of a unit that are larger than it, and all that are smaller, on the smallest
    neighbour, until no edge moves: then every unit hangs on its root.
    """
    edges = scratch.keep(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    moved = 1
    while moved:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") != F.col("u")).alias("moved"))
        large = large.where("u <> v").groupBy("u", "v").agg(F.max("moved").alias("moved"))
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.max("moved").alias("_m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("moved"))
        after = small.union(least.select("u", F.col("m").alias("v"), "_m")).groupBy("u", "v").agg(F.max("moved").alias("moved"))
        seen = Observation()
        edges = scratch.keep(after.observe(seen, F.count_if("moved").alias("n")), "edges").select("u", "v")
        moved = seen.get["n"]
    return edges.select(F.col("u").alias("unit"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("unit"), F.col("v").alias("root")).distinct()
    )


class Links:
    """The search for links among units, round by round; what only one round needs is removed at its end."""

    def __init__(self, docs: DataFrame, found: DataFrame, scratch: Scratch):
        self.units, self.scratch = found, scratch
        exploded = found.select("unit", F.explode("bands").alias("bucket"))
        shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
        self.buckets = scratch.keep(exploded.join(shared, "bucket"), "buckets")
        candidates = self.buckets.select("unit").distinct().join(found.drop("bands"), "unit")
        # Of each distinct text one row, and only texts that share a bucket.
        texts = keyed(docs).join(
            candidates.select("unit", "registers", "text_key", F.col("doc_id").alias("_doc")), "text_key"
        ).where(F.col("doc_id").eqNullSafe(F.col("_doc")))
        self.texts = scratch.keep(
            texts.select("unit", "registers", F.lower("text").alias("text")).dropDuplicates(["unit"]), "candidates"
        )
        # (unit, root) of every unit that has a link; the root is the smallest unit of its component.
        self.roots = found.sparkSession.createDataFrame([], "unit long, root long")

    def verify(self, pairs: DataFrame, passing: Scratch) -> DataFrame:
        """The pairs (a, b) that are near copies."""
        one = self.texts.select(F.col("unit").alias("a"), F.col("registers").alias("ra"))
        other = self.texts.select(F.col("unit").alias("b"), F.col("registers").alias("rb"))
        likely = pairs.join(one, "a").join(other, "b").select("a", "b", "ra", "rb").mapInPandas(_agreeing, "a long, b long")
        likely = passing.keep(likely, "likely")
        one = self.texts.select(F.col("unit").alias("a"), F.col("text").alias("text_a"))
        other = self.texts.select(F.col("unit").alias("b"), F.col("text").alias("text_b"))
        joined = likely.join(one, "a").join(other, "b").sortWithinPartitions("a")
        return joined.select("a", "b", "text_a", "text_b").mapInPandas(_verified, "a long, b long")

    def open_buckets(self) -> DataFrame:
        """bucket, unit and root of buckets that still hold several components."""
        rooted = self.buckets.join(self.roots, "unit", "left").withColumn("root", F.coalesce("root", "unit"))
        several = rooted.groupBy("bucket").agg(F.min("root").alias("_least"), F.max("root").alias("_most"))
        return rooted.join(several.where("_least < _most").select("bucket"), "bucket")

    def add(self, pairs: DataFrame) -> int:
        """Verifies pairs and takes the links in; how many there were."""
        with Scratch(self.scratch.spark) as passing:
            new, n = passing.keep_counted(self.verify(pairs, passing), "new")
            if n:
                self.roots = self.scratch.keep(self._merged(new, passing), "roots")
        return n

    def _merged(self, new: DataFrame, passing: Scratch) -> DataFrame:
        """The roots after new links, which are drawn between the components that there are."""
        for side in ("a", "b"):
            known = self.roots.select(F.col("unit").alias(side), F.col("root").alias("_root"))
            new = new.join(known, side, "left").withColumn(side, F.coalesce("_root", side)).drop("_root")
        moved = passing.keep(components(new, passing), "moved")
        onward = moved.select(F.col("unit").alias("root"), F.col("root").alias("_onward"))
        kept = self.roots.join(onward, "root", "left").select("unit", F.coalesce("_onward", "root").alias("root"))
        return kept.unionByName(moved.join(self.roots, "unit", "left_anti"))

    def search(self) -> None:
        for turn in range(ROUNDS):
            with Scratch(self.scratch.spark) as passing:
                still = passing.keep(self.open_buckets(), "open")
                # Another unit of the bucket each time, the same one in all buckets that hold it.
                place = F.struct(F.xxhash64(F.lit(turn), "unit").alias("h"), "unit", "root")
                heads = still.groupBy("bucket").agg(F.min(place).alias("head"))
                pairs = still.join(heads, "bucket").where("root <> head.root").select(
                    F.least("unit", "head.unit").alias("a"), F.greatest("unit", "head.unit").alias("b")
                ).distinct()
                if not self.add(pairs):
                    break
        with Scratch(self.scratch.spark) as passing:
            self._finish(passing.keep(self.open_buckets(), "open"))

    def _finish(self, still: DataFrame) -> None:
        """Compares whatever the rounds have left, completely: everything outside a bucket's largest component with
        everything in the bucket. Small buckets list their pairs, the others are compared in blocks within a task."""
        still = still.join(self.texts.select("unit", word_count(F.col("text")).alias("words")), "unit")
        sizes = still.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).groupBy("bucket").agg(
            F.sum("n").alias("_all"), F.sum("words").alias("_words"), F.max(F.struct("n", "root", "words")).alias("_main")
        )
        sized = still.join(sizes.select("bucket", "_all", "_words", F.col("_main.words").alias("_held"), F.col("_main.root").alias("_main")), "bucket")
        few = sized.where(F.col("_all") <= LISTED).select("bucket", "unit", "root")
        other = few.select("bucket", F.col("unit").alias("b"), F.col("root").alias("_root"))
        rest = few.join(other, "bucket").where("unit < b AND root <> _root").select(F.col("unit").alias("a"), "b")

        def parts(n):
            return F.greatest(F.ceil(n / BLOCK_WORDS), F.lit(1)).cast("int")

        def dealt(n):
            return F.pmod(F.xxhash64("unit"), n).cast("int")

        many = sized.where(F.col("_all") > LISTED).withColumn("_asked", F.col("_words") - F.col("_held"))
        blocks, chunks = parts(F.col("_words")), parts(F.col("_asked"))
        everything = many.select(
            "bucket", "unit", "root", F.lit(False).alias("asks"), dealt(blocks).alias("block"),
            F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"),
        )
        asking = many.where("root <> _main").select(
            "bucket", "unit", "root", F.lit(True).alias("asks"),
            F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), dealt(chunks).alias("chunk"),
        )
        hashes = self.texts.select("unit", word_hashes(F.col("text")).alias("hashes"))
        rows = everything.union(asking).join(hashes, "unit")
        found = rows.groupBy("bucket", "block", "chunk").applyInPandas(_compare_block, "a long, b long")
        self.add(rest.union(found).distinct())


def unit_classes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """text_key, root (a number for the class) and class_id (the smallest doc_id of it) of every distinct text."""
    with shuffles_removed(docs.sparkSession):
        found = units(docs, scratch)
        search = Links(docs, found, scratch)
        search.search()
        rooted = found.select("unit", "text_key", "doc_id").join(search.roots, "unit", "left").select(
            "text_key", "doc_id", F.coalesce("root", "unit").alias("root")
        )
        least = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
        return scratch.keep(rooted.join(least, "root").select("text_key", "root", "class_id"), "classes")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and kept (the document with the smallest id of its class) of every row."""
    found = unit_classes(docs, Scratch(docs.sparkSession))
    return keyed(docs).drop("text").join(found, "text_key").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest id, with the columns of ``docs``."""
    found = unit_classes(docs, Scratch(docs.sparkSession))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_key(whole(F.col("text"))).alias("text_key"))
    same = [rows["text_key"] == found["text_key"], rows["doc_id"].eqNullSafe(found["class_id"])]
    # Two texts of a class may carry the same id, and a row may be repeated: one of them stays.
    return rows.join(found, same).dropDuplicates(["root"]).select("_row.*")
