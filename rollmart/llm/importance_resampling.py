"""Target-distribution importance resampling: hashed n-gram features, bucket gains, a Gumbel draw without replacement.

Words are found on the UTF-8 bytes: one 256-byte table lower-cases A-Z and blanks every separator, ``bytes.split`` cuts,
and an n-gram's CRC-32 is the seed that the CRC of a blank and the next word continues, so no n-gram is ever joined.
A document's features are a Counter of these; it is kept as the sorted 16-bit buckets, repeats included, so the text is
read and hashed once. Counters of the tasks are summed per bucket: at most ``BUCKETS`` rows for each side, which is all
that comes to the driver. What a document weighs then is the floored mean of its features' gains, and the ``share`` of the
documents with the highest weight plus Gumbel noise is drawn. The noise depends on the seed and ``doc_id`` only. The
order is found by range partitions; ties go to the smaller ``doc_id``, then to the earlier place.

NULL and empty texts have no features: weight 0, never drawn. Rows without ``doc_id`` have the noise of an empty id and
come last among ties. Repeated rows are documents of their own. An empty table gives no rows; without target texts all
gains follow from the smoothing. Columns besides ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..sources.folders import Scratch
from .common import whole

LONGEST = 2
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 25
SEED = 7
PLACE = "_place"

# Digits, letters of ASCII and every byte of a longer UTF-8 sequence stay; all else separates.
_STAYS = {*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)}
TRANSLATED = bytes(b if b in _STAYS else 0x20 for b in bytes(range(0x100)).lower())


def split(text: str) -> list[bytes]:
    # A lone surrogate cannot come out of Spark's UTF-8, but may be passed in by hand.
    return text.encode("utf-8", "replace").translate(TRANSLATED).split()


def features(words: list[bytes], longest: int = LONGEST) -> Counter:
    """CRC-32 of every run of 1 to ``longest`` words, joined by one space, and how often it occurs."""
    seeds = list(map(crc32, words))
    counts = Counter(seeds)
    following = [b" " + word for word in words]
    for n in range(1, longest):
        # The run that begins at a word goes on with the word n places behind it; the last n runs end with the text.
        seeds = list(map(crc32, following[n:], seeds))
        counts.update(seeds)
    return counts


def _bucketed(buckets: int, longest: int):
    if buckets > 1 << 16:
        raise ValueError("buckets are kept in 16 bits")

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n_words, n_features, found = [], [], []
            for text in batch["text"]:
                words = split(text)
                counts = features(words, longest)
                crcs = np.fromiter(counts.keys(), dtype=np.uint32, count=len(counts))
                times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                each = np.sort(np.repeat((crcs % np.uint32(buckets)).astype("<u2"), times))
                n_words.append(len(words))
                n_features.append(len(each))
                found.append(each.tobytes())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), PLACE: batch[PLACE], "n_words": np.array(n_words, dtype=np.int64),
                "n_features": np.array(n_features, dtype=np.int64), "buckets": found,
            })

    return describe


def described(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """doc_id, place, n_words, n_features and the sorted buckets of all features, as little-endian 16-bit numbers.

    ``place`` tells rows apart: the column of that name if there is one, otherwise a number that is fixed once the result
    is written.
    """
    place = F.col(PLACE) if PLACE in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), place.alias(PLACE), whole(F.col("text")).alias("text"))
    return rows.mapInPandas(
        _bucketed(buckets, longest), f"doc_id long, {PLACE} long, n_words long, n_features long, buckets binary"
    )


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One Counter per task."""
    counts: Counter = Counter()
    for batch in batches:
        for each in batch["buckets"]:
            found, times = np.unique(np.frombuffer(each, dtype="<u2"), return_counts=True)
            counts.update(dict(zip(found.tolist(), times.tolist())))
    yield pd.DataFrame(list(counts.items()), columns=["bucket", "n"], dtype="int64")


def bucket_counts(rows: DataFrame) -> dict[int, int]:
    """How many features of all described rows fall into each bucket; at most one row per bucket comes to the driver."""
    tallied = rows.select("buckets").mapInPandas(_tally, "bucket long, n long")
    return {r["bucket"]: r["n"] for r in tallied.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the logarithm of target by corpus share of every bucket, one added to each count."""
    s_all, t_all = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([
        math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((corpus.get(b, 0) + 1.0) * t_all)))
        for b in range(buckets)
    ], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variate that the seed and the id decide."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """Described rows with ``weight`` and ``score`` instead of the buckets."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = (np.frombuffer(each, dtype="<u2") for each in batch["buckets"])
            weight = [int(gain[each].sum()) // len(each) if len(each) else 0 for each in found]
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            yield pd.DataFrame({
                "doc_id": pd.array(ids, dtype="Int64"), "n_words": batch["n_words"], "n_features": batch["n_features"],
                PLACE: batch[PLACE], "weight": weight, "score": [w + noise(i, seed) for w, i in zip(weight, ids)],
            })

    return rows.mapInPandas(
        score, f"doc_id long, n_words long, n_features long, {PLACE} long, weight long, score long"
    )


def draw(
    docs: DataFrame, target: DataFrame, scratch: Scratch, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED,
    buckets: int = BUCKETS, longest: int = LONGEST,
) -> DataFrame:
    """Per document doc_id, place, n_words, n_features, weight, score and rank: 1, 2, 3 ... of the ``share`` percent drawn among
    the documents with ``least_words`` words, NULL for all others. ``target`` has ``text``."""
    aim = described(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, longest)
    rows = scratch.keep(described(docs, buckets, longest), "features")
    judged = scratch.keep(scored(rows, gains(bucket_counts(rows), bucket_counts(aim), buckets), seed), "scores")
    fit = judged.where(F.col("n_words") >= least_words)
    quota = share * fit.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc(PLACE)]
    numbered = number_rows(fit, order, "_number", scratch)
    ranked = numbered.withColumn("rank", F.when(F.col("_number") <= quota, F.col("_number"))).drop("_number")
    return ranked.unionByName(judged.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch | None = None, **how) -> DataFrame:
    """The documents drawn, whole, with the columns of ``docs``; of rows that repeat an id as many as were drawn."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", F.monotonically_increasing_id().alias(PLACE))
    rows = scratch.keep(rows, "documents")
    drawn = draw(rows, target, scratch, **how).where("rank IS NOT NULL").select(PLACE)
    return rows.join(drawn, PLACE, "left_semi").select("_row.*")
