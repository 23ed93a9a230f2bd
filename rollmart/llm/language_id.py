"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and cut into runs of letters, set apart by one blank each; its features are all runs of 1 to
``LONGEST`` of these characters, hashed into ``BUCKETS`` buckets. Counts per language and bucket come from all labelled
rows handed over, summed in the tasks first: a task holds ``LANGUAGES_HELD`` rows of counts at most and hands them on when
more are needed. The smoothed log-probabilities, one row per language, are broadcast. Scoring a batch gathers each text's
buckets and counts as a sparse row and multiplies the batch with the matrix in numpy; long texts are hashed a stretch at a
time. The predicted language is the one with the largest posterior, the smaller name among equals; the score is that
posterior.

The matrix is (languages x BUCKETS x 4 bytes); more than ``MOST_LANGUAGES`` distinct labels are refused with an error before
anything is broadcast, since such a column is no language column. NULL texts, and texts without a letter, are ``und`` with
score 0, and so is every text if nothing was learned. Rows without label, text, letters or ``doc_id`` teach nothing; a row
without ``doc_id`` is not held out. Repeated rows count as often as they occur. An empty table gives no rows. Columns
besides ``doc_id``, ``text`` and (for learning) ``lang`` are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole

LONGEST = 3
BUCKETS = 1 << 14
# Added to every count.
SMOOTHING = 0.1
LANGUAGES_HELD = 64
MOST_LANGUAGES = 1000
# Characters hashed at once.
STRETCH = 1 << 18
FOLDS = 5
UNKNOWN = "und"

# Digits and the underscore are word characters, too, and so are a few numeral signs, which letters() sorts out.
_RUNS = re.compile(r"[^\W\d_]+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str) -> str:
    """The lower-cased runs of letters, a blank before, between and behind them; empty if there is no letter."""
    runs = _RUNS.findall(text.lower())
    joined = " ".join(runs)
    return f" {joined} " if any(map(str.isalpha, joined)) else ""


def hashed(text: str, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many n-grams of ``letters`` fall into each bucket."""
    counts = np.zeros(buckets, dtype=np.int64)
    for start in range(0, len(text), STRETCH):
        # The n-grams that begin in this stretch.
        stretch = text[start : start + STRETCH + longest - 1]
        codes = np.frombuffer(stretch.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        begins = min(STRETCH, len(text) - start)
        run = np.zeros(len(codes), dtype=np.uint64)
        for n in range(min(longest, len(codes))):
            # run[i] stands for the n characters at i; it goes on with the next one.
            run = (run[: len(codes) - n] + codes[n:] + np.uint64(1)) * _GOLDEN
            run ^= run >> np.uint64(29)
            counts += np.bincount(((run[:begins] * _GOLDEN) >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)
    return counts


def _counted(buckets: int, longest: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}

        def hand_on() -> Iterator[pd.DataFrame]:
            for lang, counts in held.items():
                found = np.flatnonzero(counts)
                # Bucket -1 holds the number of texts.
                yield pd.DataFrame({
                    "lang": lang, "bucket": np.append(found, -1).astype(np.int32), "n": np.append(counts[found], texts[lang])
                })
            held.clear()
            texts.clear()

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                plain = letters(text)
                if not plain:
                    continue
                if lang not in held:
                    if len(held) == LANGUAGES_HELD:
                        yield from hand_on()
                    held[lang], texts[lang] = np.zeros(buckets, dtype=np.int64), 0
                held[lang] += hashed(plain, buckets, longest)
                texts[lang] += 1
        yield from hand_on()

    return count


@dataclass(frozen=True)
class Model:
    """Learned languages in order, logarithms of their shares, and of each bucket's probability in them."""

    languages: tuple[str, ...]
    priors: np.ndarray
    weights: np.ndarray  # buckets x languages
    longest: int = LONGEST

    def posteriors(self, texts: list[str]) -> np.ndarray:
        """Posterior of every language (columns) for texts that have letters."""
        buckets = len(self.weights)
        out = np.zeros((len(texts), len(self.languages)))
        for row, text in enumerate(texts):
            counts = hashed(text, buckets, self.longest)
            found = np.flatnonzero(counts)
            # The sparse row times the matrix.
            out[row] = counts[found].astype(np.float64) @ self.weights[found]
        out += self.priors
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def learn(labelled: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> Model:
    """The model of all rows of ``labelled`` (text and lang) that have both and a letter."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    counts = rows.mapInPandas(_counted(buckets, longest), "lang string, bucket int, n long")
    per_language = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.collect_list(F.struct("bucket", "n")).alias("counts")
    )
    # One row per language and at most one number per bucket in each of them.
    found = per_language.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct labels: {sorted(r['lang'] for r in found)[:5]} ...")
    found.sort(key=lambda r: r["lang"])
    weights = np.zeros((buckets, len(found)))
    priors = np.zeros(len(found))
    for column, row in enumerate(found):
        for bucket, n in row["counts"]:
            if bucket < 0:
                priors[column] = n
            else:
                weights[bucket, column] = n
    weights += SMOOTHING
    weights = np.log(weights / weights.sum(axis=0)) if len(found) else weights
    priors = np.log(priors / priors.sum()) if len(found) else priors
    return Model(tuple(r["lang"] for r in found), priors, weights.astype(np.float32), longest)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text and whatever else) reduced to doc_id, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            plain = [letters(text) for text in batch["text"]]
            asked = [i for i, text in enumerate(plain) if text and known.languages]
            names, best = [UNKNOWN] * len(plain), np.zeros(len(plain))
            if asked:
                chances = known.posteriors([plain[i] for i in asked])
                top = chances.argmax(axis=1)
                best[asked] = chances[np.arange(len(asked)), top]
                for i, place in zip(asked, top):
                    names[i] = known.languages[place]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": names, "score": best})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    return rows.mapInPandas(score, "doc_id long, lang_pred string, score double")


def fold(doc_id: str, folds: int = FOLDS) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; NULL without an id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def cross_checked(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out (fold 0), lang_pred and score of every row, learned from the other folds."""
    model = learn(docs.where(fold("doc_id", folds) != 0).select("text", "lang"))
    held_out = F.coalesce(fold("doc_id", folds) == 0, F.lit(False))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
