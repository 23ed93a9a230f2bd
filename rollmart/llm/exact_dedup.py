"""Exact dedup: skew-safe combining of equal texts.

Texts are equal when identical after lower-casing A-Z; NULL counts as empty. Each task first combines its own rows (the
partial aggregate), then groups are merged per digest and salt, then the winners of the salts per digest. The content is
a grouping key next to its digest in every stage, so texts are compared in full and a digest never decides alone; a text
that a third of all rows share sends one row per task and salt. The row with the largest ``doc_id`` stays (any id before
NULL); rows that repeat id and text stay once.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole

SALTS = 8
KEY = ("_digest", "_check")


def normalised(text: Column) -> Column:
    return F.translate(whole(text), ascii_uppercase, ascii_lowercase)


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_content", normalised(F.col("text"))).withColumns({
        # Never NULL, which the optimiser cannot know of sha2.
        "_digest": F.coalesce(F.sha2("_content", 256), F.lit("")),
        # A second, unrelated hash: rows find their group by both.
        "_check": F.xxhash64("_content"),
    })


def groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct text: its digests, the id that stays and the number of rows."""
    rows = _with_digest(docs.select("doc_id", "text")).withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    salted = rows.groupBy(*KEY, "_content", "_salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    merged = salted.groupBy(*KEY, "_content").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    return merged.drop("_content")


def membership(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept and text_sha256."""
    rows = _with_digest(docs.select("doc_id", "text")).drop("text", "_content")
    return rows.join(groups(docs), list(KEY)).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row of each text, with the columns of ``docs``.

    A text whose digests occur once is no copy of another one, so rows are moved to their digests once, and only those
    whose digests are repeated are compared by content: in the tasks, by digest and salt, and among the winners of the
    salts. The row that stays is named by its place in the scan, and no column but the text is looked at.
    """
    marked = docs.select(F.struct(*docs.columns).alias("_row"), "text", "doc_id", F.monotonically_increasing_id().alias("_place"))
    rows = _with_digest(marked).drop("text", "_content")
    counted = _with_digest(docs.select("text")).groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    again = counted.where("_n > 1").select(*KEY, F.lit(True).alias("_again"))
    # Both branches read the same exchange.
    flagged = rows.join(again, list(KEY), "left")
    copies = flagged.where(F.col("_again"))
    content = copies.select(
        *KEY, normalised(F.col("_row.text")).alias("_content"), F.struct("doc_id", "_place").alias("_best"),
        F.pmod(F.xxhash64("_place"), F.lit(salts)).alias("_salt"),
    )
    salted = content.groupBy(*KEY, "_content", "_salt").agg(F.max("_best").alias("_best"))
    winners = salted.groupBy(*KEY, "_content").agg(F.max("_best").alias("_best")).select(F.col("_best._place").alias("_place"))
    kept = copies.join(winners, "_place", "left_semi").select("_row.*")
    return flagged.where(F.col("_again").isNull()).select("_row.*").unionByName(kept)
