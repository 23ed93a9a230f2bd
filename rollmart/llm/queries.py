"""The registered queries of the operators, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folders import Scratch
from . import (
    chat_format, exact_dedup, html_extraction, importance_resampling, language_id, mixing, near_dedup, packing,
    pii_surrogates, prefix_trie, quality_rules, secret_scan, sharding,
)
from .common import table

SHARDS = 24


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learned_from(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).drop("text")


def op2_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(sharding.digests(table(spark, sf_dir, "documents")), SHARDS, Scratch(spark))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.KINDS
    ]
    return found.select(
        "doc_id", *counts[:3], F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"),
        secret_scan.listed("spans").alias("spans"), counts[3],
    )


def op4_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")), Scratch(spark))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_preferences(chat_format.swapped_replies(table(spark, sf_dir, "conversations")))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    sized = scratch.keep(docs.select(
        "doc_id", "source", mixing.n_words(F.col("text")).alias("size"), mixing.spare(F.col("text")).alias("_spare")
    ), "sizes")
    return mixing.take(sized, scratch).select("doc_id", "size", "source_size", "target", "taken", "source")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.membership(table(spark, sf_dir, "documents"))


def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.cross_checked(table(spark, sf_dir, "documents"))


REGISTRY = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_ring_sharding, op3_secret_scan, op4_min_slack_packing, op5_preference_format,
        op6_pii_surrogates, op7_source_mixing, op8_exact_dedup, op9_bagminhash, op10_html_extraction,
        op11_importance_resampling, op12_prefix_trie, op13_language_id,
    )
}

# CRC-32 by its reversed polynomial, a table entry for each byte.
CRC_TABLE = """
    SELECT list(entry ORDER BY n) AS entries FROM (
        SELECT n, list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS entry
        FROM range(256) numbers(n))
"""

ORACLE = {
    "op8_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY t)
    """,
    "op11_importance_resampling": f"""
        WITH polynomial AS MATERIALIZED ({CRC_TABLE}),
        texts AS (
            SELECT 'd' AS side, row_number() OVER () AS place, doc_id, text FROM documents
            UNION ALL SELECT 'b', -row_number() OVER (), NULL, text FROM benchmark
        ), split AS MATERIALIZED (
            SELECT side, place, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM texts
        ), features AS MATERIALIZED (
            SELECT side, place, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature
            FROM split
        ), bytes AS (
            SELECT feature, list_transform(range(0, len(digits) // 2), lambda i: ('0x' || digits[2 * i + 1 : 2 * i + 2])::BIGINT) AS b
            FROM (SELECT feature, hex(encode(feature)) AS digits FROM (SELECT DISTINCT feature FROM features))
        ), hashed AS MATERIALIZED (
            SELECT feature, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM bytes, polynomial
        ), counted AS (
            SELECT bucket, count(*) FILTER (side = 'd')::DOUBLE AS s, count(*) FILTER (side = 'b')::DOUBLE AS t
            FROM features JOIN hashed USING (feature) GROUP BY bucket
        ), totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counted
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM counted, totals
        ), weights AS (
            SELECT place, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY place
        ), scored AS (
            SELECT place, doc_id, len(words) AS n_words, greatest(2 * len(words) - 1, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
            FROM split LEFT JOIN weights USING (place) WHERE side = 'd'
        ), ranked AS (
            SELECT place, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS eligible FROM scored WHERE n_words >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * eligible // 100 THEN rank END AS rank
        FROM scored LEFT JOIN ranked USING (place)
    """,
    "op12_prefix_trie": f"""
        WITH polynomial AS MATERIALIZED ({CRC_TABLE}), original AS MATERIALIZED (
            SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), keyed AS (
            SELECT conv_id, turns, conv_id - conv_id % 100 AS base, xor(list_reduce(
                [4294967295] || list_transform(split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
                lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])), 4294967295) % 6 AS h
            FROM original, polynomial
        ), rebuilt AS MATERIALIZED (
            SELECT k.conv_id, coalesce(b.turns, [])[1:k.h] || k.turns[k.h + 1:] AS turns FROM keyed k LEFT JOIN original b ON b.conv_id = k.base
        ), members AS (
            SELECT conv_id, len(turns) AS n, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt
        ), nodes AS MATERIALIZED (
            SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
            FROM members GROUP BY ALL
        ), children AS MATERIALIZED (
            SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
        ), described AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children,
                   CASE WHEN n.depth > 0 THEN (n_convs - 1) * length(n.path[n.depth].t) ELSE 0 END AS saved
            FROM nodes n LEFT JOIN children c ON n.path = c.path
        ), below AS (
            SELECT path[1:top] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS top FROM described) GROUP BY ALL
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
        FROM described n JOIN below b ON n.path = b.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
    """,
}
