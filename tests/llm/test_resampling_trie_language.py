"""Importance resampling, the conversation trie and language identification: SQL, brute force, odd and empty input."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from rollmart.llm import importance_resampling as resampling
from rollmart.llm import language_id, prefix_trie
from rollmart.llm.queries import ORACLE, REGISTRY
from rollmart.sources.folders import Scratch

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_prefix_trie"])
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF), SF, REGISTRY[name], ORACLE[name]) is None


# Importance resampling


def brute_features(text, longest=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("text", ["", "One", "a b  c", "Ünï_cöde\tx9 \x1c ß-日本 語", "w " * 5000, "same same same"])
@pytest.mark.parametrize("longest", [1, 2, 3, 4])
def test_chained_seeds_are_the_crc_of_joined_words(text, longest):
    words, features = brute_features(text, longest)
    found = resampling.split(text)
    assert [w.decode() for w in found] == words
    assert resampling.features(found, longest) == Counter(zlib.crc32(f.encode()) for f in features)


def brute_draw(docs, target, share=25, least=20, buckets=100):
    def hashed(text):
        words, features = brute_features(text)
        return len(words), [zlib.crc32(f.encode()) % buckets for f in features]

    found = [(i, *hashed(text)) for i, text in docs]
    s, t = Counter(b for *_, bs in found for b in bs), Counter(b for text in target for b in hashed(text)[1])
    s_all, t_all = s.total() + buckets, t.total() + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * s_all / ((s[b] + 1.0) * t_all))) for b in range(buckets)}
    rows = []
    for i, n, bs in found:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    fit = sorted((r for r in rows if r[-1] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(fit[: share * len(fit) // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def test_draw_equals_brute_force_on_odd_rows(spark, documents):
    long = " ".join(f"w{i % 17} Ärger{i % 5}" for i in range(30_000))
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, "few words"), (4, long), (5, "x " * 40), (5, "x " * 40), (None, "y z " * 30),
            *((i, f"tie{i % 3} " * (18 + i % 5)) for i in range(10, 60))]
    target = ["w1 w2 Ärger3", None, "tie1 tie1"]
    got = resampling.draw(documents(*rows), spark.createDataFrame([(t,) for t in target], "text string"), Scratch(spark), buckets=100)
    got = Counter(tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert got == brute_draw(rows, target)


def test_drawn_documents_are_whole_and_lean_to_the_target(spark, documents, nothing):
    # Half speak like the target.
    rows = [(i, " ".join(f"{'aim' if i % 2 else 'other'}{(i * 7 + k) % 50}" for k in range(60))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(f"aim{(i * 7 + k) % 50}" for k in range(60)),) for i in range(300)], "text string")
    drawn = resampling.resample(documents(*rows), target).collect()
    assert len(drawn) == 100 and set(drawn[0].asDict()) >= {"doc_id", "text", "rule", "kept"}
    assert {(r["doc_id"], r["text"]) for r in drawn} <= set(rows)
    # One more thousandth of weight counts as much as one of noise: gains above 3,000 outweigh nearly all of it.
    assert sum(r["doc_id"] % 2 for r in drawn) > 90
    assert resampling.resample(nothing, target).count() == 0
    assert resampling.resample(documents(*rows), target.limit(0)).count() == 100


# Conversation trie


def brute_trie(sequences):
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(path[:-1] for path in members if path)

    def below(path):
        return [p for p in members if p[: len(path)] == path]

    return Counter(
        (
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path],
            sum(not children[p] for p in below(path)), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below(path) if p),
            sha256(",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(path)).encode()).hexdigest(),
        )
        for path, convs in members.items()
    )


def turns_of(sequences):
    return [(c, i, role, text) for c, turns in sequences.items() for i, (role, text) in enumerate(turns)]


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def shared_prefixes():
    """Conversations that branch at every depth, a third of them equal, one very long, one that another one continues."""
    some = {c: [("u", f"t{c % 2}"), ("a", f"é{c % 4}"), *[("u", "more")] * (c % 5), ("a", f"{c % 3}")][: c % 9] for c in range(40)}
    equal = {c: [("u", "hello"), ("a", "hi"), ("u", "bye")] for c in range(100, 120)}
    return {**some, **equal, 500: [("u", "x")] * 60, 501: [("u", "x")] * 61, 502: [("u", "x")] * 30 + [("a", "x")] * 9, -7: [("u", "t1")]}


@pytest.mark.parametrize("segment, block", [(512, 2048), (3, 7), (7, 3), (1, 5), (512, 1)])
def test_trie_equals_brute_force_whatever_the_segments_and_blocks(spark, shared_prefixes, segment, block):
    scratch = Scratch(spark)
    turns = spark.createDataFrame(turns_of(shared_prefixes), "conv_id long, turn long, role string, text string")
    rows = scratch.keep(prefix_trie.positions(turns, scratch), "positions")
    convs = spark.createDataFrame([(c, len(t)) for c, t in shared_prefixes.items()], "conv_id long, n_turns long")
    if segment == 1:  # a round for each turn: only the shorter ones
        rows, convs = rows.where("conv_id < 500"), convs.where("conv_id < 500")
        shared_prefixes = {c: t for c, t in shared_prefixes.items() if c < 500}
    got = prefix_trie.trie(rows, scratch.keep(convs, "convs"), scratch, segment, block)
    assert Counter(tuple(r) for r in got.select(*NAMES).collect()) == brute_trie(shared_prefixes)


def test_trie_of_odd_turns(spark):
    rows = [
        (None, 0, "u", "lost"), (1, None, None, None), (1, 0, "u", "a"), (2, 0, "", ""), (2, 1, "u", "a"), (3, 5, "u", "a" * 100_000),
        (3, 7, "u", "b"), (4, 1, "u", "same"), (4, 1, "u", "same"), (5, 0, "u:1", "x"), (6, 0, "u", "1x"),
    ]
    turns = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id int, turn int, role string, text string, depth int, key string")
    got = Counter(tuple(r) for r in prefix_trie.prefix_trie(turns).select(*NAMES).collect())
    assert got == brute_trie({
        1: [("", ""), ("u", "a")], 2: [("", ""), ("u", "a")], 3: [("u", "a" * 100_000), ("u", "b")], 4: [("u", "same")] * 2,
        5: [("u:1", "x")], 6: [("u", "1x")],
    })
    assert prefix_trie.rebuilt_trie(turns.limit(0)).count() == 0


def test_rebuilt_conversations(spark):
    given = {c: [("u", f"{c}-{i}") for i in range(c % 7)] for c in (*range(100, 130), *range(205, 230), 999)}
    given = {c: t for c, t in given.items() if t}

    def rebuilt(c):
        h = zlib.crc32(str(c).encode()) % 6
        return given.get(c - c % 100, [])[:h] + given[c][h:]

    turns = spark.createDataFrame(turns_of(given), "conv_id long, turn long, role string, text string")
    got = prefix_trie.rebuilt_trie(turns)
    want = {c: rebuilt(c) for c in given}
    assert any(not t for t in want.values())  # a member of the root alone
    assert Counter(tuple(r) for r in got.select(*NAMES).collect()) == brute_trie(want)


def test_extents_equal_a_scan():
    rng = np.random.default_rng(5)
    lcp = np.concatenate([[-1], rng.integers(0, 5, 200)])
    levels = prefix_trie.minima(lcp)
    at, depth = np.repeat(np.arange(201), 6), np.tile(np.arange(6), 201)
    left, right = prefix_trie.leftmost(levels, at, depth), prefix_trie.rightmost(levels, at, depth)
    for i, d, low, high in zip(at, depth, left, right):
        want_low = next((k for k in range(i, 0, -1) if lcp[k] < d), 0)
        want_high = next((k - 1 for k in range(i + 1, 201) if lcp[k] < d), 200)
        assert (low, high) == (want_low, want_high)
    assert list(prefix_trie.smallest(levels, left, right)) == [lcp[a : b + 1].min() for a, b in zip(left, right)]


# Language identification


def test_held_out_languages_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = REGISTRY["op13_language_id"](spark, sf).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["lang"] is not None]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def brute_model(rows):
    """Counts of the n-grams themselves, put into the library's buckets one at a time."""
    counts, texts = defaultdict(Counter), Counter()
    for text, lang in rows:
        plain = language_id.letters(text)
        texts[lang] += 1
        for n in range(1, 4):
            for i in range(len(plain) - n + 1):
                counts[lang][plain[i : i + n]] += 1
    return counts, texts


def test_model_and_scores_equal_brute_force(spark, documents):
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("the end", "en"), ("das ist gut", "de"), ("привет мир", "ru")]
    labelled = spark.createDataFrame(rows + [(None, "en"), ("no label", None), ("123 !?", "en")], "text string, lang string")
    model = language_id.learn(labelled)
    assert model.languages == ("de", "en", "ru")
    counts, texts = brute_model(rows)
    b = language_id.BUCKETS

    def bucket(gram):
        return int(np.flatnonzero(language_id.hashed(gram, b, len(gram)) - (language_id.hashed(gram, b, len(gram) - 1) if len(gram) > 1 else 0))[0])

    def posterior(text):
        plain, logs = language_id.letters(text), []
        for lang in model.languages:
            hashed = Counter()
            for gram, n in counts[lang].items():
                hashed[bucket(gram)] += n
            total = hashed.total() + language_id.SMOOTHING * b
            log = math.log(texts[lang] / texts.total())
            for n in range(1, 4):
                for i in range(len(plain) - n + 1):
                    log += math.log((hashed[bucket(plain[i : i + n])] + language_id.SMOOTHING) / total)
            logs.append(log)
        top = max(logs)
        return model.languages[logs.index(top)], 1 / sum(math.exp(x - top) for x in logs)

    asked = ["the dog", "Katze", "мир", "a", "und the"]
    got = {r["doc_id"]: r for r in language_id.predict(documents(*enumerate(asked)), model).collect()}
    for i, text in enumerate(asked):
        lang, score = posterior(text)
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score, abs=1e-4)


def test_stretches_and_held_languages_do_not_matter(spark, monkeypatch):
    text = language_id.letters("Stretches of a text, überall cut. " * 50)
    assert language_id.letters("12 ² 3rd_One") == " ² rd one " and language_id.letters("12 ² Ⅷ ½") == ""
    want = language_id.hashed(text)
    monkeypatch.setattr(language_id, "STRETCH", 7)
    assert (language_id.hashed(text) == want).all()
    assert want.sum() == sum(len(text) - n + 1 for n in (1, 2, 3))
    frames = __import__("pandas").DataFrame({"text": ["one", "zwei", "trois", "one"], "lang": ["en", "de", "fr", "en"]})
    monkeypatch.setattr(language_id, "LANGUAGES_HELD", 1)
    totals = Counter()
    for part in language_id._counted(64, 3)(iter([frames])):
        for r in part.itertuples():
            totals[r.lang, r.bucket] += r.n
    assert totals["en", -1] == 2 and totals["de", -1] == 1 and sum(n for (_, b), n in totals.items() if b >= 0) == 2 * 12 + 15 + 18


def test_languages_of_odd_rows(spark, odd, documents, nothing):
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.cross_checked(odd).collect()]
    assert len(got) == odd.count() and all(r[1:] == ("und", 0.0) for r in got)  # no labels
    rows = documents((None, "the end"), (1, None), (2, "  12 ²"), (3, "das Ende"), (3, "das Ende"), (4, "the end " * 40_000), (6, "the"))
    rows = rows.withColumn("lang", F.when(F.col("text").contains("the"), "en").when(F.col("text").contains("das"), "de"))
    got = language_id.cross_checked(rows).collect()
    assert len(got) == 7 and {r["lang_pred"] for r in got if r["doc_id"] in (1, 2)} == {"und"}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert language_id.cross_checked(nothing).count() == 0


def test_a_column_without_languages_is_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    rows = spark.createDataFrame([(f"text {'abcd'[i]}", f"l{i}") for i in range(4)], "text string, lang string")
    with pytest.raises(ValueError, match="distinct labels"):
        language_id.learn(rows)
