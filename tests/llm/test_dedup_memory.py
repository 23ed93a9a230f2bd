"""Exact dedup by place, near dedup's blocks and components: brute force, odd rows and memory."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from rollmart.llm import common, exact_dedup, near_dedup
from rollmart.sources.folders import Scratch


def test_one_row_of_each_text_stays(spark, documents, nothing):
    rng = random.Random(3)
    rows = [(i, f"Text {rng.randrange(40)}") for i in range(200)] + [(i, "HOT copy") for i in range(300, 420)]
    rows += [(None, "hot COPY"), (419, "hot copy"), (None, "alone"), (None, None), (7, ""), (7, ""), (None, "twice"), (None, "twice")]
    got = exact_dedup.drop_copies(documents(*rows), salts=3)
    assert got.columns == documents(*rows[:1]).columns
    want = {}
    for i, text in rows:
        key = (text or "").lower()
        want[key] = max(want.get(key, -1), -1 if i is None else i)
    found = [(r["doc_id"], (r["text"] or "").lower()) for r in got.collect()]
    assert sorted((-1 if i is None else i, t) for i, t in found) == sorted((i, t) for t, i in want.items())
    assert exact_dedup.drop_copies(nothing).count() == 0


def block(texts, asks, roots):
    hashes = [np.array([hash(w) for w in t.split()], dtype=np.int64) for t in texts]
    return pd.DataFrame({"bucket": 0, "unit": range(len(texts)), "root": roots, "asks": asks, "hashes": hashes})


def test_block_links_equal_brute_force():
    rng = random.Random(5)
    base = [[f"w{rng.randrange(300)}" for _ in range(60)] for _ in range(8)]
    texts = []
    for _ in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 1, 2, 9))):
            words[rng.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    texts += ["", "one two", "one two", "a a a a a a a a", "a a a a a a a a a"]
    n = len(texts)
    rows = pd.concat([block(texts, True, range(n)), block(texts, False, range(n))], ignore_index=True)
    found = {tuple(r) for r in near_dedup._compare_block(rows).itertuples(index=False)}
    counts = [near_dedup.shingle_counts(t) for t in texts]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if near_dedup.similarity(counts[i], counts[j]) >= near_dedup.THRESHOLD}
    assert found == want


def test_a_block_of_long_texts_stays_small():
    rng = np.random.default_rng(1)
    words = 20_000
    texts = near_dedup.BLOCK_WORDS // words
    hashes = [rng.integers(-(2**62), 2**62, words) for _ in range(2 * texts)]
    rows = pd.DataFrame({"bucket": 0, "unit": range(2 * texts), "root": range(2 * texts), "asks": [i % 2 == 0 for i in range(2 * texts)], "hashes": hashes})
    tracemalloc.start()
    near_dedup._compare_block(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_workers_give_back_what_other_operators_kept():
    common.worker_memory()["something"] = "large"
    list(near_dedup._verified(iter([])))
    assert not common.worker_memory()


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {u: u for e in edges for u in e}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = near_dedup.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()
    linked = {u for a, b in edges if a != b for u in (a, b)}
    assert {r["unit"]: r["root"] for r in found} == {u: find(u) for u in linked} and len(found) == len(linked)


def test_long_copies_in_a_large_bucket_are_linked(spark, documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_WORDS", 3000)
    rng = random.Random(9)
    base = [f"word{rng.randrange(5000)}" for _ in range(1200)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.choice((2, 30, 60))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    counts = [near_dedup.shingle_counts(t) for _, t in rows]
    root = list(range(60))
    for i in range(60):
        for j in range(i):
            if near_dedup.similarity(counts[i], counts[j]) >= near_dedup.THRESHOLD:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(*rows)).collect()}
    assert got == dict(enumerate(root))
