"""The pipeline, all stages in a row, against a brute-force version on odd tables, and on empty ones."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from rollmart.llm import near_dedup, packing

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string"


def tables(spark, folder, rows):
    full = [(i, text, None, source, 7, True, "mine") for i, text, source in rows]
    spark.createDataFrame(full, DOCUMENTS).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def odd_rows():
    rng = random.Random(4)

    def text(words=120):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) + ".\nA second line."

    rows = []
    for i in range(25):
        clean = text()
        near = clean.split(" ")
        near[rng.randrange(len(near) - 3)] = "changed"
        rows += [(10 * i, clean, "s"), (10 * i + 1, clean.upper(), "s"), (10 * i + 2, " ".join(near), "s")]
    rows += [(900, None, "s"), (901, "", "s"), (902, " \n\t ", "s"), (903, "too few words", "s"), (904, text(3000), "s")]
    rows += [(905, text(), "s")] * 3 + [(None, text(), "s"), (906, "say it again " * 40, "s")]
    return rows


def survivors(rows):
    """(doc_id, text) of what is to be packed: one source, so the mix takes each document once."""
    left = []
    for i, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        again = {w for w, n in Counter(windows).items() if n > 1}
        covered = {k + j for k, w in enumerate(windows) if w in again for j in range(8)}
        if len(words) >= 20 and 100 * len(covered) <= 30 * len(words):
            left.append((i, text))
    best = {}
    for i, text in left:
        key = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        if key not in best or (best[key][0] is None) or (i is not None and i > best[key][0]):
            best[key] = (i, text)
    left = list(best.values())
    counts = [near_dedup.shingle_counts(text.lower()) for _, text in left]
    root = list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            if near_dedup.similarity(counts[a], counts[b]) >= near_dedup.THRESHOLD:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    found = {}
    for r, (i, text) in zip(root, left):
        if r not in found or (i is not None and (found[r][0] is None or i < found[r][0])):
            found[r] = (i, text)
    return list(found.values())


def test_pipeline_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    rows = odd_rows()
    want = Counter()
    for i, text in survivors(rows):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        for start in range(0, len(ids), packing.WINDOW):
            part = ids[start : start + packing.WINDOW]
            want[i, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    got = corpus_pipeline.run(spark, tables(spark, tmp_path, rows)).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(filled) == list(range(len(filled))) and max(filled.values()) <= packing.WINDOW


def test_pipeline_on_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("rows", [[(None, None, None)] * 3, [(1, "", None), (1, "", None), (2, " ", "s")]])
def test_pipeline_with_nothing_to_keep(spark, tmp_path, rows):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, rows)).count() == 0


def test_all_but_the_last_stage_return_documents(spark, tmp_path):
    folder = tables(spark, tmp_path, odd_rows())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
