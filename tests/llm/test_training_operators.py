"""Every operator against a brute-force version on supplied or small tables, and on odd and empty input."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from html import unescape

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollmart.llm import (
    chat_format, exact_dedup, html_extraction, mixing, near_dedup, packing, pii_surrogates, quality_rules, secret_scan, sharding,
)
from rollmart.llm.queries import ORACLE, REGISTRY
from rollmart.sources.folders import Scratch

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# Quality rules


def brute_statistics(text):
    w = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    places = defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i : i + 8])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_statistics_equal_brute_force(spark, texts):
    rows = REGISTRY["op1_quality_rules"](spark, SF).collect()
    assert {r["doc_id"]: tuple(r)[1:7] for r in rows} == {i: brute_statistics(r["text"]) for i, r in texts.items()}
    assert len(rows) == len(texts) and all(r["kept"] == (not r["base_failed"] and r["rule"] == 0) for r in rows)


def test_decision_list_separates_held_out_labels(spark):
    judged = REGISTRY["op1_quality_rules"](spark, "/root/testdata/sf0.01").where("NOT base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    right = judged.join(labels, "doc_id").select((F.col("kept") == (F.col("quality") == 1)).alias("right")).collect()
    assert sum(r["right"] for r in right) >= 0.97 * len(right)


def test_quality_without_labels_and_on_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rules = quality_rules.learned_from(odd, labels)
    assert rules.rules == ()
    assert quality_rules.judge(odd, rules).where("base_failed").count() == odd.count()
    assert quality_rules.drop_low_quality(odd, labels).columns == odd.columns
    assert quality_rules.judge(nothing, rules).count() == 0


# Sharding


def test_shards_differ_by_one_row_and_slots_are_gapless(spark, texts):
    rows = REGISTRY["op2_ring_sharding"](spark, SF).collect()
    by_shard = defaultdict(list)
    for r in rows:
        text = texts[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "rows")
        by_shard[r["shard"]].append(r["slot"])
    sizes = [len(by_shard[s]) for s in range(24)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_ring_by_hand():
    points = sharding.ring(3, 4)
    counts = {0: 5, 1: 0, 2: 9, 7: 1}
    segments = sharding.settle({a: n for a, n in counts.items() if n}, [s for _, s in points], [5, 5, 5])
    assert sorted(Counter({s: 0 for s in range(3)} | Counter()).keys()) == [0, 1, 2]
    taken = Counter()
    for arc, start, end, shard, slot in segments:
        assert slot == taken[shard]
        taken[shard] += end - start
    assert sum(taken.values()) == 15 and max(taken.values()) == 5
    positions = [p for p, _ in points]
    for cell, low, high, arc in sharding.arcs_by_cell(points):
        expected = next((i for i, p in enumerate(positions) if p >= low), 0)
        assert arc == expected and (high - 1 <= positions[arc] or arc == 0)


def test_another_shard_moves_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    few, more = (sharding.assign(sharding.digests(docs), n, Scratch(spark)).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (24, 25))
    moved = few.join(more, "doc_id").where("s24 <> s25 AND s25 <> 24").count()
    assert moved < 0.15 * docs.count()


def test_sharding_odd_rows(spark, odd, nothing):
    assert sharding.assign(sharding.digests(odd), 3, Scratch(spark)).groupBy("shard").count().agg(F.sum("count")).first()[0] == odd.count()
    assert sharding.assign(sharding.digests(nothing), 3, Scratch(spark)).count() == 0


# Secrets


def brute_base(text):
    found = []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def test_base_secrets_equal_brute_force(spark, texts):
    rows = REGISTRY["op3_secret_scan"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_base(texts[r["doc_id"]]["text"])
        assert r["base_sha256"] == sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_inferred_format_finds_unlabelled_credentials(documents, nothing, odd):
    hexes = [sha256(str(i).encode()).hexdigest()[:40] for i in range(60)]
    rows = [(i, f"some plain words here token = {h} and more ordinary words follow") for i, h in enumerate(hexes)]
    rows += [(100, "the value " + sha256(b"x").hexdigest()[:40].upper() + " in capitals"), (101, "see mail7.example.com or version12.alpha.beta")]
    spans = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secret_scan.scan(documents(*rows)).collect()}
    assert spans[100] == ["format"] and spans[101] == [] and spans[0] == ["assign", "hex"]
    assert secret_scan.scan(nothing).count() == 0 and secret_scan.scan(odd).where("size(spans) > 0").count() == 0


def test_ordinary_words_of_all_documents_set_the_mark(documents):
    hexes = [sha256(str(i).encode()).hexdigest()[:40] for i in range(60)]
    rows = [(i, f"some plain words here token = {h} and more ordinary words follow") for i, h in enumerate(hexes)]
    rows += [(i, f"plain ordinary words number{'xyz'[i % 3]} again") for i in range(100, 800)]
    # Forms that only a row without an id has.
    rare = ["".join("abcdef0123456789"[int(c, 16)] for c in sha256(str(i).encode()).hexdigest()[:15]) for i in range(40)]
    docs = documents(*rows, (None, " ".join(rare)))

    def learned(docs):
        return secret_scan.learn(docs, secret_scan.scan(docs, secret_scan.Grammar(None, secret_scan.Ordinary({}))))

    some, every = learned(documents(*rows)), learned(docs)
    assert every.mark > some.mark
    # ordinary and follow, ordinary and number: words of six letters outside the credentials.
    frames = secret_scan._ordinary_words(iter([pd.DataFrame({"text": [text for _, text in rows]})]))
    assert sum(frame["n"].sum() for frame in frames) == 60 * 2 + 700 * 2
    scores = [every.score(secret_scan.form(word)) for word in rare]
    assert sum(score <= every.mark for score in scores) >= len(rare) / 3


# Packing


def test_pieces_and_places_equal_brute_force(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    rows = REGISTRY["op4_min_slack_packing"](spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, row in texts.items():
        ids = [*tokenizer.encode(row["text"], add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            part = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r["length"]])
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert sorted(sequences) == list(range(len(sequences)))
    assert len(sequences) <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


@pytest.mark.parametrize("text", ["a  b", "a\n\nb", " a", "a ", "a\n b", "x\x1cy z", "don't\n's", "<|endoftext|> a", "a b c", "a,\r\nb"])
def test_words_encode_like_whole_texts(text):
    encoder = packing.Encoder(packing.default_tokenizer())
    assert encoder.ids(text) == encoder._encode([text])[0]


def test_fullest_window_equals_search():
    counts = {7: 2, 5: 3, 3: 1}
    best = max(s for a in range(3) for b in range(4) for c in range(2) if (s := 7 * a + 5 * b + 3 * c) <= 23)
    taken = packing.fullest(counts, 23)
    assert sum(k * n for k, n in taken.items()) == best and all(n <= counts[k] for k, n in taken.items())


def test_packing_odd_rows(spark, odd, nothing):
    packed = packing.pack(packing.pieces(odd), Scratch(spark))
    assert packed.where("doc_tokens = 1").count() == 2 and packed.groupBy("doc_id", "start").count().where("count > 1").count() == 1
    assert packing.pack(packing.pieces(nothing), Scratch(spark)).count() == 0
    kept = packing.pack(packing.pieces(odd, with_ids=True), Scratch(spark))
    assert packing.sequences(kept).where("length(ids) <> 4 * n_tokens").count() == 0


# Preferences


def test_preferences(spark):
    turns = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame(
        [(1, [("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "b")]), (2, [("user", "q"), ("assistant", "a")], None),
         (3, [("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "a")]), (4, [], [])],
        f"pair_id long, chosen {turns}, rejected {turns}",
    )
    rows = {r["pair_id"]: r for r in chat_format.format_preferences(pairs).collect()}
    assert rows[1]["prompt"] == "<|user|>\nq<|end|>\n" and rows[1]["n_prompt_turns"] == 1
    for side, text in (("chosen", "a"), ("rejected", "b")):
        (span,) = rows[1][f"{side}_mask"]
        assert rows[1][side][span["start"] : span["end"]] == f"{text}<|end|>\n"
    assert rows[2]["rejected"] == "" and rows[2]["n_prompt_turns"] == 0
    assert rows[3]["n_prompt_turns"] == 1 and rows[4]["prompt"] == ""


def test_preference_query_covers_conversations(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert REGISTRY["op5_preference_format"](spark, SF).count() == table.select("conv_id").distinct().count()
    assert chat_format.format_preferences(chat_format.swapped_replies(table.limit(0))).count() == 0


# PII


def test_surrogates(documents, odd, nothing):
    rows = documents(
        (1, "Mail ann.lee42@mail7.example.com or call +1 (017) 555-7713, card 4929348385146306, host 97.51.17.173."),
        (2, "ann.lee42@mail7.example.com met Frau Anna Schmidt; bob@mail7.example.com"), (3, "version 4.0. of 2.0.1 has 12 parts"),
    )
    found = {r["doc_id"]: r for r in pii_surrogates.replace(rows).collect()}
    text = found[1]["text"]
    for secret in ("ann.lee42", "555-7713", "4929348385146306", "97.51.17.173"):
        assert secret not in text
    assert re.fullmatch(r"Mail \S+@\S+\.com or call \+1 \(\d{3}\) \d{3}-\d{4}, card \d{16}, host [\d.]+\.", text)
    address = re.search(r"\S+@\S+", text)[0]
    assert address in found[2]["text"] and "Schmidt" not in found[2]["text"] and "Frau " in found[2]["text"]
    assert len(set(re.findall(r"@(\S+)", found[2]["text"]))) == 1
    assert found[3]["text"] == "version 4.0. of 2.0.1 has 12 parts"
    assert pii_surrogates.replace(odd).where("text IS NULL").count() == 1 and pii_surrogates.replace(nothing).count() == 0


def test_colliding_surrogates_are_drawn_again(spark, monkeypatch):
    spans = "array<struct<kind:string,entity:string>>"
    found = spark.createDataFrame([([("card", f"{i:013d}") for i in range(40)],)], f"found {spans}")
    known = pii_surrogates.mapping(found, Scratch(spark)).collect()
    assert len({r["surrogate"] for r in known}) == len(known) == 40
    assert not {r["surrogate"] for r in known} & {r["entity"] for r in known}


def test_more_entities_than_their_form_has_surrogates(spark):
    spans = "array<struct<kind:string,entity:string>>"
    names = [("name", f"m/{script}/{chr(97 + i % 26)}{i}") for script, n in (("latin", 34_000), ("greek", 9_000)) for i in range(n)]
    hosts = [("ip", f"192.168.{i // 256}.{i % 256}") for i in range(33_000)]
    mails = [("email", f"{sign}@a.com") for sign in "abcdefghijklmnopqrstuvwxyz_%+-"]
    found = spark.createDataFrame([(names + hosts + mails,)], f"found {spans}")
    known = pii_surrogates.mapping(found, Scratch(spark)).collect()
    assert len(known) == len({(r["kind"], r["surrogate"]) for r in known}) == len(names + hosts + mails)
    assert not {r["surrogate"] for r in known} & {r["entity"] for r in known}


def test_names_are_replaced_whole_and_alike(documents):
    rows = documents(
        (1, "Mr John Smith came. Then Mr Smith left; later Smith and John Smith met J. Smith. SMITH's end."),
        (2, "Mr J. Smith, Mr Martin Luther King Jr. and Frau Dr. Anna von Schmidt-Öst. Then von Schmidt, King"),
        (3, "Mr Иван Петров and Frau O’Neill; Mr Jose\u0301 Pin\u0303a, Herr d'Angelo. Jos\u00e9"), (4, "John Smith without a title"),
        (5, "Mrs Smith. The Mrs. E. T. A. Black: Mr.\nBlack"),
    )
    found = {r["doc_id"]: r for r in pii_surrogates.replace(rows).collect()}
    text = {i: r["text"] for i, r in found.items()}
    first = re.fullmatch(r"Mr (\w+) (\w+) came\. Then Mr \2 left; later \2 and \1 \2 met (\w)\. \2\. (\w+)'s end\.", text[1])
    assert first and first[3] == first[1][0] and first[4] == first[2].upper() and found[1]["n_name"] == 6
    second = re.fullmatch(rf"Mr \w\. {first[2]}, Mr \w+ \w+ (\w+) Jr\. and Frau Dr\. \w+ von (\w+)-\w+\. Then von \2, \1", text[2])
    assert second and not set("Martin Luther King Anna Schmidt".split()) & set(re.findall(r"\w+", text[2]))
    assert found[2]["n_name"] == 5
    third = re.fullmatch(r"Mr ([А-я]+) ([А-я]+) and Frau (\w+); Mr (\w+) (\w+), Herr (\w+)\. \4", text[3])
    assert third and not {"Иван", "Петров"} & set(third.groups())
    assert text[4] == "John Smith without a title"
    assert re.fullmatch(rf"Mrs {first[2]}\. The Mrs\. [A-Z]\. [A-Z]\. [A-Z]\. (\w+): Mr\.\n\1", text[5])


def test_surrogates_widen_with_the_attempts():
    for kind, entity in (("card", "4929348385146306"), ("phone", "0175557713"), ("ip", "192.168.0.1"), ("ip", "8.8.8.8")):
        late = pii_surrogates.surrogate(kind, entity, 12)
        assert late != entity and (":" in late if kind == "ip" else len(late) > len(entity))
    assert pii_surrogates.laid_out("phone", "(017) 555-7713", "298765432101") == "(298) 765-432101"


# Mixing


def brute_apportion(votes, seats):
    held = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
        held[i] += 1
    return held


@pytest.mark.parametrize("votes, seats", [([53, 24, 23], 7), ([1, 1, 1], 2), ([10, 0, 3.5, 3.5], 101), ([5], 9), ([], 3), ([0, 0], 4)])
def test_apportionment(votes, seats):
    assert mixing.apportion(votes, seats) == (brute_apportion(votes, seats) if sum(votes) else [0] * len(votes))


def test_mix_meets_its_targets(spark):
    rows = REGISTRY["op7_source_mixing"](spark, SF).collect()
    sizes, taken, aims = Counter(), Counter(), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        aims[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s))
    assert [aims[n] for n in names] == pytest.approx(mixing.targets([sizes[n] for n in names], [1 + i % 3 for i in range(len(names))]))
    assert all(abs(taken[n] - aims[n]) <= 0.01 * aims[n] + 1 for n in names)
    again = REGISTRY["op7_source_mixing"](spark, SF).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixed_documents(documents, odd, nothing):
    docs = documents(*((i, f"a{i} b  c\nd e", "xyz"[i % 3]) for i in range(60)), (99, "one", None))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert abs(mixed.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] - 301) <= 3
    assert mixing.mixed_documents(nothing).count() == 0 and mixing.mixed_documents(odd).count() > 0


def test_mixed_documents_are_whole(documents, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 300)
    texts = {i: " ".join(f"w{i}x{k}" for k in range(3 + i * 7 % 90)) for i in range(400)}
    docs = documents(*((i, t, "xyz"[i % 3]) for i, t in texts.items()), (1000, "word " * 999, "long"))
    mixed = mixing.mixed_documents(docs).collect()
    assert all(r["text"] == texts.get(r["doc_id"], "word " * 999) for r in mixed)
    sizes, given = Counter(), Counter()
    for i, t in texts.items():
        sizes["xyz"[i % 3]] += len(t.split())
    sizes["long"] = 999
    for r in mixed:
        given[r["source"]] += len(r["text"].split())
    names = sorted(sizes)
    for name, aim in zip(names, mixing.targets([sizes[n] for n in names], [1, 2, 3, 1])):
        assert abs(given[name] - aim) <= (999 if name == "long" else 92) / 2 + 20


# Dedup


def test_exact_dedup_equals_sql(spark):
    from compare import connect, difference

    assert difference(spark, connect(SF), SF, REGISTRY["op8_exact_dedup"], ORACLE["op8_exact_dedup"]) is None


def test_copies_go(documents, odd, nothing):
    docs = documents((1, "Abc"), (2, "aBC"), (2, "aBC"), (3, "É"), (4, "é"), (None, None), (9, ""))
    kept = sorted(r["doc_id"] for r in exact_dedup.drop_copies(docs).collect())
    assert kept == [2, 3, 4, 9] and exact_dedup.drop_copies(docs).columns == docs.columns
    assert exact_dedup.drop_copies(odd).count() == 5 and exact_dedup.drop_copies(nothing).count() == 0


def test_near_copies_equal_brute_force(spark, texts):
    counts = {i: near_dedup.shingle_counts(r["text"].lower()) for i, r in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and (texts[a]["text"] == texts[b]["text"] or near_dedup.similarity(counts[a], counts[b]) >= 0.8):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    rows = REGISTRY["op9_bagminhash"](spark, SF).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == {i: root(i) for i in texts}


def test_large_group_without_a_common_centre(spark, documents, monkeypatch):
    """A chain: neighbours are near copies, the ends are not; blocks instead of listed pairs find the same classes."""
    base = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join([f"x{k}_{i}" if k * 6 - 6 <= i < k * 6 else w for i, w in enumerate(base)])) for k in range(40)]
    rows += [(k + 100, " ".join(["y"] * k + [f"z{k}_{j}" for j in range(300)])) for k in range(3)]
    monkeypatch.setattr(near_dedup, "LISTED", 2)
    found = near_dedup.classes(documents(*rows)).collect()
    classes = {r["doc_id"]: r["class_id"] for r in found}
    assert {classes[k] for k in range(40)} == {0} and [classes[k + 100] for k in range(3)] == [100, 101, 102]


def test_blocks_find_links_between_components():
    import pandas as pd

    text = " ".join(f"w{i}" for i in range(50))
    rows = pd.DataFrame({
        "bucket": 1, "unit": [1, 2, 3, 3], "root": [1, 1, 3, 3], "asks": [False, False, False, True],
        "hashes": [[hash(w) for w in t.split()] for t in (text, "other words " * 9, text + " more", text + " more")],
    })
    assert near_dedup._compare_block(rows).values.tolist() == [[1, 3]]


def test_near_dedup_odd_rows(odd, nothing):
    assert near_dedup.drop_near_copies(odd).count() == 5 and near_dedup.classes(nothing).count() == 0


def test_signatures_are_unbiased():
    import numpy as np

    rng = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        one = {int(k): int(c) for k, c in zip(rng.integers(1, 2**62, 40), rng.integers(1, 30, 40))}
        other = {k: max(1, c + int(rng.integers(-9, 9))) for k, c in one.items()}
        runs = [(t, k, c) for t, bag in enumerate((one, other)) for k, c in sorted(bag.items())]
        text, run, count = (np.array(c) for c in zip(*runs))
        s = near_dedup.signatures(text, run.astype(np.uint64), count, 2)
        errors.append((s[0] == s[1]).mean() - near_dedup.similarity(Counter(one), Counter(other)))
    assert abs(np.mean(errors)) < 0.02


# Pages


def test_supplied_pages_equal_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = REGISTRY["op10_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"</?(?:h1|p)>|<br>", article)]
        assert r["text"] == " ".join(filter(None, parts)) and r["n_chars"] == len(r["text"])


def test_other_layouts(spark):
    known = html_extraction.train(spark.read.parquet(f"{SF}/pages.parquet"))
    comments = "<p>Nice article, thanks a lot. It is long enough to look like the text of the page itself.</p>" * 40
    page = f"<body><header>Site</header><div class=wrap><aside>side</aside><article><p>One &amp; <i>t</i>wo<br>three<div class=ad><p>Buy</div><form>x</form><p>Four<section id=comments>{comments}</section></article></div><footer>c</footer>"
    assert html_extraction.main_text(page, known) == "One & two three Four"
    for broken in ("", "<", "<p", "<!-- x", "<script>a", "</p></div>", "&am", "<a href='x>y"):
        html_extraction.main_text(broken, known)
    empty = spark.createDataFrame([(1, "u", None), (1, "u", ""), (None, None, "<p")], "page_id long, url string, html string")
    assert [r["text"] for r in html_extraction.extract(empty, known).collect()] == ["", "", ""]
    assert html_extraction.extract(empty.limit(0)).count() == 0


def test_articles_in_wrappers_with_boilerplate_words(spark):
    learned = html_extraction.train(spark.read.parquet(f"{SF}/pages.parquet"))
    part = "<p>A long paragraph of the article that goes on, with many words, so that it looks like text of its own.</p>"
    text = "Head" + " A long paragraph of the article that goes on, with many words, so that it looks like text of its own." * 3
    nav, foot = "<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>", "<footer>Copyright</footer>"
    article, comments = f"<h1>Head</h1>{part * 3}", "<p>Nice article, thanks a lot. It is long enough to look like text.</p>" * 40
    pages = [
        f"<body><form id=aspnetForm>{nav}<div>{article}</div>{foot}</form>",
        f"<body><form>{nav}<article>{article}</article>{foot}</form>",
        f"<body>{nav}<div class='main no-sidebar'>{article}</div>{foot}",
        f"<body>{nav}<article class='post has-comments'>{article}<section id=comments>{comments}</section></article>{foot}",
        f"<main class='with-sidebar'>{article}</main><aside>{part}</aside>{foot}",
        f"<body>{nav}<div class=sidebar-layout><div>{article}</div><div class=sidebar>{part}</div></div>{foot}",
        f"<body>{nav}<article class=sponsored>{article}</article>{foot}",
        f"<body>{nav}<div class='main sidebar'>{article}</div>{foot}",
        f"<body>{nav}<article>{article}</article><div class=comments><article class=comment>{comments}</article></div>",
        f"<body>{nav}<article>{article}</article><div class=cookie-consent>{part * 5}</div>{foot}",
    ]
    for known in (learned, html_extraction.potentials({})):
        assert [html_extraction.main_text(page, known) for page in pages] == [text] * len(pages)
        tree = html_extraction.parse(f"<article>{article}<div class=ad>{part}</div></article>")
        ad = next(p for p, seen, tag in zip(html_extraction.marginals(tree, known), tree.seen, tree.tag) if tag and seen == html_extraction.ASIDE)
        assert 0 < ad[html_extraction.CONTENT] < 0.5


def test_dropped_elements_without_an_end_tag(spark):
    known = html_extraction.train(spark.read.parquet(f"{SF}/pages.parquet"))
    article = "<article><h1>Head</h1><p>The first part of the article.<p>And the second.</article>"
    text = "Head The first part of the article. And the second."
    for tag in ("select", "object", "svg", "iframe", "template", "noscript", "title"):
        for page in (f"<body><div><{tag} x=y>no</div>{article}", f"<body><{tag}>no{article}", f"<{tag}>{article}<{tag}>no</{tag}>"):
            if tag != "title" or page.count("title") == 1:
                assert html_extraction.main_text(page, known)== text, page
        assert html_extraction.main_text(f"<{tag}>no<{tag}>no</{tag}></{tag}>{article}", known) == text or tag == "title"
        assert html_extraction.main_text(f"<{tag}><p>no</p></{tag}>{article}", known) == text
    formula = "<article><h1>Head</h1><p>Where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</article>"
    assert html_extraction.main_text(formula, known) == "Head Where x=1 holds."
    assert html_extraction.main_text(f"<article><h1>Head</h1></article><script>{article}", known) == "Head"


# The pipeline


def test_pipeline(spark, texts):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() > 0 and {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} <= {r["doc_id"] for r in kept.collect()}
