"""Preference pairs of whole conversation tables against a brute-force version."""

from __future__ import annotations

from collections import Counter, defaultdict

from rollmart.llm import chat_format
from rollmart.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def brute_pairs(rows):
    """(pair_id, prompt turns, prompt, chosen, chosen mask, rejected, rejected mask) of every conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[conv].append((role or "", text or ""))

    def last(conv):
        return max((i for i, t in enumerate(turns.get(conv, ())) if t[0] == "assistant"), default=None)

    def render(part):
        text, mask = "", []
        for role, words in part:
            text += f"<|{role}|>\n"
            if role == "assistant":
                mask.append((len(text), len(text + words + "<|end|>\n")))
            text += words + "<|end|>\n"
        return text, tuple(mask)

    found = Counter()
    for conv, chosen in turns.items():
        rejected, at = list(chosen), last(conv)
        if at is not None:
            neighbour = None if conv is None else conv + (1 if conv % 2 == 0 else -1)
            reply = "" if neighbour is None or last(neighbour) is None else turns[neighbour][last(neighbour)][1]
            rejected[at] = ("assistant", reply)
        same = next((i for i, (a, b) in enumerate(zip(chosen, rejected)) if a != b), len(chosen))
        if chosen == rejected and at is not None:
            same = at
        found[conv, same, render(chosen[:same])[0], *render(chosen[same:]), *render(rejected[same:])] += 1
    return found


def pairs(frame):
    return Counter(
        (r["pair_id"], r["n_prompt_turns"], r["prompt"], r["chosen"], tuple(map(tuple, r["chosen_mask"])), r["rejected"],
         tuple(map(tuple, r["rejected_mask"])))
        for r in frame.collect()
    )


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert pairs(REGISTRY["op5_preference_format"](spark, SF)) == brute_pairs(rows)


def test_odd_turns_equal_brute_force(spark):
    rows = [
        (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "behind"), (1, 0, "assistant", "b"), (2, 0, "user", "only"),
        (3, 0, None, None), (3, 1, "assistant", None), (4, 5, "assistant", "x"), (4, 5, "assistant", "x"), (4, None, "system", "first"),
        (None, 0, "user", "lost"), (None, 1, "assistant", "reply"), (-1, 0, "assistant", "long " * 50_000), (-2, 0, "assistant", "é \U0001f600"),
        (6, 0, "assistant", ""), (7, 0, "user", "u"),
    ]
    schema = "conv_id long, turn long, role string, text string, chosen string, pair_id int, prompt boolean"
    frame = spark.createDataFrame([(*r, "mine", 1, True) for r in rows], schema)
    assert pairs(chat_format.format_preferences(chat_format.swapped_replies(frame))) == brute_pairs(rows)
    assert chat_format.format_preferences(chat_format.swapped_replies(frame.limit(0))).count() == 0
