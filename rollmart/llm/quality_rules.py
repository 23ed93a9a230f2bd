"""Quality rules: a learned decision list over text statistics, emitted as one ordered Spark conditional.

Sequential covering: a rule is a conjunction of thresholds, grown one condition at a time by information gain on two
thirds of the labelled rows, cut back to the prefix that does best on the other third and taken if it is precise there.
Rows it covers are set aside and the next rule is grown on the rest. All counts are Spark aggregates over binned
statistics; the driver sees one histogram (features x thresholds) at a time.

Everything on the path of the documents is a built-in function. NULL texts count as empty, repeated rows are judged one
by one, an empty ``labels`` table (or one that matches no document) learns no rule, and columns of the input that have
the name of an output column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.folders import Scratch
from .common import WORD, ratio, whole, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Labelled rows a list is learned from: those with the smallest hash of their id.
SAMPLE = 20_000
QUANTILES = 24

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# (part, total) of each feature. None depends on the length of a text as such.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "repeated_word_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "exclamations_per_word": ("n_exclaim", "n_words"),
    "word_length": ("word_chars", "n_words"),
}


def feature(name: str) -> Column:
    return ratio(*map(F.col, FEATURES[name]))


def _bound(value: str, name: str, use: str) -> str:
    """SQL for ``use`` with a value computed once. As columns of their own, values that are used several times would be
    written out again and again where a filter moves below them."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _pairs(hashes: str, span: int) -> str:
    """SQL for the hashes of twice as many words."""
    left = f"greatest(size({hashes}) - {span}, 0)"
    return f"zip_with(slice({hashes}, 1, {left}), slice({hashes}, {span + 1}, {left}), (a, b) -> xxhash64(a, b))"


# Starts of windows that equal a neighbour in hash order, back in the order of the text; then the words they cover.
STARTS = (
    "array_sort(transform(filter(o, (w, j) -> coalesce(get(o, j - 1).h = w.h, false) "
    "OR coalesce(get(o, j + 1).h = w.h, false)), w -> w.i))"
)
COVERED = (
    f"aggregate({STARTS}, named_struct('till', 0, 'n', 0), (a, i) -> "
    f"named_struct('till', i + {WINDOW}, 'n', a.n + i + {WINDOW} - greatest(a.till, i)), a -> a.n)"
)
ORDERED = "array_sort(transform(h8, (h, i) -> struct(h AS h, i AS i)))"
COUNTED = f"IF(size(array_distinct(h8)) = size(h8), 0, {_bound(ORDERED, 'o', COVERED)})"
# Hashes of one word become those of 2, 4 and 8 words.
REPEATED = _bound(
    "transform(_words, w -> xxhash64(w))", "h1",
    _bound(_pairs("h1", 1), "h2", _bound(_pairs("h2", 2), "h4", _bound(_pairs("h4", 4), "h8", COUNTED))),
)


def _without(text: Column, pattern: str) -> Column:
    """Code points of the text that the pattern matches."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def statistics(rows: DataFrame) -> DataFrame:
    """Adds the counts in ``BASE`` and what the features need.

    ``n_repeat_words`` counts the words that lie in some 8-word window occurring at least twice in the text. Windows are
    compared by a 64-bit hash within one text; only texts with an equal pair sort their windows.
    """
    text = whole(F.col("text"))
    cut = rows.withColumns({
        "_words": words(F.col("text")),
        "_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
        "n_symbols": _without(text, r"[#*$%&|<>]"),
        "n_upper": _without(text, r"\p{Lu}"),
        "n_exclaim": (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).cast("long"),
    })
    hashed = cut.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.expr(REPEATED).cast("long"),
    })
    return hashed.drop("_words", "_lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in the order in which they are tried; a row that any of them covers is of low quality."""

    rules: tuple[tuple[Condition, ...], ...]

    def first_rule(self) -> Column:
        """Number of the first rule that covers the row, from 1; 0 if none does."""
        verdict = F.lit(0)
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            covered = F.lit(True)
            for condition in rule:
                covered = covered & condition.column()
            verdict = F.when(covered, number).otherwise(verdict)
        return verdict

    def __str__(self) -> str:
        return "\n".join(f"{n}: " + " and ".join(map(str, rule)) for n, rule in enumerate(self.rules, 1))


@dataclass(frozen=True)
class _Step:
    """One condition on bins, and the rows it leaves: (bad, good) of the growing and of the pruning part."""

    feature: int
    above: bool
    bin: int
    grow: tuple[int, int]
    prune: tuple[int, int]


def labelled_statistics(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE) -> DataFrame:
    """Features and label of at most ``sample`` labelled ids; contradicting labels of an id count as bad."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    known = scratch.keep(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labels")
    # At most ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = statistics(rows).select(
        (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) < 2).alias("grow"),
        (F.col("_good") == 0).alias("bad"),
        *(feature(name).alias(name) for name in FEATURES),
    )
    return scratch.keep(rows, "labelled")


def _thresholds(rows: DataFrame) -> list[list[float]]:
    """Candidate thresholds of each feature: the quantiles of the good and of the bad rows."""
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    per_class = rows.where("grow").groupBy("bad").agg(
        *(F.percentile_approx(name, shares, 10_000).alias(name) for name in FEATURES)
    ).collect()
    return [sorted({value for row in per_class for value in row[name]}) for name in FEATURES]


def _bin(name: str, cuts: list[float]) -> Column:
    """The number of thresholds below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col(name)))


def _counts(rows: DataFrame, scratch_filter: Column) -> dict:
    """(feature, bin) -> counts by (grow, bad) of the rows that the filter leaves."""
    found = (
        rows.where(scratch_filter).select("grow", "bad", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("feature", "bin").agg(
            *(F.count_if((F.col("grow") == grow) & (F.col("bad") == bad)).alias(f"g{grow:d}b{bad:d}")
              for grow in (True, False) for bad in (True, False))
        )
    )
    return {(r["feature"], r["bin"]): (r["g1b1"], r["g1b0"], r["g0b1"], r["g0b0"]) for r in found.collect()}


def _best_step(counts: dict, thresholds: list[list[float]], before: tuple[int, int]) -> _Step | None:
    """The condition with the highest gain on the growing part; ties go to the earlier feature and threshold."""
    best, best_gain = None, 0.0
    base = log2(before[0] / sum(before)) if before[0] else 0.0
    for feature, cuts in enumerate(thresholds):
        bins = [counts.get((feature, b), (0, 0, 0, 0)) for b in range(len(cuts) + 1)]
        total = tuple(map(sum, zip(*bins)))
        below = (0, 0, 0, 0)
        for b in range(len(cuts)):
            below = tuple(map(sum, zip(below, bins[b])))
            rest = tuple(t - u for t, u in zip(total, below))
            for above, left in ((False, below), (True, rest)):
                bad, good = left[:2]
                gain = bad * (log2(bad / (bad + good)) - base) if bad else 0.0
                if gain > best_gain + 1e-9:
                    best, best_gain = _Step(feature, above, b, left[:2], left[2:]), gain
    return best


def _on_bins(steps: list[_Step]) -> Column:
    covered = F.lit(True)
    for step in steps:
        place = F.element_at("bins", step.feature + 1)
        covered = covered & (place > step.bin if step.above else place <= step.bin)
    return covered


def learn(
    rows: DataFrame, scratch: Scratch, min_precision: float = 0.97, min_support: int = 5,
    max_rules: int = 8, max_conditions: int = 3,
) -> DecisionList:
    """The decision list for rows of ``labelled_statistics``.

    A rule is taken if it covers at least ``min_support`` bad rows of the growing part and at least ``min_precision`` of
    what it covers in the pruning part is bad; the first rule that is not ends the list.
    """
    thresholds = _thresholds(rows)
    if not any(thresholds):
        return DecisionList(())
    bins = F.array(*map(_bin, FEATURES, thresholds))
    binned = scratch.keep(rows.select("grow", "bad", bins.alias("bins")), "bins")
    rules: list[tuple[Condition, ...]] = []
    remaining = F.lit(True)
    while len(rules) < max_rules:
        steps: list[_Step] = []
        counts = _counts(binned, remaining)
        first = [sum(c[k] for (feature, _), c in counts.items() if feature == 0) for k in range(4)]
        before = (first[0], first[1])
        while len(steps) < max_conditions and before[0]:
            step = _best_step(counts, thresholds, before)
            if step is None:
                break
            steps.append(step)
            before = step.grow
            if not step.grow[1]:
                break
            counts = _counts(binned, remaining & _on_bins(steps))
        worth = [(s.prune[0] - s.prune[1]) / max(1, sum(s.prune)) for s in steps]
        if not steps:
            break
        steps = steps[: worth.index(max(worth)) + 1]
        bad, good = steps[-1].prune
        if steps[-1].grow[0] < min_support or not bad or bad < min_precision * (bad + good):
            break
        names = list(FEATURES)
        rules.append(tuple(Condition(names[s.feature], s.above, thresholds[s.feature][s.bin]) for s in steps))
        remaining = remaining & ~_on_bins(steps)
    return DecisionList(tuple(rules))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """Adds the base counts, ``base_failed``, ``rule`` (0: none) and ``kept`` to the rows."""
    given = [c for c in docs.columns if c.lower() not in {*BASE, "base_failed", "rule", "kept"}]
    judged = statistics(docs.select(*given)).withColumns({"base_failed": base_failed(), "rule": rules.first_rule()})
    return judged.select(
        *given, *BASE, "base_failed", "rule", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept")
    )


def learned_from(docs: DataFrame, labels: DataFrame) -> DecisionList:
    with Scratch(docs.sparkSession) as scratch:
        return learn(labelled_statistics(docs, labels, scratch), scratch)


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base rules and no rule of the list covers, with their columns."""
    rules = learned_from(docs, labels)
    mine = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")
    # A filter would move below the statistics and compute them a second time.
    judged = judge(mine, rules).withColumn("_place", F.monotonically_increasing_id())
    return judged.where("kept AND _place >= 0").select("_row.*")
