"""Secret scans: base patterns plus a grammar inferred from the credentials they find.

The values of the base matches are labelled credentials. A sample of distinct values, bounded as a whole (``LABELLED``) and
for each outline (``PER_OUTLINE``), so that a frequent format does not crowd out a rare one, is written into one prefix tree.
Its alphabet is the shape of a value: a run of letters and digits counts as digits, hex, lower case and digits, mixed and so
on, sign by sign, and a short word before ``_`` or ``-`` stands for itself (``ghp_``). States of the tree are merged where
their counts are statistically compatible (ALERGIA: Hoeffding bounds on stopping and on every next sign, down the
subtrees). States that too few credentials reach for the bounds to tell anything apart are left as they are, so a
format keeps its length. The probabilistic automaton gives the likelihood of a run as a credential, a chain of character
classes that of an ordinary word; both are likelihoods of the very signs, so their ratio scores any run.

All other long runs of credential signs are scored, whatever they consist of, as they stand and in lower case. Those above
the mark are spans of the kind ``format``. The mark is the score that a share of ``FALSE_RATE`` of the ordinary words
exceeds, and at least ``-log(FALSE_RATE)``. The chain counts one half of the ordinary words of all documents, and the mark
is counted on the other half, also of all documents, without the words whose shape is mostly that of labelled credentials.

One pass over the whole texts finds base spans and candidates, and another one, if there are credentials, ordinary words.
NULL texts are empty, repeated rows are scanned each, without credentials nothing is inferred; columns besides ``doc_id``
and ``text`` are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from heapq import heapify, heappop, heappush
from math import ceil, inf, log, sqrt

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import Scratch
from .common import whole

KINDS = ("assign", "access", "hex", "format")
# The base patterns. A run of hex digits or of credential signs is only tried at its first sign.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_CANDIDATE = 6, 20, 16

LABELLED, PER_OUTLINE = 4_000, 400
# Fewer credentials than these decide nothing.
LEAST_LABELLED = 8
ALPHA = 0.01
# States that fewer credentials pass through are not merged: with the bounds of ALPHA all of them would be alike.
LEAST_PASSED = 12
UNSEEN = 1e-4
FALSE_RATE = 1e-4
# How many forms of a shape may lack a label for each that has one, before the shape is one of ordinary words.
UNLABELLED = 5

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the base patterns, by start and kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [
            ("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN
        ]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Long runs that touch no base span."""
    found = []
    for m in CANDIDATE.finditer(text):
        value = m[0].rstrip(".-/")
        if len(value) < LEAST_CANDIDATE:
            continue
        start, end = m.start(), m.start() + len(value)
        if not any(s < end and start < e for _, s, e, _ in taken):
            found.append(("format", start, end, value))
    return found


# Character classes: a digit, a lower or upper hex letter, any other lower or upper letter.
DIGIT, HEX_LOWER, HEX_UPPER, LOWER, UPPER = CLASSES = "0ηΗλΛ"
_CLASS_OF = str.maketrans({
    **dict.fromkeys("0123456789", DIGIT), **dict.fromkeys("abcdef", HEX_LOWER), **dict.fromkeys("ABCDEF", HEX_UPPER),
    **dict.fromkeys("ghijklmnopqrstuvwxyz", LOWER), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", UPPER),
})
# How many signs a class holds; other signs stand for themselves.
CLASS_SIZES = {DIGIT: 10, HEX_LOWER: 6, HEX_UPPER: 6, LOWER: 20, UPPER: 20}
# What a run consists of, the sign that stands for each of its places, and how many signs may stand there.
RUNS = (
    ({DIGIT}, "δ", 10), ({DIGIT, HEX_LOWER}, "χ", 16), ({DIGIT, HEX_UPPER}, "Χ", 16), ({HEX_LOWER, LOWER}, "ν", 26),
    ({HEX_UPPER, UPPER}, "Ν", 26), ({HEX_LOWER, LOWER, HEX_UPPER, UPPER}, "ω", 52), ({DIGIT, HEX_LOWER, LOWER}, "α", 36),
    ({DIGIT, HEX_UPPER, UPPER}, "Α", 36), (set(CLASSES), "μ", 62), ({*CLASSES, "+", "/"}, "β", 64),
)
RUN_SIZES = {sign: size for _, sign, size in RUNS}
_PREFIX = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z]{1,8}(?=[_-])")
_RUN = re.compile(f"[{CLASSES}+/]+")


def form(value: str) -> str:
    """Character classes of a value; a short word before an underscore or hyphen and other signs stand for themselves."""
    plain = value.translate(_CLASS_OF)
    if "_" in value or "-" in value:
        for m in _PREFIX.finditer(value):
            plain = plain[: m.start()] + m[0] + plain[m.end() :]
    return plain


def shape(form_: str) -> str:
    """A form with each run as what the run consists of."""
    def of_run(m: re.Match) -> str:
        found = set(m[0])
        return next(sign for signs, sign, _ in RUNS if found <= signs) * len(m[0])

    return _RUN.sub(of_run, form_)


def outline(value: str) -> str:
    """The shape with runs of one sign as that sign."""
    return re.sub(r"(.)\1+", r"\1", shape(form(value)))


@dataclass
class State:
    passed: int = 0
    stopped: int = 0
    count: dict[str, int] = field(default_factory=dict)
    to: dict[str, int] = field(default_factory=dict)


class Automaton:
    """A probabilistic automaton inferred from strings by merging compatible states of their prefix tree."""

    def __init__(self, strings: Iterable[str], alpha: float = ALPHA):
        self.states = [State()]
        self.bound = sqrt(0.5 * log(2 / alpha))
        for string in strings:
            self._insert(string)
        self._merge_states()

    def _insert(self, string: str) -> None:
        at = self.states[0]
        at.passed += 1
        for sign in string:
            if sign not in at.to:
                at.to[sign] = len(self.states)
                self.states.append(State())
            at.count[sign] = at.count.get(sign, 0) + 1
            at = self.states[at.to[sign]]
            at.passed += 1
        at.stopped += 1

    def _differ(self, f: int, n: int, g: int, m: int) -> bool:
        return abs(f / n - g / m) > self.bound * (1 / sqrt(n) + 1 / sqrt(m))

    def _compatible(self, one: int, other: int) -> bool:
        pairs = [(one, other)]
        while pairs:
            a, b = (self.states[i] for i in pairs.pop())
            if min(a.passed, b.passed) < LEAST_PASSED:
                continue
            if self._differ(a.stopped, a.passed, b.stopped, b.passed):
                return False
            for sign in a.count.keys() | b.count.keys():
                if self._differ(a.count.get(sign, 0), a.passed, b.count.get(sign, 0), b.passed):
                    return False
                if sign in a.to and sign in b.to:
                    pairs.append((a.to[sign], b.to[sign]))
        return True

    def _fold(self, into: int, tree: int) -> list[int]:
        """Adds the counts of a subtree to the automaton at ``into``; the states that it reached."""
        pairs, reached = [(into, tree)], []
        while pairs:
            target, source = pairs.pop()
            reached.append(target)
            a, b = self.states[target], self.states[source]
            a.passed += b.passed
            a.stopped += b.stopped
            for sign, n in b.count.items():
                a.count[sign] = a.count.get(sign, 0) + n
                if sign in a.to:
                    pairs.append((a.to[sign], b.to[sign]))
                else:
                    a.to[sign] = b.to[sign]
        return reached

    def _merge_states(self) -> None:
        """Settled states are kept; of their unsettled successors the most frequent one is merged or settled next."""
        place, order = {0: 0}, [0]
        waiting = [(-self.states[t].passed, 0, sign) for sign, t in self.states[0].to.items()]
        heapify(waiting)
        while waiting:
            passed, k, sign = heappop(waiting)
            blue = self.states[order[k]].to[sign]
            if blue in place:
                continue
            if -self.states[blue].passed != passed:  # it has grown since by a merge
                heappush(waiting, (-self.states[blue].passed, k, sign))
                continue
            red = self._partner(order, blue)
            if red is None:
                place[blue] = len(order)
                order.append(blue)
                grown = [blue]
            else:
                self.states[order[k]].to[sign] = red
                grown = [state for state in self._fold(red, blue) if state in place]
            for state in grown:
                for s, t in self.states[state].to.items():
                    if t not in place:
                        heappush(waiting, (-self.states[t].passed, place[state], s))
        self.states = [
            State(s.passed, s.stopped, s.count, {sign: place[t] for sign, t in s.to.items()})
            for s in (self.states[i] for i in order)
        ]

    def _partner(self, order: list[int], blue: int) -> int | None:
        """The first settled state that a state is compatible with."""
        if self.states[blue].passed < LEAST_PASSED:
            return None
        frequent = (red for red in order if self.states[red].passed >= LEAST_PASSED)
        return next((red for red in frequent if self._compatible(red, blue)), None)

    def log_likelihood(self, string: str) -> float:
        """Of the shape and its end; what was never seen counts ``UNSEEN`` and leaves the state as it is."""
        total, at = 0.0, self.states[0]
        for sign in string:
            if sign in at.to:
                total += log(at.count[sign] / at.passed)
                at = self.states[at.to[sign]]
            else:
                total += log(UNSEEN)
        return total + log(max(UNSEEN, at.stopped / at.passed if at.passed else UNSEEN))


class Ordinary:
    """A chain of character classes of ordinary words."""

    def __init__(self, pairs: dict[str, int]):
        self.after: dict[str, Counter] = defaultdict(Counter)
        for (one, other), n in pairs.items():
            self.after[one][other] += n
        self.total = {one: sum(c.values()) for one, c in self.after.items()}

    def log_likelihood(self, form_: str) -> float:
        plain = form_.translate(_CLASS_OF)
        # Twelve classes and signs, one count each to begin with.
        steps = sum(
            log((self.after[one][other] + 1 if one in self.after else 1) / (self.total.get(one, 0) + 12))
            for one, other in zip("^" + plain, plain + "$")
        )
        return steps - sum(log(CLASS_SIZES.get(c, 1)) for c in plain)


@dataclass
class Grammar:
    """The automaton, the chain of ordinary words, and the score above which a run is taken for a credential."""

    automaton: Automaton | None
    ordinary: Ordinary
    mark: float = inf

    def score(self, form_: str) -> float:
        """How much more likely a form is as a credential than as an ordinary word."""
        if self.automaton is None:
            return -inf
        signs = shape(form_)
        likelihood = self.automaton.log_likelihood(signs) - sum(log(RUN_SIZES.get(c, 1)) for c in signs)
        return likelihood - self.ordinary.log_likelihood(form_)

    def matches(self, value: str) -> bool:
        return any(self.score(f) > self.mark for f in {form(value), form(value.lower())})


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        base = [base_spans(text) for text in batch["text"]]
        more = [candidates(text, spans) for text, spans in zip(batch["text"], base)]
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "base": base, "candidates": more})


def _ordinary_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Forms of the words that touch no base span, how often they occur, and the half a word is in."""
    run = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
    for batch in batches:
        words: Counter = Counter()
        for text in batch["text"]:
            spans = base_spans(text)
            if not spans:
                words.update(run.findall(text))
                continue
            known = {value for *_, value in spans}
            at = reached = 0
            for m in run.finditer(text):
                while at < len(spans) and spans[at][1] < m.end():
                    reached = max(reached, spans[at][2])
                    at += 1
                if reached <= m.start() and m[0] not in known:
                    words[m[0]] += 1
        forms: Counter = Counter()
        for word, n in words.items():
            forms[blake2b(word.encode(), digest_size=1).digest()[0] % 2 == 1, form(word)] += n
        yield pd.DataFrame([(held, f, n) for (held, f), n in forms.items()], columns=["held", "form", "n"])


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pairs: Counter = Counter()
        for form_, n in zip(batch["form"], batch["n"]):
            plain = form_.translate(_CLASS_OF)
            for one, other in zip("^" + plain, plain + "$"):
                pairs[one + other] += n
        yield pd.DataFrame(list(pairs.items()), columns=["pair", "n"])


def labelled(scanned: DataFrame) -> list[str]:
    """A bounded sample of the distinct credentials of the base matches: of every outline those with the smallest hashes."""
    values = scanned.select(F.explode("base").alias("s")).select(F.col("s.value").alias("value")).distinct()

    def outlines(of: pd.Series) -> pd.Series:
        return of.map(outline)

    first = Window.partitionBy("outline").orderBy(F.xxhash64("value"), "value")
    ranked = values.withColumn("outline", F.pandas_udf(outlines, "string")("value")).withColumn("_rank", F.row_number().over(first))
    kept = ranked.where(F.col("_rank") <= PER_OUTLINE).orderBy("_rank", F.xxhash64("value"), "value").limit(LABELLED)
    return [r["value"] for r in kept.collect()]


def learn(docs: DataFrame, scanned: DataFrame) -> Grammar:
    """The grammar of a bounded sample of the base matches in ``scanned`` and of the ordinary words of all documents."""
    credentials = labelled(scanned)
    if len(credentials) < LEAST_LABELLED:
        return Grammar(None, Ordinary({}))
    automaton = Automaton(shape(form(value)) for value in credentials)
    words = docs.select(whole(F.col("text")).alias("text")).mapInPandas(_ordinary_words, "held boolean, form string, n long")
    forms = Scratch(docs.sparkSession).keep(words.groupBy("held", "form").agg(F.sum("n").alias("n")), "forms")
    pairs = forms.where("NOT held").mapInPandas(_pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # At most as many rows as pairs of classes and signs.
    grammar = Grammar(automaton, Ordinary({r["pair"]: r["n"] for r in pairs.collect()}))

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(shape(f), max(LOWEST, ceil(grammar.score(f))), n) for f, n in zip(batch["form"], batch["n"])]
            yield pd.DataFrame(found, columns=["shape", "score", "n"])

    shaped = forms.where("held").select("form", "n").mapInPandas(scores, "shape string, score long, n long")
    counted = shaped.groupBy("shape", "score").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"))
    counted = Scratch(docs.sparkSession).keep(counted, "scores")
    ordinary = counted.join(credential_shapes(scanned, counted), "shape", "left_anti")
    # Scores rounded up, so a row for each whole number between the lowest and the highest.
    histogram = {r["score"]: r["n"] for r in ordinary.groupBy("score").agg(F.sum("n").alias("n")).collect()}
    return Grammar(automaton, grammar.ordinary, mark_of(histogram))


def credential_shapes(scanned: DataFrame, counted: DataFrame) -> DataFrame:
    """Shapes that are labelled often enough: words of these are credentials without a label and no ordinary words.

    Distinct forms are counted, not how often they occur, so copies of a document do not make a shape ordinary.
    """
    def to_form(values: pd.Series) -> pd.Series:
        return values.map(form)

    def to_shape(forms: pd.Series) -> pd.Series:
        return forms.map(shape)

    values = scanned.select(F.explode("base").alias("s")).select(F.col("s.value").alias("value"))
    known = values.select(F.pandas_udf(to_form, "string")("value").alias("form")).distinct()
    known = known.select(F.pandas_udf(to_shape, "string")("form").alias("shape")).groupBy("shape").agg(F.count(F.lit(1)).alias("known"))
    words = counted.groupBy("shape").agg(F.sum("forms").alias("forms"))
    return words.join(known, "shape").where(F.col("forms") <= UNLABELLED * F.col("known")).select("shape")


# Scores below this one are counted together.
LOWEST = -1000


def mark_of(histogram: dict[int, int], rate: float = FALSE_RATE) -> float:
    """The least whole score that at most a share of ``rate`` of the counted words exceeds, and at least -log(rate)."""
    allowed, above, mark = rate * sum(histogram.values()), 0, float(LOWEST)
    for score in sorted(histogram, reverse=True):
        above += histogram[score]
        if above > allowed:
            mark = float(score)
            break
    return max(mark, -log(rate))


def scan(docs: DataFrame, grammar: Grammar | None = None) -> DataFrame:
    """doc_id, base and spans of every row: base matches, and these together with the inferred ones, in order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    found = rows.mapInPandas(_scan, f"doc_id long, base {SPANS}, candidates {SPANS}")
    found = Scratch(docs.sparkSession).keep(found, "spans")
    known = grammar or learn(docs, found)

    def likely(values: pd.Series) -> pd.Series:
        return pd.Series([[bool(known.matches(v)) for v in row] for row in values], dtype="object")

    judged = F.when(
        F.size("candidates") > 0, F.pandas_udf(likely, "array<boolean>")(F.transform("candidates", lambda c: c["value"]))
    )
    found = found.withColumn("_likely", judged)
    more = F.filter("candidates", lambda c, i: F.get("_likely", i))
    order = F.transform(F.concat("base", F.coalesce(more, F.array().cast(SPANS))), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("place"), s.alias("span")
    ))
    spans = F.transform(F.array_sort(order), lambda s: s["span"])
    return found.select("doc_id", "base", F.when(F.size("candidates") > 0, spans).otherwise(F.col("base")).alias("spans"))


def listed(spans: str):
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
