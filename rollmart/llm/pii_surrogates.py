"""PII: detected entities are replaced by keyed surrogates of their type, format, script and gender.

Found are e-mail addresses, phone and card numbers, IPv4 addresses, and names behind a title (in Latin, Cyrillic or Greek
script; the title gives the gender). A surrogate is a keyed hash of the entity laid into its form: digits become digits
(card numbers that pass the Luhn check still do, country codes and private address ranges stay), letters become letters of
the same script, names become names of the same script, given names also of the same gender.

A name is all capitalised words and initials behind its title. Its words are entities of their own: the first of several
is the given name, the others and a single one are surnames, so a surname maps alike with and without a given name and in
all documents. Particles (von, de la) stay as part of the form. In a document that names somebody with a title, the words of
that name are replaced wherever they stand capitalised, with initials before them; an initial goes with the given name
that the document has for it, and a single word that is a given name elsewhere in the document is that one.

Distinctness is checked over the whole corpus: where two entities share a surrogate, or a surrogate is an entity that
occurs, all but the smallest entity take their next attempt, until nothing collides. The space grows with the attempts
(one more syllable or letter each; after some attempts in the same form one more digit, the next wider address range and
at last IPv6), so every entity gets a surrogate however many there are. Texts without an entity are
returned as they are. A NULL text stays NULL, repeated rows are replaced alike, columns besides ``doc_id`` and ``text``
are not looked at.
"""

from __future__ import annotations

import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from unicodedata import normalize

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folders import Scratch

TYPES = ("email", "phone", "card", "ip", "name")
KEY = "surrogates"
# Attempts in the plain form before numbers get more digits and addresses a wider range.
PLAIN_ATTEMPTS = 4

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{4}(?!\w)|(?<![\w.])\+\d{9,14}(?!\w)")
CARD = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)")
IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
# Titles, by gender and script.
TITLES = {
    ("m", "latin"): ("Mr", "Herr", "Monsieur", "Señor", "Sr"),
    ("f", "latin"): ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"),
    ("m", "cyrillic"): ("Господин",),
    ("f", "cyrillic"): ("Госпожа",),
    ("m", "greek"): ("Κύριος",),
    ("f", "greek"): ("Κυρία",),
}
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Henry", "Jonas", "Leo", "Martin", "Oscar", "Paul"),
    ("f", "latin"): ("Alice", "Bianca", "Clara", "Diana", "Emma", "Flora", "Helen", "Julia", "Laura", "Maria", "Nora", "Sofia"),
    ("m", "cyrillic"): ("Андрей", "Борис", "Виктор", "Иван", "Олег", "Павел"),
    ("f", "cyrillic"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"),
    ("m", "greek"): ("Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος"),
    ("f", "greek"): ("Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία"),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa ga ha ka la le li lo ma me mi na ne no pa ra re ri ro sa se ta te to va wi".split(),
    "cyrillic": "ба ва га да жа за ка ла ма на па ра са та фа ха".split(),
    "greek": "βα γα δα ζα κα λα μα να πα ρα σα τα φα χα λο μο".split(),
}
GENDER = {title: kind for kind, titles in TITLES.items() for title in titles}
LETTER = "(?:[^\\W\\d_][\u0300-\u036f]*)"
WORD = rf"{LETTER}+(?:['’](?!s\b){LETTER}+)*"
TITLE = re.compile(
    r"\b(" + "|".join(sorted(GENDER, key=len, reverse=True)) + r")\b(?:\.|(?=\s))[^\S\n]{0,3}\n?[^\S\n]{0,3}"
    r"(?:(?:Dr|Prof|Doktor|Professor)\b\.?[^\S\n]{0,3})*"
)
PART = re.compile(WORD)
GAP = re.compile(r"[^\S\n]{1,3}|[-‐‑]")
MENTION = re.compile(rf"(?<![^\W_])((?:{LETTER}\.[^\S\n]{{0,2}})*)({WORD})")
# Words inside a surname that stay, and words that end a name.
PARTICLES = frozenset(
    "af al av bin da das de del della den der di do dos du el ibn la le los ten ter van vom von y zu zum zur".split()
)
ENDS = frozenset("Jr Jnr Snr II III IV Dr Prof".split()) | frozenset(GENDER)

SPANS = "array<struct<kind:string,start:int,end:int,form:string,entity:string,mention:boolean>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


@dataclass
class Part:
    """A word or an initial of a name; ``joined`` to the one before by a hyphen."""

    start: int
    end: int
    form: str
    joined: bool

    def __post_init__(self) -> None:
        self.key = normalize("NFC", self.form).casefold().replace("’", "'")
        self.initial = len(normalize("NFC", self.form).rstrip(".")) == 1
        if self.initial:
            self.key = self.key[0] + "."

    def entity(self, gender: str = "") -> str:
        """Of a given name, or of a surname, which has no gender."""
        first = self.key[0]
        script = "cyrillic" if "\u0400" <= first <= "\u052f" else "greek" if "\u0370" <= first <= "\u03ff" or "\u1f00" <= first <= "\u1fff" else "latin"
        return f"{gender}/{script}/{self.key}"


def _capital(word: str) -> bool:
    return any(piece[:1].isupper() for piece in re.split("['’]", word)[:2])


def _parts(text: str, at: int) -> list[Part]:
    """The words and initials of the name that begins at ``at``."""
    found: list[Part] = []
    joined = False
    while m := PART.match(text, at):
        word, end = m[0], m.end()
        if word not in PARTICLES or joined:
            if not (joined or _capital(word)) or word in ENDS:
                break
            if len(normalize("NFC", word)) == 1 and text[end : end + 1] == ".":
                end += 1
            found.append(Part(m.start(), end, text[m.start() : end], joined))
        gap = GAP.match(text, end)
        if gap is None and text[end - 1] != ".":
            break
        # A hyphen behind a particle joins nothing.
        joined = bool(gap) and not gap[0].isspace() and bool(found) and found[-1].end == end
        at = gap.end() if gap else end
    return found


def _names(text: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """(start, end, form, entity, mention) of the words of all names; the first word of each has ``mention`` set."""
    names = []
    for m in TITLE.finditer(text):
        if parts := _parts(text, m.end()):
            names.append((GENDER[m[1]][0], parts))
    if not names:
        return
    roles: dict[str, tuple[str, str]] = {}  # gender, none for surnames, and entity of a word
    initials: dict[tuple[str, str], str] = {}
    # Longer names first: they tell given names from surnames.
    ranked = sorted(names, key=lambda name: -len(name[1]))
    entities: dict[int, str] = {}
    for gender, parts in ranked:
        groups: list[list[Part]] = []
        for p in parts:
            if p.joined and groups and not p.initial:
                groups[-1].append(p)
            else:
                groups.append([p])
        words = [g for g in groups if not g[0].initial]
        for group in words:
            for p in group:
                of, _ = roles.get(p.key, (None, ""))
                given = group is words[0] and len(words) > 1
                if given and of != "" or len(words) == len(groups) == 1 and of == gender:
                    entities[p.start] = p.entity(gender)
                    initials.setdefault((p.key[0], words[-1][-1].key), entities[p.start])
                    if p.key not in PARTICLES:
                        roles.setdefault(p.key, (gender, entities[p.start]))
                else:
                    entities[p.start] = p.entity()
                    if p.key not in PARTICLES:
                        roles.setdefault(p.key, ("", entities[p.start]))
    for gender, parts in names:
        family = next((p.key for p in reversed(parts) if not p.initial), "")
        for i, p in enumerate(parts):
            if p.initial:
                entities[p.start] = initials.get((p.key[0], family), p.entity(gender))
            yield p.start, p.end, p.form, entities[p.start], i == 0
    genders = {parts[-1].key: gender for gender, parts in reversed(names)}
    titled = {p.start for _, parts in names for p in parts}
    last = -1
    for m in MENTION.finditer(text):
        p = Part(m.start(2), m.end(), m[2], False)
        if p.initial or p.key not in roles or p.start in titled or not _capital(p.form):
            continue
        gender, entity = roles[p.key]
        mention = last < 0 or not GAP.fullmatch(text, last, m.start())
        if m[1] and m[1][0].isupper():
            for i in re.finditer(rf"{LETTER}\.", m[1]):
                one = Part(m.start(1) + i.start(), m.start(1) + i.end(), i[0], False)
                of = one.entity(gender or genders.get(p.key, names[0][0]))
                yield one.start, one.end, one.form, initials.get((one.key[0], p.key), of), mention
                mention = False
        yield p.start, p.end, p.form, entity, mention
        last = p.end


def entities(text: str) -> list[tuple[str, int, int, str, str, bool]]:
    """(kind, start, end, form, entity, mention) without overlaps, the earlier kind first; entities are the forms' common
    shape, ``mention`` is false for all words of a name but the first."""
    found: list[tuple[int, int, str, str, str, bool]] = []

    def add(kind: str, start: int, end: int, form: str, entity: str, mention: bool = True) -> None:
        place = bisect_left(found, (start,))
        if (place == len(found) or end <= found[place][0]) and (not place or found[place - 1][1] <= start):
            found.insert(place, (start, end, kind, form, entity, mention))

    if "@" in text:
        for m in EMAIL.finditer(text):
            add("email", *m.span(), m[0], m[0].lower())
    if any(c in text for c in "0123456789"):
        for m in IP.finditer(text):
            if all(int(part) < 256 for part in m[0].split(".")):
                add("ip", *m.span(), m[0], ".".join(str(int(p)) for p in m[0].split(".")))
        for m in PHONE.finditer(text):
            add("phone", *m.span(), m[0], "".join(c for c in m[0] if c.isdigit()))
        for m in CARD.finditer(text):
            digits = "".join(c for c in m[0] if c.isdigit())
            if len(digits) == 16 or luhn(digits):
                add("card", *m.span(), m[0], digits)
    for name in _names(text):
        add("name", *name)
    return [(kind, start, end, *rest) for start, end, kind, *rest in found]


class Chance:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: str, *parts: object):
        self.seed = "\x1f".join(map(str, parts)).encode()
        self.key, self.turn, self.pool = key.encode(), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            digest = hmac.new(self.key, self.seed + self.turn.to_bytes(4, "big"), sha256).digest()
            self.pool, self.turn = int.from_bytes(digest, "big"), self.turn + 1
        self.pool, found = divmod(self.pool, n)
        return found


def _letters(chance: Chance, form: str) -> str:
    """Digits for digits and letters for letters; other signs stay."""
    return "".join(
        str(chance.below(10)) if c.isdigit() else chr(ord("a") + chance.below(26)) if c.isalpha() else c for c in form
    )


def surrogate(kind: str, entity: str, attempt: int, key: str = KEY) -> str:
    """The surrogate of an entity, in the shape of entities."""
    chance = Chance(key, kind, entity, attempt)
    wider = max(0, attempt - PLAIN_ATTEMPTS + 1)
    if kind == "email":
        local, _, domain = entity.partition("@")
        host, _, top = domain.rpartition(".")
        # All addresses of a domain move to the same one.
        return f"{_letters(chance, local + 'x' * attempt)}@{_letters(Chance(key, 'domain', domain), host)}.{top}"
    if kind == "ip":
        a, b, *_ = (int(p) for p in entity.split("."))
        own = [a] if a in (10, 127) else [a, b] if (a, b) == (192, 168) or (a == 172 and 16 <= b < 32) else []
        # The own range, then the largest private one, then all public addresses, then IPv6, private for private.
        ranges = [own, *([[10]] if own and a != 10 else []), *([[]] if own else [])]
        step = wider // 2
        if step >= len(ranges):
            groups = [f"{0xFD00 + chance.below(256) if own else 0x2000 + chance.below(0x2000):x}"]
            return ":".join(groups + [f"{chance.below(65536):x}" for _ in range(7)])
        kept = ranges[step]
        drawn = [chance.below(256) for _ in range(4 - len(kept))]
        if not kept:
            while drawn[0] in (0, 10, 127, 172, 192) or drawn[0] >= 224:
                drawn[0] = chance.below(256)
        return ".".join(map(str, kept + drawn))
    if kind == "phone":
        # Of a number with a country code that stays.
        kept = max(0, len(entity) - 10)
        return entity[:kept] + str(2 + chance.below(8)) + "".join(str(chance.below(10)) for _ in range(len(entity) - kept - 1 + wider))
    if kind == "card":
        drawn = entity[0] + "".join(str(chance.below(10)) for _ in range(len(entity) - 2 + wider))
        check = next(d for d in "0123456789" if luhn(drawn + d))
        return drawn + (check if luhn(entity) else str((int(check) + 1 + chance.below(9)) % 10))
    gender, script, _ = entity.split("/", 2)
    syllables = SYLLABLES[script]
    if gender:
        stem, more = GIVEN[gender, script][chance.below(len(GIVEN[gender, script]))], 2 * attempt
    else:
        stem, more = "", 3 + attempt
    drawn = stem + "".join(syllables[chance.below(len(syllables))] for _ in range(more))
    return f"{gender}/{script}/{drawn.casefold()}"


def laid_out(kind: str, form: str, found: str) -> str:
    """A surrogate in the form in which the entity was written."""
    if kind in ("phone", "card"):
        digits = iter(found)
        return "".join(next(digits) if c.isdigit() else c for c in form) + "".join(digits)
    if kind == "name":
        # By way of capitals, so that a final sigma gets its form.
        name = found.split("/", 2)[2].upper().title()
        if len(normalize("NFC", form).rstrip(".")) == 1:
            return name[0] + form[len(form.rstrip(".")) :]
        return name.upper() if form.isupper() else name.lower() if form.islower() else name
    return found.upper() if kind == "email" and form.isupper() else found


def detect(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row number, doc_id, text and found entities of every row."""

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([entities(text) if text else [] for text in batch], dtype="object")

    rows = docs.select("doc_id", "text", F.pandas_udf(find, SPANS)("text").alias("found"))
    return scratch.keep(rows.withColumn("_row", F.monotonically_increasing_id()), "detected")


def mapping(found: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """kind, entity and surrogate of all distinct entities, no two of a kind with the same surrogate."""

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            drawn = [surrogate(*row, key) for row in zip(batch["kind"], batch["entity"], batch["attempt"])]
            yield batch.assign(surrogate=pd.Series(drawn, index=batch.index, dtype="object"))

    schema = "kind string, entity string, attempt int, surrogate string"
    distinct = found.select(F.explode("found").alias("f")).select("f.kind", "f.entity").distinct()
    drawn = scratch.keep(distinct.withColumn("attempt", F.lit(0)).mapInPandas(draw, schema), "drawn")
    known = drawn.select("kind", F.col("entity").alias("surrogate"))
    while True:
        shared = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("first"), F.count(F.lit(1)).alias("n"))
        taken = shared.where("n > 1").select("kind", "surrogate", "first").union(
            shared.join(known, ["kind", "surrogate"], "left_semi").select("kind", "surrogate", F.lit(None).cast("string"))
        ).groupBy("kind", "surrogate").agg(F.max(F.col("first").isNull()).alias("real"), F.min("first").alias("first"))
        again = drawn.join(taken, ["kind", "surrogate"]).where(F.col("real") | (F.col("entity") != F.col("first")))
        again, n = scratch.keep_counted(again.select("kind", "entity", F.col("attempt") + 1).toDF("kind", "entity", "attempt"), "again")
        if not n:
            return drawn.drop("attempt")
        kept = drawn.join(again.select("kind", "entity"), ["kind", "entity"], "left_anti")
        drawn = scratch.keep(kept.select("kind", "entity", "attempt", "surrogate").union(again.mapInPandas(draw, schema)), "drawn")


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with surrogates, and the number of entities of each kind, one row for each of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    found = detect(docs, scratch)
    known = mapping(found, scratch, key)
    spans = found.where(F.size("found") > 0).select("_row", F.explode("found").alias("f")).select("_row", "f.*")
    edits = spans.join(known, ["kind", "entity"]).groupBy("_row").agg(
        F.collect_list(F.struct("start", "end", "kind", "form", "surrogate")).alias("edits")
    )

    def edit(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, changes in batches:
            done = []
            for text, change in zip(texts, changes):
                parts, at = [], 0
                for e in sorted(change, key=lambda e: e["start"]):
                    parts += [text[at : e["start"]], laid_out(e["kind"], e["form"], e["surrogate"])]
                    at = e["end"]
                done.append("".join(parts) + text[at:])
            yield pd.Series(done, dtype="object")

    counts = [
        F.size(F.filter("found", lambda f: (f["kind"] == F.lit(kind)) & f["mention"])).cast("long").alias(f"n_{kind}")
        for kind in TYPES
    ]
    clean = found.where(F.size("found") == 0).select("doc_id", "text", *counts)
    edited = found.where(F.size("found") > 0).join(edits, "_row").withColumn(
        "text", F.pandas_udf(edit, "string")("text", "edits")
    )
    return clean.union(edited.select("doc_id", "text", *counts))
