"""HTML extraction: a tree-structured graphical model over the document tree.

Every element and every text block is a node with one of three labels: outside (holds the article but is not part of
it), content, boilerplate. Potentials couple a node with its parent, and each node with what is seen of it: for elements
the cue their tag, class, id and role give, or without one whether their text is short or mostly links, for blocks their
length and share of links. Names of headings, paragraphs and inline elements say nothing, nor does an id alone within the
article, unless it is that of comments. A boilerplate cue is evidence like any other:
it changes how likely the element's label is under each label of its parent, and its contents, which together count for
``WITHIN`` nodes, may outweigh it. An element that holds the article, or most of the page's long text and its heading, is no
boilerplate for its cue (a form around the page). The marginals come from one upward and one downward pass of
sum-product messages; blocks that are more likely content than not make the text.

The potentials are counted on labelled pages: those of a bounded sample (``SAMPLE`` pages, smallest hash of the id) whose
markup names the article itself, so that every node's label is known. Each of them is counted twice, as it is and with all
names taken off, so that the potentials also hold for pages that name nothing. What never occurs keeps the small prior, as
content inside boilerplate does.

Text: character references are decoded, white space within a block becomes one space, blocks follow in page order with one
space between them. Tags may be unclosed, cut off or out of order; an element of ``DROPPED`` that has no end tag ends with its
parent or at the next element of running text, a script, style or textarea without one goes on to the end of the page. NULL and empty pages have an empty text, repeated rows
are pages of their own, columns besides page_id, url and html are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

SAMPLE = 2_000

OUTSIDE, CONTENT, BOILERPLATE = range(3)
# What is seen of an element; MIXED names both, HOLDS is a boilerplate cue on what is around the article. Without a name:
# LINKED is mostly links, SHORT has little text, by itself or beside a sibling that has ten times as much, or paragraphs
# and headings where this one has none.
PLAIN, MAIN, ASIDE, MIXED, HOLDS, LINKED, SHORT = range(7)
SHORT_TEXT, SHORT_BESIDE, BESIDE = 80, 200, 10

# Elements by what they mean, and words of class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style title noscript template svg iframe object textarea select".split())
RAW = frozenset("script style textarea".split())
FLOW = frozenset(
    "address article aside blockquote details div dl figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
    "table ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr "
    "math annotation menclose mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt "
    "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
# Elements that hold others; what they hold is seen of them if nothing names them.
CONTAINERS = frozenset("div section table tbody tr td ul ol dl nav header footer aside article main form center".split())
# Elements of running text, whose names mostly come from what they say.
SPEAKING = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figcaption caption".split())
CLOSES_ITSELF = frozenset("li dt dd tr td th option".split())
MAIN_TAGS = frozenset("article main".split())
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
MAIN_WORDS = frozenset("article content main post entry story".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement aside banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies dialog discussion disqus footer form header masthead menu modal nav navbar navigation newsletter "
    "notice notification pager pagination popup promo related replies reply respond search share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
REMARK_WORDS = frozenset("comment comments discussion disqus replies reply respond".split())
# What follows in a name is what a page has or lacks, not what the element is: no-sidebar, has-comments.
HAVING_WORDS = frozenset("has have no not with without".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
NAME = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Tree:
    """Nodes in page order: parents come before their children."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)  # empty for a text block
    seen: list[int] = field(default_factory=list)  # the cue of an element, the bucket of a block
    text: list[str] = field(default_factory=list)
    remarks: set[int] = field(default_factory=set)  # elements that are named as comments
    by_id: set[int] = field(default_factory=set)  # elements with a boilerplate cue in nothing but their id

    def add(self, parent: int, tag: str, seen: int, text: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.seen.append(seen)
        self.text.append(text)
        return len(self.parent) - 1


def _names(attributes: str) -> list[list[str]]:
    """The words of every single name in class, id and role."""
    found = []
    for _, *values in ATTRIBUTE.findall(attributes):
        for name in "".join(values).split():
            words = NAME.findall(CAMEL.sub(" ", name).lower())
            found.append(words[: next((i for i, w in enumerate(words) if w in HAVING_WORDS), None)])
    return found


def cue(tag: str, attributes: str) -> int:
    if tag in ("html", "body") or tag in SPEAKING or (tag in INLINE and not _has_role(attributes)):
        return PLAIN
    names = _names(attributes) if attributes else []
    asides = [not ASIDE_WORDS.isdisjoint(words) for words in names]
    mains = any(not aside and not MAIN_WORDS.isdisjoint(words) for aside, words in zip(asides, names))
    if tag == "main":
        return MAIN
    if tag in ASIDE_TAGS:
        return MIXED if mains and tag in ("form", "fieldset") else ASIDE
    if any(asides):
        return MIXED if mains else ASIDE
    return MAIN if mains or tag in MAIN_TAGS else PLAIN


def _has_role(attributes: str) -> bool:
    return any(name.lower() == "role" for name, *_ in ATTRIBUTE.findall(attributes)) if attributes else False


def _only_id(attributes: str) -> str:
    """The attributes without any id."""
    return ATTRIBUTE.sub(lambda m: "" if m[1].lower() == "id" else m[0], attributes)


LENGTHS = (25, 80, 200)
BUCKETS = 2 * (len(LENGTHS) + 1)


def bucket(length: int, linked: int) -> int:
    return 2 * sum(length >= limit for limit in LENGTHS) + (2 * linked > length)


def _ends(html: str, tag: str) -> dict[int, int]:
    """Where the elements of a tag that are closed start and end."""
    found, open_ones = {}, []
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])([^>]*)(?:>|\Z)", html, re.IGNORECASE):
        if not m[1]:
            if not m[2].rstrip().endswith("/"):
                open_ones.append(m.start())
        elif open_ones:
            found[open_ones.pop()] = m.end()
    return found


def parse(html: str) -> Tree:
    tree = Tree()
    stack = [tree.add(-1, "html", PLAIN)]
    open_tags = ["html"]
    pending: list[str] = []
    linked = links = hidden = at = 0
    ends: dict[str, dict[int, int]] = {}
    # By depth, kept beside the stack: the innermost element that is not inline, and the places of those.
    owners, blocks = [0], [0]
    opened: Counter = Counter()
    never_closed: set[str] = set()

    def push(node: int, tag: str) -> None:
        stack.append(node)
        open_tags.append(tag)
        opened[tag] += 1
        if tag not in INLINE:
            blocks.append(len(stack) - 1)
        owners.append(node if tag not in INLINE or tree.seen[node] == ASIDE else owners[-1])

    def flush() -> None:
        nonlocal linked
        if pending:
            text = " ".join("".join(pending).split())
            if text:
                tree.add(owners[-1], "", bucket(len(text), linked), text)
            pending.clear()
        linked = 0

    def close(place: int) -> None:
        nonlocal links, hidden
        links -= sum(tag == "a" for tag in open_tags[place:])
        hidden -= sum(tag in DROPPED for tag in open_tags[place:])
        opened.subtract(open_tags[place:])
        del stack[place:], open_tags[place:], owners[place:]
        while blocks[-1] >= place:
            blocks.pop()

    def say(raw: str) -> None:
        nonlocal linked
        if hidden:
            return
        text = unescape(raw) if "&" in raw else raw
        pending.append(text)
        if links:
            linked += len(text)

    end = len(html)
    while at < end:
        token = TOKEN.search(html, at)
        if token is None:
            say(html[at:])
            break
        if token.start() > at:
            say(html[at : token.start()])
        at = token.end()
        slash, name, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        if name is None:
            continue
        tag = name.lower()
        if slash:
            if opened[tag] > 0:
                place = len(open_tags) - 1
                while open_tags[place] != tag:
                    place -= 1
                if any(t not in INLINE for t in open_tags[place:]) or tree.seen[stack[place]] == ASIDE:
                    flush()
                close(place)
            elif tag not in INLINE:
                flush()
            continue
        if tag in DROPPED:
            if attributes.rstrip().endswith("/"):
                continue
            if tag in RAW or tag == "title":
                closing = None
                if tag not in never_closed:
                    closing = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                if closing:
                    at = closing.end()
                else:
                    never_closed.add(tag)
                    following = html.find("<", at)
                    at = end if tag in RAW or following < 0 else following
                continue
            if tag not in ends:
                ends[tag] = _ends(html, tag)
            if token.start() in ends[tag]:
                at = max(at, ends[tag][token.start()])
                continue
            flush()
            push(tree.add(stack[-1], tag, PLAIN), tag)
            hidden += 1
            continue
        if hidden and tag in FLOW:
            close(next(i for i, t in enumerate(open_tags) if t in DROPPED))
        if tag in ("html", "body", "head"):
            flush()
            continue
        if tag == "br":
            pending.append(" ")
            continue
        seen = cue(tag, attributes)
        if tag not in INLINE or seen == ASIDE:
            flush()
            closed = {"p"} | ({tag} if tag in CLOSES_ITSELF else set())
            if tag in ("dt", "dd"):
                closed |= {"dt", "dd"}
            elif tag in ("td", "th", "tr"):
                closed |= {"td", "th"}
            # An open paragraph or item ends, unless another block was opened inside it.
            while blocks[-1] and open_tags[blocks[-1]] in closed:
                close(blocks[-1])
        if tag in VOID:
            continue
        if tag == "a":
            links += 1
        push(tree.add(stack[-1], tag, seen) if tag not in INLINE or seen == ASIDE else stack[-1], tag)
        if seen == ASIDE:
            if any(not REMARK_WORDS.isdisjoint(words) for words in _names(attributes)):
                tree.remarks.add(stack[-1])
            elif cue(tag, _only_id(attributes)) == PLAIN:
                tree.by_id.add(stack[-1])
    flush()
    _free_wrappers(tree)
    _look_inside(tree)
    return tree


def contents(tree: Tree) -> list[int]:
    """What is seen of every container by what it holds: LINKED, SHORT or PLAIN; PLAIN for all other elements."""
    size = len(tree.parent)
    every, linked = [0] * size, [0] * size
    speaks = [tag in SPEAKING for tag in tree.tag]  # whether there are paragraphs or headings in it
    for i in range(size - 1, 0, -1):
        if not tree.tag[i]:
            every[i] = len(tree.text[i])
            linked[i] = every[i] if tree.seen[i] % 2 else 0
        every[tree.parent[i]] += every[i]
        linked[tree.parent[i]] += linked[i]
        speaks[tree.parent[i]] |= speaks[i]
    largest = [0] * size  # text of the largest child
    for i in range(1, size):
        largest[tree.parent[i]] = max(largest[tree.parent[i]], every[i])

    def seen(i: int) -> int:
        n = every[i]
        if tree.tag[i] not in CONTAINERS or not n:
            return PLAIN
        if 2 * linked[i] > n:
            return LINKED
        above = max(tree.parent[i], 0)
        if speaks[i] and n == largest[above]:  # the most there is
            return PLAIN
        beside = BESIDE * n < largest[above] or speaks[above] and not speaks[i]
        return SHORT if n < SHORT_TEXT or n < SHORT_BESIDE and beside else PLAIN

    return [seen(i) for i in range(size)]


def _look_inside(tree: Tree) -> None:
    """Elements that nothing names are seen by what they hold; an id within the article is no cue where it holds text."""
    held = contents(tree)
    named = [False] * len(tree.parent)  # whether the article is around a node
    for i, tag in enumerate(tree.tag):
        above = tree.parent[i]
        named[i] = above >= 0 and (named[above] or tree.seen[above] == MAIN and bool(tree.tag[above]))
        if tag and tree.seen[i] == ASIDE and i in tree.by_id and named[i] and held[i] == PLAIN:
            tree.seen[i] = PLAIN
        elif tag and tree.seen[i] == PLAIN:
            tree.seen[i] = held[i]


def nameless(tree: Tree) -> Tree:
    """The same tree as it would be seen without any names."""
    seen = [held if tag else own for tag, own, held in zip(tree.tag, tree.seen, contents(tree))]
    return Tree(tree.parent, ["div" if tag else "" for tag in tree.tag], seen, tree.text)


def _free_wrappers(tree: Tree) -> None:
    """Elements with a boilerplate cue that are around the article lose it."""
    size = len(tree.parent)
    if ASIDE not in tree.seen:
        return
    # Below and at every node: text, long text, the most long text of a main element, main elements by tag, headings.
    every, long, most, named, heads = ([0] * size for _ in range(5))
    for i in range(size - 1, -1, -1):
        if not tree.tag[i]:
            every[i] = len(tree.text[i])
            if tree.seen[i] >= 4 and not tree.seen[i] % 2:
                long[i] = every[i]
        heads[i] += tree.tag[i] == "h1"
        if i:
            above = tree.parent[i]
            every[above] += every[i]
            long[above] += long[i]
            heads[above] += heads[i]
            main = tree.tag[i] in MAIN_TAGS and tree.seen[i] == MAIN
            most[above] = max(most[above], most[i], long[i] if main else 0)
            named[above] += named[i] + main
    if not long[0]:
        long = every
    within = [0] * size  # main elements by tag that are around a node
    cued = [False] * size  # whether a main or boilerplate element is around it
    for i in range(1, size):
        above = tree.parent[i]
        within[i] = within[above] + (tree.tag[above] in MAIN_TAGS and tree.seen[above] == MAIN)
        cued[i] = cued[above] or tree.seen[above] in (MAIN, ASIDE) and bool(tree.tag[above])
        if not tree.tag[i] or tree.seen[i] not in (ASIDE, MIXED):
            continue
        if named[i] == named[0] - within[i]:  # no main element apart from it
            largest = 2 * long[i] > long[0]
            if tree.tag[i] == "article" and not cued[i] and largest:
                tree.seen[i] = MAIN
            elif 2 * most[i] > long[0] or named[i] == 1 and heads[i]:
                tree.seen[i] = HOLDS
            elif largest and i not in tree.remarks and (heads[i] or 10 * every[i] >= 9 * every[0]):
                tree.seen[i] = MAIN if tree.seen[i] == MIXED else HOLDS


def labels(tree: Tree) -> list[int] | None:
    """The label of every node of a page whose markup names its article; None for other pages."""
    top = [
        i for i, tag in enumerate(tree.tag)
        if tag in MAIN_TAGS and tree.seen[i] == MAIN
    ]
    if not top:
        return None
    found, holds = [], set()
    for i in top:
        at = tree.parent[i]
        while at >= 0 and at not in holds:
            holds.add(at)
            at = tree.parent[at]
    for i, parent in enumerate(tree.parent):
        above = found[parent] if parent >= 0 else OUTSIDE
        if above == BOILERPLATE or (tree.tag[i] and tree.seen[i] == ASIDE):
            found.append(BOILERPLATE)
        elif above == CONTENT or (tree.tag[i] in MAIN_TAGS and tree.seen[i] == MAIN):
            found.append(CONTENT)
        else:
            found.append(OUTSIDE if i in holds or parent < 0 else BOILERPLATE)
    return found


@dataclass(frozen=True)
class Potentials:
    """edge[parent label][label], the same to elements with a boilerplate cue, cue[label][cue] and block[label][bucket]."""

    edge: tuple[tuple[float, ...], ...]
    aside: tuple[tuple[float, ...], ...]
    cue: tuple[tuple[float, ...], ...]
    block: tuple[tuple[float, ...], ...]


# Shares before any page is seen, by label; 0 rules a combination out.
PRIOR_EDGE = ((0.4, 0.3, 0.3), (0.0, 0.9, 0.1), (0.0, 0.001, 0.999))
PRIOR_ASIDE = ((0.02, 0.01, 0.97), (0.0, 0.02, 0.98), (0.0, 0.001, 0.999))
PRIOR_CUE = (
    (0.8, 0.05, 0.0, 0.01, 0.01, 0.06, 0.07), (0.528, 0.4, 0.0, 0.01, 0.002, 0.02, 0.04),
    (0.15, 0.05, 0.5, 0.0298, 0.0002, 0.17, 0.1),
)
PRIOR_BLOCK = tuple(
    tuple(weights[b // 2] * (linked if b % 2 else 1 - linked) for b in range(BUCKETS))
    for weights, linked in (((0.4, 0.3, 0.2, 0.1), 0.5), ((0.1, 0.2, 0.3, 0.4), 0.1), ((0.4, 0.3, 0.2, 0.1), 0.5))
)
# How much the counts weigh against the prior, and how much a block's looks weigh against its place in the tree.
LEARNED = 0.8
LOOKS = 0.3
# The nodes inside an element with a boilerplate cue are of one kind, and together weigh as much as so many.
WITHIN = 3


def _share(counts: list[float], prior: tuple[float, ...]) -> tuple[float, ...]:
    total = sum(counts)
    if not total:
        return prior
    return tuple(LEARNED * c / total + (1 - LEARNED) * p for c, p in zip(counts, prior))


def potentials(counts: dict[tuple[str, int, int], int]) -> Potentials:
    def table(kind: str, prior: tuple[tuple[float, ...], ...]) -> tuple[tuple[float, ...], ...]:
        return tuple(
            _share([counts.get((kind, label, k), 0) for k in range(len(row))], row) for label, row in enumerate(prior)
        )

    looks = tuple(tuple(p**LOOKS for p in row) for row in table("block", PRIOR_BLOCK))
    return Potentials(table("edge", PRIOR_EDGE), table("aside", PRIOR_ASIDE), table("cue", PRIOR_CUE), looks)


def marginals(tree: Tree, known: Potentials) -> list[tuple[float, float, float]]:
    """The probability of every label at every node: messages from the blocks up, then from the root down."""
    size = len(tree.parent)
    edges = [known.aside if tag and seen == ASIDE else known.edge for tag, seen in zip(tree.tag, tree.seen)]
    belief = []
    for tag, seen in zip(tree.tag, tree.seen):
        if tag and seen == ASIDE:  # the cue is in the edge
            belief.append([1.0, 1.0, 1.0])
        elif tag:
            belief.append([row[seen] for row in known.cue])
        else:  # a block is content or not
            belief.append([0.0, known.block[CONTENT][seen], known.block[BOILERPLATE][seen]])
    around = [-1] * size  # the element with a boilerplate cue that a node is in, unless in a main element there
    for i in range(1, size):
        above = tree.parent[i]
        around[i] = above if tree.tag[above] and tree.seen[above] == ASIDE else around[above]
        if tree.tag[i] and tree.seen[i] == MAIN:
            around[i] = -1
    inside = Counter(around)
    for i, place in enumerate(around):
        if place >= 0 and inside[place] > WITHIN:
            belief[i] = [x ** (WITHIN / inside[place]) if x else 0.0 for x in belief[i]]
    upward: list[tuple[float, float, float]] = [(1.0, 1.0, 1.0)] * size
    for i in range(size - 1, 0, -1):
        a, b, c = belief[i]
        message = tuple(row[0] * a + row[1] * b + row[2] * c for row in edges[i])
        scale = max(message)
        upward[i] = message = tuple(m / scale for m in message)
        above = belief[tree.parent[i]]
        scale = max(x * m for x, m in zip(above, message)) or 1.0
        for k in range(3):
            above[k] = above[k] * message[k] / scale
    root = belief[0]
    root[CONTENT] = root[BOILERPLATE] = 0.0
    found: list[tuple[float, float, float]] = []
    for i in range(size):
        if i:
            above = found[tree.parent[i]]
            # What the parent believes without this child's own message.
            rest = [p / m if m else 0.0 for p, m in zip(above, upward[i])]
            edge = edges[i]
            down = [rest[0] * edge[0][k] + rest[1] * edge[1][k] + rest[2] * edge[2][k] for k in range(3)]
            joint = [d * x for d, x in zip(down, belief[i])]
        else:
            joint = root
        total = sum(joint)
        found.append(tuple(j / total for j in joint) if total else (0.0, 0.0, 1.0))
    return found


def main_text(html: str, known: Potentials) -> str:
    tree = parse(html)
    found = marginals(tree, known)
    return " ".join(text for text, p in zip(tree.text, found) if text and p[CONTENT] > 0.5)


def _count_labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for batch in batches:
        for html in batch["html"]:
            tree = parse(html)
            known = labels(tree)
            if known is None:
                continue
            for version in (tree, nameless(tree)):
                for i, (label, seen) in enumerate(zip(known, version.seen)):
                    counts["cue" if tree.tag[i] else "block", label, seen] += 1
                    if i:
                        named = tree.tag[i] and seen == ASIDE
                        counts["aside" if named else "edge", known[tree.parent[i]], label] += 1
    yield pd.DataFrame([(*key, n) for key, n in counts.items()], columns=["kind", "label", "seen", "n"])


def train(pages: DataFrame, sample: int = SAMPLE) -> Potentials:
    """Potentials from the pages of a bounded sample that name their article."""
    chosen = pages.select("page_id", whole(F.col("html")).alias("html"))
    ids = chosen.select("page_id").where("page_id IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    # At most ``sample`` ids.
    rows = chosen.join(F.broadcast(ids), "page_id").select("html")
    counted = rows.mapInPandas(_count_labelled, "kind string, label int, seen int, n long")
    found = counted.groupBy("kind", "label", "seen").agg(F.sum("n").alias("n")).collect()
    return potentials({(r["kind"], r["label"], r["seen"]): r["n"] for r in found})


def extract(pages: DataFrame, known: Potentials | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    known = known or train(pages)

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(html, known) for html in batch], dtype="object")

    text = F.pandas_udf(texts, "string")(whole(F.col("html")))
    return pages.select("page_id", "url", text.alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
