"""Packing: minimum bin slack over the lengths of pieces.

A document is its token ids and the end id 0. It is cut at multiples of the window; what is left over is a piece of its
own. Windows are filled from the counts per length: a subset-sum over a bit set finds the fullest window that the
remaining lengths allow, the lengths it takes are traced back, and the pattern is used as often as their counts last.
Only the counts, at most one per length up to the window, and the patterns come to the driver. Pieces are numbered by
length once (range partitions, so a length that a third of all pieces have is spread over many), and the number tells
pattern, window and place.

NULL and empty texts are the end id alone; repeated rows are packed like any others; columns besides ``doc_id`` and
``text`` are not looked at; an empty table gives no piece.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..sources.folders import Scratch
from .common import whole, worker_memory

WINDOW = 1024
END = 0
# Words a Python worker remembers the ids of, if a slice has them so many times; beyond it the memory starts anew.
REMEMBERED = 150_000
REPEATED = 3
LONGEST_REMEMBERED = 48
# Bytes of text whose distinct words are looked for together, words that are Python strings at a time, and words whose ids
# are put into texts at a time.
SLICE = 8_000_000
WORDS_AT_ONCE = 20_000
GATHERED = 200_000

# Signs that the splitting expression keeps together (an apostrophe may begin a part of its own).
SIGNS = ".,;:!?#*$%&|<>()[]{}/+=@^~_\"-"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_signs() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit numbers.

    The byte-level vocabulary never joins across a blank or a line feed that stands alone between two other characters,
    so such texts are the ids of their words one after the other, and each distinct word of a batch is encoded once. A
    text with any other white space next to a blank or line feed is encoded as a whole. The splitting expression takes a
    run of letters and a run of signs apart and nothing else, so those go to the vocabulary's merges as they are.

    Splitting and finding the distinct words is Arrow's work. From batch to batch only short words are kept that a batch
    repeats, and no more than REMEMBERED of them, as several workers share an executor's memory.
    """

    def __init__(self, path: str):
        # One task, one core: Spark runs as many tasks as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # A normalizer or an added token that is not special may change words: then all texts are encoded as a whole.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.by_words = self.tokenizer.normalizer is None and all(token.special for token in added)
        self.signs = _byte_signs()
        self.line_feed = self._encode(["\n"])[0]
        # Words behind a blank or a line feed.
        self.known: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _run(self, run: str) -> bytes:
        """Ids of a run of letters, with or without a blank before it, or of a run of signs."""
        # Without hidden bytes but the blank, ASCII stands for itself.
        shown = run.replace(" ", self.signs[32]) if run.isascii() else run.encode().decode("latin-1").translate(self.signs)
        return array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()

    def _words(self, words: list[str], before: str) -> list[bytes | None]:
        """Ids of each word and the blank before it; None where white space touches that blank or line feed."""
        found: list[bytes | None] = []
        tails: dict[str, bytes] = {}
        other = []
        for word in words:
            if word.isalpha():
                found.append(self._run(before + word))
                continue
            broken = word[:1] == "\n"
            bare = word[1:] if broken else word
            if not bare or bare[0].isspace() or bare[-1].isspace():
                found.append(None)
                continue
            head = bare.rstrip(SIGNS)
            if not head.isalpha():
                other.append((len(found), word if broken else before + word))
                found.append(None)
                continue
            ids, tail = self.line_feed + self._run(head) if broken else self._run(before + head), bare[len(head) :]
            if tail and tail not in tails:
                tails[tail] = self._run(tail)
            found.append(ids + tails[tail] if tail else ids)
        if other:
            for (at, _), ids in zip(other, self._encode([text for _, text in other])):
                found[at] = ids
        return found

    def _remembered(self, words: list[str], repeated: list[bool]) -> list[bytes | None]:
        """Ids of distinct words behind a blank; the repeated ones are remembered."""
        found = [self.known.get(word) for word in words]
        new = [k for k, ids in enumerate(found) if ids is None]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        for k, ids in zip(new, self._words([words[k] for k in new], " ")):
            found[k] = ids
            if ids is not None and repeated[k] and len(words[k]) <= LONGEST_REMEMBERED:
                self.known[words[k]] = ids
        return found

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text, in order; no text may be NULL."""
        if not self.by_words:
            yield from (self._encode([text.as_py()])[0] for text in texts)
            return
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends = np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1]])
        flat = split.flatten()
        first = self._words(_strings(flat.take(pa.array(begins))), "")
        coded = flat.dictionary_encode()
        del split, flat
        codes, n = coded.indices.to_numpy().copy(), len(coded.dictionary)
        # The word that begins a text has no blank before it, so it gets a code of its own.
        codes[begins] = np.arange(n, n + len(texts))
        times = np.bincount(codes, minlength=n)[:n]
        lengths, whole_ids = np.zeros(n + len(texts), dtype=np.int64), []
        apart = np.zeros(n + len(texts), dtype=bool)

        def add(at: np.ndarray, found: list[bytes | None]) -> None:
            lengths[at] = [len(ids or b"") // 4 for ids in found]
            apart[at] = [ids is None for ids in found]
            whole_ids.append(b"".join([ids or b"" for ids in found]))

        asked = np.flatnonzero(times)
        for k in range(0, len(asked), WORDS_AT_ONCE):
            these = asked[k : k + WORDS_AT_ONCE]
            words = _strings(coded.dictionary.take(pa.array(these)))
            add(these, self._remembered(words, (times[these] >= REPEATED).tolist()))
        add(np.arange(n, n + len(texts)), first)
        of_codes, places = np.frombuffer(b"".join(whole_ids), dtype="<u4"), np.cumsum(lengths) - lengths
        del coded, whole_ids

        at = 0
        while at < len(texts):
            # As many texts as have GATHERED words, one at least.
            following = max(at + 1, int(np.searchsorted(ends, begins[at] + GATHERED, side="right")))
            own = codes[begins[at] : ends[following - 1]]
            each = lengths[own]
            upto = np.cumsum(each)
            ids = of_codes[np.repeat(places[own] - (upto - each), each) + np.arange(upto[-1])].tobytes()
            whole_text = np.logical_or.reduceat(apart[own], begins[at:following] - begins[at]).tolist()
            bounds = [0, *(4 * upto[ends[at:following] - begins[at] - 1]).tolist()]
            for k, encode in enumerate(whole_text):
                yield self._encode([texts[at + k].as_py()])[0] if encode else ids[bounds[k] : bounds[k + 1]]
            at = following

    def ids(self, text: str) -> bytes:
        return next(self.batch(pa.array([text], pa.string())))


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of slices with about SLICE bytes of text; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    at = 0
    while at < len(ends):
        limit = SLICE + (ends[at - 1] if at else 0)
        following = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield at, following - at
        at = following


def pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: PIECES, and their ids as little-endian bytes if wanted."""
    path = tokenizer or default_tokenizer()
    end = np.asarray([END], dtype="<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = worker_memory()
        encoder = memory["encoder", path] = memory.get(("encoder", path)) or Encoder(path)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            for first, n in _slices(texts):
                rows, parts = [], []
                for at, ids in enumerate(encoder.batch(texts.slice(first, n)), first):
                    ids += end
                    tokens = len(ids) // 4
                    for start in range(0, tokens, window):
                        part = ids[4 * start : 4 * (start + window)]
                        rows.append((at, start, len(part) // 4, zlib.crc32(part), tokens))
                        if with_ids:
                            parts.append(part)
                at, *numbers = (pa.array(column) for column in np.array(rows, dtype=np.int64).T.copy())
                columns = [doc_ids.take(at), *numbers]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                # What Arrow holds for a slice goes back, before it is held for the next one.
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays(columns, [*names, *["ids"] * with_ids])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


@dataclass(frozen=True)
class Pattern:
    """One way to fill a window: how many pieces of each length, and how many windows are filled like this."""

    lengths: tuple[tuple[int, int], ...]
    windows: int


def fullest(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset of the given lengths with the largest sum up to the window, longer lengths first among equals."""
    full = (1 << (window + 1)) - 1
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, size = min(counts[length], window // length), 1
        while left:  # 1, 2, 4, ... pieces: any number up to the count is a sum of some of these
            take = min(size, left)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & full
            left, size = left - take, size * 2
            if sums >> window:
                break
        if sums >> window:
            break
    at, taken = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:  # this sum needs the step
            at -= length * take
            taken[length] = taken.get(length, 0) + take
    return taken


def patterns(counts: dict[int, int], window: int = WINDOW) -> list[Pattern]:
    """Window patterns that use up all pieces; each window is the fullest that what is left allows.

    The longest length left is always part of the next window, so that each pattern settles at least one window of it.
    """
    left = {length: n for length, n in counts.items() if n}
    found = []
    while left:
        longest = max(left)
        rest = {length: n - (length == longest) for length, n in left.items() if length <= window - longest}
        taken = fullest({length: n for length, n in rest.items() if n}, window - longest) if longest < window else {}
        taken[longest] = taken.get(longest, 0) + 1
        windows = min(left[length] // n for length, n in taken.items())
        found.append(Pattern(tuple(sorted(taken.items(), reverse=True)), windows))
        for length, n in taken.items():
            left[length] -= n * windows
            if not left[length]:
                del left[length]
    return found


def placements(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, per_window, sequence, offset) by number of the piece, pieces numbered from 0 by length."""
    following, at = {}, 0
    for length in sorted(counts):
        following[length], at = at, at + counts[length]
    sequence, rows = 0, []
    for pattern in patterns(counts, window):
        offset = 0
        for length, n in pattern.lengths:
            last = following[length] + n * pattern.windows
            rows.append((length, following[length], last, n, sequence, offset))
            following[length], offset = last, offset + n * length
        sequence += pattern.windows
    return rows


def pack(cut: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces; sequences are numbered from 0."""
    kept = scratch.keep(cut, "pieces")
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}
    order = [F.col("length"), F.xxhash64("doc_id", "start"), F.col("doc_id"), F.col("start")]
    numbered = number_rows(kept.select("length", "doc_id", "start", "ids_crc32", "doc_tokens",
                                       *(["ids"] if "ids" in kept.columns else [])), order, "_number", scratch)
    # A few rows per pattern, and at most as many patterns as lengths and windows' worth of lengths.
    places = cut.sparkSession.createDataFrame(
        placements(counts, window),
        "_length long, _first long, _last long, _n long, _sequence long, _offset long",
    )
    rank = F.col("_number") - 1 - F.col("_first")
    here = (F.col("length") == F.col("_length")) & (F.col("_number") > F.col("_first")) & (F.col("_number") <= F.col("_last"))
    return numbered.join(F.broadcast(places), here).select(
        *cut.columns,
        (F.col("_sequence") + F.floor(rank / F.col("_n"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + rank % F.col("_n") * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences of pieces packed with their ids: sequence_id, n_tokens and ids as little-endian bytes."""
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    empty = F.lit(b"")
    whole_ids = F.aggregate(joined, empty, lambda ids, piece: F.concat(ids, piece["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), whole_ids.alias("ids"))
