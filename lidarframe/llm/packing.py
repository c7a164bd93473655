"""Packing of tokenised documents into sequences by exact complements, then best fit.

Only the number of pieces of each length matters for the plan, at most as many numbers as a
sequence has tokens. The plan is a list of patterns (lengths that share a sequence) with how often
each is used, made from these counts: sums of two and of three lengths are indexed; from the longest length
down, the gap is looked up among single lengths, pairs and triples, and a combination that fills it exactly is used
as often as there are pieces for it. What stays is packed by best fit, longest first. Pieces are numbered
within their length and look up their place in the plan, so the corpus is read once and only light
rows are shuffled.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lidarframe.llm.common import materialise, named, table, text_slices

CAPACITY = 1024
END_ID = 2
_CACHED = 600_000  # words whose ids a worker remembers, in two generations
_HELD = 16 << 20  # characters of the words of a generation
_JOINED = 512  # new words that are encoded as one text
_BLOCK = 1 << 16  # characters of a text that are split into words together
_GROUP = 1 << 20  # characters of blocks whose new words are encoded together
# A place between two words whatever is around it: words hold a blank only as their first character.
_CUT = re.compile("(?<=[A-Za-z0-9.,])(?=[ \n])")
# Blocks of other characters are encoded whole: tables of letters and spaces differ between libraries.
_OTHER = re.compile("[^\n\t\x20-\x7e¡-¬®-ɏ]")
# The split before the merges (public_tokenizers.PATTERN), with the letters and numbers of these characters.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_WORDS = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)


def blocks(text: str) -> Iterator[str]:
    """Parts of a text of about _BLOCK characters that cut no word in two."""
    start = 0
    while len(text) - start > _BLOCK and (gap := _CUT.search(text, start + _BLOCK)):
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:]


class Encoder:
    """Texts to their ids as little-endian bytes, 32 bits each. A word's ids do not depend on its
    neighbours, so each different word is encoded once."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]

    def _encode_joined(self, words: list[str]) -> list[bytes]:
        """Ids of words of a blank and letters: one text, a line for each, as a line break before a blank is a word."""
        out: list[bytes] = []
        for start in range(0, len(words), _JOINED):
            part = words[start : start + _JOINED]
            (found,) = self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)
            ids = np.asarray(found.ids, "<u4")
            cuts = 4 * np.flatnonzero(ids == self.line_break)
            if len(cuts) + 1 != len(part):  # the tokenizer sees other words
                out += self._encode(part)
                continue
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)])]
        return out

    def many(self, texts: list[str]) -> list[bytes]:
        found: list[list[bytes]] = [[] for _ in texts]
        group: list[tuple[int, str]] = []
        size = 0
        for k, text in enumerate(texts):
            for block in blocks(text):
                group.append((k, block))
                size += len(block)
                if size >= _GROUP:
                    self._add(group, found)
                    group, size = [], 0
        self._add(group, found)
        return [b"".join(parts) for parts in found]

    def _add(self, group: list[tuple[int, str]], found: list[list[bytes]]) -> None:
        """Appends the ids of each block of a group to those of its text."""
        words = [None if "<|" in block or _OTHER.search(block) else _WORDS.findall(block) for _, block in group]
        known = self.young.get
        ids = [list(map(known, w or ())) for w in words]
        # ids are never empty, so what counts as false is missing
        missing = {x for w, d in zip(words, ids) if w and not all(d) for x, y in zip(w, d) if not y}
        if missing:
            if len(self.young) > _CACHED or self.held > _HELD:  # what this group uses of the older words stays
                self.old, self.young, self.held = self.young, {}, 0
                missing = set().union(*filter(None, words))
            self.held += sum(map(len, missing))
            again = missing & self.old.keys()
            self.young.update((w, self.old[w]) for w in again)
            new = missing - again
            spaced = [w for w in new if w[0] == " " and w[1:].isalpha()]
            self.young.update(zip(spaced, self._encode_joined(spaced)))
            rest = list(new.difference(spaced))
            self.young.update(zip(rest, self._encode(rest)))
        get = self.young.__getitem__
        for (k, block), w, d in zip(group, words, ids):
            if w is None:
                found[k].append(self._encode([block])[0])
            else:
                found[k].append(b"".join(d if all(d) else [y or get(x) for x, y in zip(w, d)]))

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


@lru_cache(maxsize=1)
def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder: later tasks find the words of earlier ones."""
    return Encoder(path)


_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, chunk int, number long"


def tokenised_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, chunk, number) of (doc_id, text); number counts the
    pieces of a length in a chunk, which is what one task has read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, chunk, seen = encoder(path), TaskContext.get().partitionId(), Counter()
        end = np.asarray([END_ID], "<u4").tobytes()
        for part, texts in text_slices(batches):
            rows = []
            ids = encode.many([t.decode() if t else "" for t in texts])
            for doc, data in zip(part.column("doc_id").to_pylist(), ids):
                data += end
                total = len(data) // 4
                start, piece = 0, 0
                stop = total % capacity or capacity
                while start < total:
                    length = stop - start
                    rows.append(
                        (doc, piece, start, length, zlib.crc32(data[4 * start : 4 * stop]), chunk, seen[length])
                    )
                    seen[length] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            if rows:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                names = [c.split()[0] for c in _PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.mapInArrow(run, _PIECES)


class Pattern(NamedTuple):
    lengths: list[int]
    times: int


class Complements:
    """Index of the sums of one, two and three lengths, of which pieces are left.

    ``pairs[s]`` has the longer lengths of all pairs with sum s in ascending order, ``triples[s]`` the longest
    lengths of triples. What has been used up is struck off when a search meets it: numbers of pieces only
    fall, so it never comes back.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        size = len(left)
        there = np.flatnonzero(left).tolist()
        self.pairs: list[list[int]] = [[] for _ in range(size)]
        for longer in there:
            for shorter in there:
                if shorter > longer or longer + shorter >= size:
                    break
                self.pairs[longer + shorter].append(longer)
        self.triples: list[list[int]] = [[] for _ in range(size)]
        sums = [s for s in range(size) if self.pairs[s]]
        for first in there:
            for s in sums:
                if first + s >= size:
                    break
                if self.pairs[s][0] <= first:  # the most even pair
                    self.triples[first + s].append(first)

    def _there(self, lengths: list[int], taken: list[int] = ()) -> bool:
        all_taken = [*lengths, *taken]
        return all(self.left[n] >= all_taken.count(n) for n in lengths)

    def _pair(self, total: int, most: int, taken: list[int]) -> list[int] | None:
        """The pair with the longest length of at most ``most``."""
        longer = self.pairs[total]
        k = bisect_right(longer, most) - 1
        while k >= 0:
            pair = [longer[k], total - longer[k]]
            if self._there(pair, taken):
                return pair
            if not self._there(pair):
                del longer[k]
            k -= 1
        return None

    def find(self, gap: int, taken: list[int]) -> list[int] | None:
        """Lengths with sum ``gap``, besides pieces of the lengths ``taken``; few before many, long before short."""
        if self._there([gap], taken):
            return [gap]
        if pair := self._pair(gap, gap, taken):
            return pair
        firsts = self.triples[gap]
        for k in range(len(firsts) - 1, -1, -1):
            first = firsts[k]
            if not self.left[first] or not self.pairs[gap - first]:
                del firsts[k]
            elif self._there([first], taken) and (pair := self._pair(gap - first, first, [*taken, first])):
                return [first, *pair]
        return None


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use every length exactly as often as it is there, and hold at most ``capacity``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    patterns = [Pattern([capacity], int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    index = Complements(left)
    for longest in range(capacity - 1, 0, -1):
        # lengths that found no complement stay without one, so none above ``longest`` is met
        while left[longest] and (others := index.find(capacity - longest, [longest])):
            need = Counter([longest, *others])
            times = min(int(left[length]) // n for length, n in need.items())
            for length, n in need.items():
                left[length] -= n * times
            patterns.append(Pattern([longest, *others], times))
    return patterns + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit, longest first; equal sequences are handled together."""
    groups: dict[int, list[Pattern]] = defaultdict(list)  # by gap
    is_open = np.zeros(capacity + 1, bool)

    def add(lengths: list[int], times: int, gap: int) -> None:
        if times:
            groups[gap].append(Pattern(lengths, times))
            is_open[gap] = True

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gaps = np.flatnonzero(is_open[length:])
            if gaps.size:
                gap = length + int(gaps[0])
                group = groups[gap].pop()
                is_open[gap] = bool(groups[gap])
            else:
                gap, group = capacity, Pattern([], -(-n // (capacity // length)))
            each = gap // length
            full = min(group.times, n // each)
            rest = n - full * each if full < group.times else 0
            add(group.lengths + [length] * each, full, gap - each * length)
            if rest:
                add(group.lengths + [length] * rest, 1, gap - rest * length)
            add(group.lengths, group.times - full - bool(rest), gap)
            n -= full * each + rest
    return [p for found in groups.values() for p in found]


def places(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first numbers of ranges of pieces, the sequence of a range's first piece, the offset."""
    used, found, base = Counter(), defaultdict(list), 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            found[length].append((used[length], base, offset))
            used[length] += times
            offset += length
        base += times
    return {k: tuple(np.asarray(c, np.int64) for c in zip(*v)) for k, v in found.items()}


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row.

    A row's tokens are the ids of its text and an end id; null and empty texts are the end id alone.
    More than ``capacity`` tokens are cut into pieces of that length, of which the first may be shorter.
    Repeated rows are packed as often as they are there; a null doc_id stays null; an empty
    table gives an empty table; other columns are not read. ``path`` names the tokenizer's file.
    """
    rows = docs.select(named(id_column).cast("long").alias("doc_id"), named(text_column).alias("text"))
    pieces = materialise(tokenised_pieces(rows, path, capacity), "pieces")
    counts = materialise(pieces.groupBy("length", "chunk").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = places(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("before")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                first, base, begin = where[n]
                k = np.searchsorted(first, number[at], "right") - 1
                sequence[at] = base[k] + number[at] - first[k]
                offset[at] = begin[k]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = pieces.join(offsets, ["length", "chunk"]).select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("before") + F.col("number")).alias("number"),
    )
    return numbered.mapInArrow(
        run,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
