"""Byte-level BPE by a monoid reduction over a balanced tree.

Encodings of neighbouring strings are joined to that of the whole, so a string is cut in halves until
its parts are single tokens, and results are joined up the tree. Two facts bound what a join looks at:

- Tokens (inside a match of the pattern): a sequence of tokens is the encoding of its bytes if and only if each pair
  of neighbours is the encoding of its own bytes (every token of the vocabulary encodes to itself, which
  ``Vocabulary.check`` tests). So a join re-encodes a window around the boundary. If its first token
  is the one that was there before, or the window has reached the left end, everything before stays, as all its
  pairs are unchanged; likewise on the right. Else the window doubles on that side.
- Matches of the pattern (in a text): a match depends on what follows its start, and looks at most one character
  beyond its end or three beyond its start. Matches of a left half that looked at nothing beyond its end
  stay. From there on text is matched anew until a match ends where one of the right half ended.
  Matching goes on from there as it did in the right half, so all after it stays.

Texts are cut where no match can cross (after a word, before a blank), which makes the last join free;
between such places, or where there is none, halves are joined as above. Decoding joins the bytes of
halves up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import table, text_slices

_LEAF = 1 << 14  # characters of a text that are matched in one go
_KNOWN = 300_000  # words (and pairs of tokens, and parts of words) that a worker remembers, twice
_NONE = 1 << 60  # rank of what is no token
_SMALL = 64  # bytes of a window that are merged by plain search, and characters of a word that is remembered
_PART = 8  # bytes of a part of a word that is remembered
# A place that no match crosses: words hold a blank only as their first character.
_CUT = re.compile("(?<=[A-Za-z0-9.,])(?=[ \n])")
# Characters on whose kind (letter, number, blank) all libraries agree; others take the slower matcher.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_OTHER = re.compile("[^\n\t\x20-\x7e¡-¬®-ɏ]")
_PLAIN = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)


class _Remembered(dict):
    """Values of a function, in two generations: what is used again stays when the older one is dropped."""

    def __init__(self, compute: Callable):
        self.compute, self.old = compute, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(self) >= _KNOWN:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Vocabulary:
    """Ranks of a tiktoken file, and what is needed to encode and decode with them."""

    def __init__(self, path: str | None = None, pattern: str | None = None):
        import public_tokenizers
        import regex

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.decimal = [str(k).encode() for k in range(len(self.tokens))]
        self.plain = pattern is None or pattern == public_tokenizers.PATTERN
        self.pattern = regex.compile(pattern or public_tokenizers.PATTERN)
        self.words = _Remembered(lambda word: self.encode_match(word.encode("utf-8")))
        self.parts = _Remembered(self._halves)
        self.pairs = _Remembered(lambda pair: self.merge(self.tokens[pair >> 32] + self.tokens[pair & 0xFFFFFFFF]))

    def check(self) -> bool:
        """Whether every token encodes to itself, which joins rest on."""
        return all(self.merge(token) == (rank,) for token, rank in self.ranks.items())

    # bytes of one match

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Merges the pair of the lowest rank, the first of several, until no pair is a token."""
        if len(data) > _SMALL:
            return self._merge_large(data)
        get = self.ranks.get
        ends = list(range(1, len(data) + 1))  # of the parts
        pairs = [get(data[k : k + 2], _NONE) for k in range(len(data) - 1)]  # ranks of parts k and k + 1 together
        while pairs and (least := min(pairs)) < _NONE:
            k = pairs.index(least)
            del pairs[k], ends[k]
            begin = ends[k - 1] if k else 0
            if k < len(pairs):
                pairs[k] = get(data[begin : ends[k + 1]], _NONE)
            if k:
                pairs[k - 1] = get(data[ends[k - 2] if k > 1 else 0 : ends[k]], _NONE)
        return tuple([self.ranks[data[a:b]] for a, b in zip([0, *ends], ends)])

    def _merge_large(self, data: bytes) -> tuple[int, ...]:
        """The same with a heap of pairs over linked parts."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # of the part that starts here; 0 if none does
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def push(a: int) -> None:
            if a >= 0 and end[a] < n and (rank := ranks.get(data[a : end[end[a]]])) is not None:
                heapq.heappush(heap, (rank, a, end[end[a]]))

        for k in range(n - 1):
            push(k)
        while heap:
            _, a, stop = heapq.heappop(heap)
            b = end[a]
            if not b or b >= n or end[b] != stop:
                continue  # one of the two has been merged since
            end[a], end[b] = stop, 0
            if stop < n:
                before[stop] = a
            push(before[a])
            push(a)
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k : end[k]]])
            k = end[k]
        return tuple(out)

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Encoding of two encodings' bytes one after the other."""
        if not left or not right:
            return left or right
        a = b = 1
        middle = self.pairs[left[-1] << 32 | right[0]]
        while True:
            left_stable = a == len(left) or middle[0] == left[-a]
            right_stable = b == len(right) or middle[-1] == right[b - 1]
            if left_stable and right_stable:
                return left[:-a] + middle + right[b:]
            a = a if left_stable else min(2 * a, len(left))
            b = b if right_stable else min(2 * b, len(right))
            middle = self.merge(b"".join(map(self.tokens.__getitem__, left[-a:] + right[:b])))

    def _halves(self, data: bytes) -> tuple[int, ...]:
        half = len(data) // 2
        return self.join(self.encode_match(data[:half]), self.encode_match(data[half:]))

    def encode_match(self, data: bytes) -> tuple[int, ...]:
        """Ids of one match of the pattern: halves, joined."""
        rank = self.ranks.get(data)
        if rank is not None:
            return (rank,)
        return self.parts[data] if 0 < len(data) <= _PART else self._halves(data) if data else ()

    # matches of a text

    def _matches(self, text: str) -> list[str]:
        if self.plain and not _OTHER.search(text):
            return _PLAIN.findall(text)
        return [m[0] for m in self.pattern.finditer(text)]

    def matches(self, text: str) -> list[str]:
        """All matches of the pattern, which cover the text."""
        if len(text) <= _LEAF:
            return self._matches(text)
        half = len(text) // 2
        cut = _CUT.search(text, half, half + 4096) if self.plain else None
        if cut:
            return self.matches(text[: cut.start()]) + self.matches(text[cut.start() :])
        return self._join_matches(text, self.matches(text[:half]), self.matches(text[half:]), half)

    def _join_matches(self, text: str, left: list[str], right: list[str], half: int) -> list[str]:
        """Matches of a text, given those of its halves."""
        keep, at = len(left), half  # ``at``: where match number keep - 1 ends
        while keep and max(at + 1, at - len(left[keep - 1]) + 3) > half:  # it may have looked beyond the half
            keep -= 1
            at -= len(left[keep])
        middle, done, end = [], 0, half  # ``end``: where the right half's match before number ``done`` ends
        for m in self.pattern.finditer(text, at):
            middle.append(m[0])
            at = m.end()
            while done < len(right) and end < at:
                end += len(right[done])
                done += 1
            if end == at and at >= half:
                break
        return left[:keep] + middle + right[done:]

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        matches = self.matches(text)
        if max(map(len, matches), default=0) <= _SMALL:
            return list(chain.from_iterable(map(self.words.__getitem__, matches)))
        found = (self.words[m] if len(m) <= _SMALL else self.encode_match(m.encode("utf-8")) for m in matches)
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids: those of the halves one after the other."""
        if len(ids) <= _LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def digest(self, ids: list[int]) -> str:
        """SHA-256 of the ids in decimal, joined by one space."""
        return hashlib.sha256(b" ".join(map(self.decimal.__getitem__, ids))).hexdigest()


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """The worker's vocabulary: later tasks find the words of earlier ones."""
    return Vocabulary(path, pattern)


def encode(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(doc_id, ids array<int>) for each row of ``docs``.

    Null and empty texts have no ids. Repeated rows come out as often as they are there, null ids stay
    null, an empty table gives an empty table; other columns are not read, so their names cannot clash. ``path`` names a
    file of ranks that every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path, pattern)
        for part, texts in text_slices(batches):
            ids = [known.encode(t.decode()) if t else [] for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, data binary) of (doc_id, ids): null ids give null, no ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            data = [None if ids is None else known.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of (doc_id, text), in one pass.

    The same as digests of :func:`encode` and :func:`decode`, without ids and bytes leaving the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for part, texts in text_slices(batches):
            n, ids_sha, data_sha = [], [], []
            for text in texts:
                ids = known.encode(text.decode()) if text else []
                n.append(len(ids))
                ids_sha.append(known.digest(ids))
                data_sha.append(hashlib.sha256(known.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(data_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
