"""Language of the words of a text by a linear-chain conditional random field.

Every word has a label. Its features are the word itself, its first and last letters, and its
n-grams of letters, hashed into a table of learned weights; transitions between the labels of
neighbours are learned as well. The field is trained on code-switched word sequences: stretches of
labelled texts in several languages, joined at random places, so both the labels of words and
the transitions are known. A text is labelled by forward-backward over blocks of ``BLOCK`` words
(all words of it); its language is the label with the largest sum of word probabilities, and this sum's
share is the score.

The field is fitted on the driver from at most ``PER_LANGUAGE`` texts of every language, fewer of each if there
are many languages, and ``STRETCH`` words of each text; labelling is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lidarframe.llm.common import crc_text, materialise, named, table, text_slices

PER_LANGUAGE = 1000
ALL_LANGUAGES = 16_000  # texts of all languages, but LEAST of each in any case
LEAST = 16
MAX_LANGUAGES = 400  # the driver fits 1.5 MB of weights and steps for each; more is an error
STRETCH = 96
SEQUENCE = 64  # words of a training sequence
SWITCH = 16  # words between two switches, on average
TABLE = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd number without pattern
ROUNDS = 60
BLOCK = 256  # words that are labelled together
UNKNOWN = "und"
_CACHED = 200_000
_CELLS = 1 << 22  # label probabilities that training holds at once
_LONGEST = 24  # letters of a word; longer ones are cut
_WORD = re.compile(r"[^\W\d_]+")
# letters of scripts without blanks: Thai, Lao, Myanmar, Khmer, kana, Han
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_PIECE = re.compile(f"[{_UNSPACED}]{{1,4}}|[^{_UNSPACED}]{{1,{_LONGEST}}}")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; in order, all letters are in one of them.

    Runs of scripts without blanks are cut into pieces of four letters, about as much as a short word says, others
    into pieces of ``_LONGEST``.
    """
    text = text.lower()
    words = _WORD.findall(text)
    if not all(map(str.isalpha, words)):  # fractions, Roman numerals, circled numbers, ... are no letters
        words = "".join(c if c.isalpha() else " " for c in text).split()
    if not text.isascii() and _HAS_UNSPACED.search(text):
        return [piece for word in words for piece in _PIECE.findall(word)]
    if max(map(len, words), default=0) <= _LONGEST:
        return words
    cuts = ((word,) if len(word) <= _LONGEST else _PIECE.findall(word) for word in words)
    return list(chain.from_iterable(cuts))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place in the table, number of the word) of all features of words, by words: the word itself (lexicon),
    its first one to three and last one to four letters, and its n-grams of one to three letters."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(letters)) - begin[owner]
    left = sizes[owner] - place
    hashes, owners = [], []

    def add(kind: int, at: np.ndarray, length: int, who: np.ndarray) -> None:
        h = np.full(len(at), kind, np.uint64)
        for k in range(length):
            h = (h + letters[at + k]) * _MIX
        hashes.append(h)
        owners.append(who)

    for n in (1, 2, 3):
        at = np.flatnonzero(left >= n)
        add(n, at, n, owner[at])
    for n in (1, 2, 3):
        who = np.flatnonzero(sizes >= n)
        add(10 + n, begin[who], n, who)
    for n in (1, 2, 3, 4):
        who = np.flatnonzero(sizes >= n)
        add(20 + n, begin[who] + sizes[who] - n, n, who)
    some = np.flatnonzero(sizes > 0)
    if some.size:
        powers = np.cumprod(np.full(int(sizes.max()), _MIX))
        hashes.append((np.add.reduceat(letters * powers[place], begin[some]) + np.uint64(30)) * _MIX)
        owners.append(some)
    found, who = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return (found[order] >> np.uint64(64 - TABLE.bit_length() + 1)).astype(np.int64), who[order]


class Field(NamedTuple):
    labels: list[str]
    weights: np.ndarray  # of features, TABLE x labels
    transitions: np.ndarray  # labels x labels, from row to column


def emissions(weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Sums of the weights of each word's features."""
    return _sums(weights, *features(words), len(words))


def _sums(weights: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weights[flat, k], n) for k in range(weights.shape[1])], 1)


def forward_backward(emission: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities (n, t, l) of equally long sequences, and summed probabilities of transitions."""
    n, steps, size = emission.shape
    e = np.exp(emission - emission.max(2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    alpha = np.empty_like(e)
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        a = (alpha[:, t - 1] @ move) * e[:, t]
        alpha[:, t] = a / a.sum(1, keepdims=True)
    beta = np.ones((n, size))
    pairs = np.zeros((size, size))
    gamma = np.empty_like(e)
    gamma[:, -1] = alpha[:, -1]
    for t in range(steps - 2, -1, -1):
        right = e[:, t + 1] * beta
        whole = ((alpha[:, t] @ move) * right).sum(1, keepdims=True)
        pairs += move * ((alpha[:, t] / whole).T @ right)
        beta = right @ move.T
        beta /= beta.sum(1, keepdims=True)
        g = alpha[:, t] * beta
        gamma[:, t] = g / g.sum(1, keepdims=True)
    return gamma, pairs


def code_switched(texts: list[tuple[str, list[str]]], seed: int = 5) -> tuple[list[list[str]], list[list[str]]]:
    """Sequences of SEQUENCE words and their labels, joined from stretches of texts (label, words)."""
    random = np.random.default_rng(seed)
    left = [(label, words, 0) for label, words in texts if words]
    words_out: list[str] = []
    labels_out: list[str] = []
    while left:
        k = int(random.integers(len(left)))
        label, words, at = left[k]
        n = int(random.geometric(1 / SWITCH))
        words_out += words[at : at + n]
        labels_out += [label] * len(words[at : at + n])
        if at + n < len(words):
            left[k] = (label, words, at + n)
        else:
            left[k] = left[-1]
            left.pop()
    cut = range(0, len(words_out) - SEQUENCE + 1, SEQUENCE) if len(words_out) >= SEQUENCE else []
    return [words_out[k : k + SEQUENCE] for k in cut], [labels_out[k : k + SEQUENCE] for k in cut]


def fit_field(texts: list[tuple[str, list[str]]], rounds: int = ROUNDS, rate: float = 0.1) -> Field:
    """Maximum likelihood with a small penalty, by gradient steps of Adam."""
    labels = sorted({label for label, words in texts if words})
    if len(labels) < 2:
        return Field(labels, np.zeros((TABLE, len(labels))), np.zeros((len(labels), len(labels))))
    while sum(len(w) for _, w in texts) < SEQUENCE:
        texts = texts + texts  # too few words for one sequence
    sequences, tags = code_switched(texts)
    known: dict[str, int] = {}
    ids = np.array([[known.setdefault(w, len(known)) for w in s] for s in sequences])
    y = np.array([[labels.index(t) for t in s] for s in tags])
    flat, owner = features(list(known))
    size = len(labels)
    truth = np.zeros((len(known), size))
    np.add.at(truth, (ids.ravel(), y.ravel()), 1)
    moves = np.zeros((size, size))
    np.add.at(moves, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    total = ids.size
    group = max(1, _CELLS // (SEQUENCE * size))
    weights, transitions = np.zeros((TABLE, size)), np.zeros((size, size))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, transitions)]
    for step in range(1, rounds + 1):
        emission = _sums(weights, flat, owner, len(known))
        excess, pairs = truth.copy(), np.zeros((size, size))
        for at in range(0, len(ids), group):
            some = ids[at : at + group]
            gamma, moved = forward_backward(emission[some], transitions)
            pairs += moved
            for k in range(size):
                excess[:, k] -= np.bincount(some.ravel(), gamma[:, :, k].ravel(), len(known))
        slope = np.stack([np.bincount(flat, excess[owner, k], TABLE) for k in range(size)], 1) / total
        gradients = (slope - 1e-6 * weights, (moves - pairs) / total - 1e-6 * transitions)
        for p, g, (m, v) in zip((weights, transitions), gradients, state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(labels, weights, transitions)


class Labeller:
    """Applies a field to texts; remembers the features' sums of words it has seen."""

    def __init__(self, field: Field):
        self.field = field
        self.size = len(field.labels)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.empty((1024, self.size))

    def _ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHED:
            self._forget()
            known = self.known
        before = len(known)
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        if len(known) > before:
            new = list(known)[before:]
            if len(known) > len(self.rows):
                grown = np.empty((2 * len(known), self.size))
                grown[:before] = self.rows[:before]
                self.rows = grown
            e = emissions(self.field.weights, new)
            self.rows[before : len(known)] = np.exp(e - e.max(1, keepdims=True))
        return ids

    def sums(self, texts: list[list[str]]) -> np.ndarray:
        """Summed label probabilities of the words of each text."""
        out = np.zeros((len(texts), self.size))
        blocks = [(d, k, min(len(w) - k, BLOCK)) for d, w in enumerate(texts) for k in range(0, len(w), BLOCK)]
        if not blocks:
            return out
        begin = np.r_[0, np.cumsum([len(w) for w in texts])]
        ids = self._ids([w for words in texts for w in words])
        blocks.sort(key=lambda b: -b[2])
        doc = np.array([b[0] for b in blocks])
        start = np.array([begin[d] + k for d, k, _ in blocks])
        length = np.array([b[2] for b in blocks])
        steps = int(length[0])
        active = [int((length > t).sum()) for t in range(steps)]
        move = np.exp(self.field.transitions - self.field.transitions.max())
        e = self.rows[ids]
        alpha = np.empty_like(e)
        a = e[start] / e[start].sum(1, keepdims=True)
        alpha[start] = a
        for t in range(1, steps):
            at = start[: active[t]] + t
            a = (a[: active[t]] @ move) * e[at]
            a /= a.sum(1, keepdims=True)
            alpha[at] = a
        total = np.zeros((len(blocks), self.size))
        beta = np.ones((len(blocks), self.size))
        for t in range(steps - 1, -1, -1):
            n = active[t]
            more = active[t + 1] if t + 1 < steps else 0
            if more:
                b = (e[start[:more] + t + 1] * beta[:more]) @ move.T
                beta[:more] = b / b.sum(1, keepdims=True)
            g = alpha[start[:n] + t] * beta[:n]
            total[:n] += g / g.sum(1, keepdims=True)
        np.add.at(out, doc, total)
        return out


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        found = []
        for text in texts:
            words = words_of(text.decode()) if text else []
            at = xxhash.xxh32_intdigest(text or b"") % max(1, len(words) - STRETCH + 1)
            found.append(words[at : at + STRETCH])
        kept = [part.column(name) for name in ("lang", "id", "h2")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(found, pa.list_(pa.string()))], ["lang", "id", "h2", "words"]
        )


def learn(docs: DataFrame, train: Column | None = None, per_language: int = PER_LANGUAGE) -> Field:
    """A field from (doc_id, text, lang) of the rows that ``train`` admits.

    Rows without id, text or language teach nothing. Texts are taken by a hash of id and text, repeated rows
    once. Every language is learned, up to MAX_LANGUAGES (more are an error); of more than ALL_LANGUAGES / per_language, from fewer texts each. One language is always predicted; none: UNKNOWN.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "lang", "text").where("doc_id is not null and lang is not null and text is not null")
    if train is not None:
        rows = rows.where(train)
    languages = rows.select("lang").distinct().count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} languages; at most {MAX_LANGUAGES} can be learned")
    per_language = min(per_language, max(LEAST, ALL_LANGUAGES // max(1, languages)))
    order = F.xxhash64("doc_id", "text")
    light = rows.select("lang", "doc_id", order.alias("h")).distinct()  # a repeated row counts once
    # the first of each of 64 parts of a language, of these the first of 8 parts, then of all: the last
    # task of a language reads at most 8 * per_language rows, however frequent it is
    for parts in (64, 8, 1):
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("h"), F.lit(parts))).orderBy("h", "doc_id")
        light = light.withColumn("k", F.row_number().over(part)).where(F.col("k") <= per_language).drop("k")
    taken = light.select(F.col("lang").alias("l2"), F.col("doc_id").alias("id"), F.col("h").alias("h2"))
    # at most per_language small rows for each language
    keys = (F.col("lang") == F.col("l2")) & (F.col("doc_id") == F.col("id")) & (order == F.col("h2"))
    some = rows.join(F.broadcast(taken), keys)
    found = some.select("lang", "id", "h2", "text").mapInArrow(
        _stretches, "lang string, id long, h2 long, words array<string>"
    )
    found = materialise(found.dropDuplicates(["lang", "id", "h2"]), "stretches").select("lang", "words")
    texts = [(r.lang, list(r.words)) for r in found.orderBy("lang", F.xxhash64("words"), "words").collect()]
    return fit_field(texts)


def predict(
    docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text", with_shares: bool = True
) -> DataFrame:
    """(doc_id, lang_pred, score, words, and, if wanted, shares map) for each row of ``docs``.

    Null texts and texts without a letter are UNKNOWN with score 0. A tie goes to the first label in
    order of names. shares has each label's part of the words. Repeated rows come out as often
    as they are there; null ids stay null; other columns are not read; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field)
        names = field.labels
        for part, texts in text_slices(batches, size=2 << 20):
            words = [words_of(t.decode()) if t else [] for t in texts]
            count = np.array([len(w) for w in words])
            if names:
                share = labeller.sums(words) / np.maximum(count, 1)[:, None]
                best = share.argmax(1)
            pred, score = [], []
            for k, n in enumerate(count):
                known = bool(n) and bool(names)
                pred.append(names[best[k]] if known else UNKNOWN)
                score.append(float(min(1.0, share[k, best[k]])) if known else 0.0)
            arrays = [part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(count, pa.int64())]
            if with_shares:
                shares = [list(zip(names, share[k].tolist())) if n and names else [] for k, n in enumerate(count)]
                arrays.append(pa.array(shares, pa.map_(pa.string(), pa.float64())))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "words", "shares"][: len(arrays)])

    rows = docs.select(named(id_column).cast("long").alias("doc_id"), named(text_column).alias("text"))
    schema = "doc_id long, lang_pred string, score double, words long"
    return rows.mapInArrow(run, schema + (", shares map<string,double>" if with_shares else ""))


def op4_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_text("doc_id") % 3 == 1, F.lit(False))
    return predict(docs, learn(docs, ~held_out), with_shares=False).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
