"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding: compatibility forms, lower case, no diacritics or invisible characters, letters of other
scripts that look like Latin ones and digits or signs that stand for letters replaced by these.
The lexicon is learned: words that labelled toxic texts hold far more often than others. Near copies
(texts whose word triples have the same minimum hash) count once, so that a copied text does not put its own
words on the list. A word followed or preceded by the same neighbour in harmless texts makes that
pair an exception phrase; within an exception phrase, a word does not count. A text's score
is a logistic function of its summed weights and of these per length, fitted on the same sample.

The sample is bounded (``SAMPLE`` labelled ids by a hash, one text of each); every word and phrase of it that
passes the test is used. Everything else is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import crc_text, materialise, table, text_slices

SAMPLE = 24_000
MIN_TEXTS = 3  # toxic texts that hold a term
CHANCE = 1e-2  # most likely number of words of a sample that are on the list by chance
THRESHOLD = 0.3
NOT_TOXIC = ("trash can", "trash bin", "class clown", "clown fish", "pond scum", "sore loser")

# Letters that look alike, and signs that stand for letters.
_HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l", "ɴ": "n", "ʀ": "r", "ø": "o", "ł": "l", "đ": "d",
}
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "$": "s", "@": "a", "€": "e"}
_MARKS = {c: None for c in range(0x300, 0x370)}
_HIDDEN = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_FOLD = _MARKS | _HIDDEN | {ord(a): b for a, b in (_HOMOGLYPHS | _SIGNS).items()}
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    return unicodedata.normalize("NFKD", text).lower().translate(_FOLD)


class Model(NamedTuple):
    terms: dict[str, float]  # folded term -> weight
    phrases: tuple[str, ...]  # folded exception phrases
    coefficients: tuple[float, float, float]  # of 1, log summed weight, log weight per 100 words


class Matcher:
    """Finds a model's terms in a text."""

    def __init__(self, terms: dict[str, float], phrases: tuple[str, ...]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in phrases:
            if phrase not in terms:
                self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of terms that are whole words outside exception phrases."""
        if not len(self.automaton):
            return []
        found, covered, size = [], [], len(folded)
        for last, (n, weight) in self.automaton.iter(folded):
            start, end = last + 1 - n, last + 1
            if (start and folded[start - 1].isalpha()) or (end < size and folded[end].isalpha()):
                continue
            (covered if weight is None else found).append((start, end, weight))
        if not covered or not found:
            return found
        # Both lists are in order of their ends. Of the phrases that end no sooner than a term, that
        # with the first start covers it if any does.
        first = list(accumulate((start for start, _, _ in reversed(covered)), min))[::-1]
        kept, k = [], 0
        for start, end, weight in found:
            while k < len(covered) and covered[k][1] < end:
                k += 1
            if k == len(covered) or first[k] > start:
                kept.append((start, end, weight))
        return kept

    def features(self, text: str | None) -> tuple[int, float, int]:
        """Hits, summed weight, words."""
        if not text:
            return 0, 0.0, 0
        found = self.hits(fold(text))
        return len(found), sum(w for _, _, w in found), len(text.split())


def _design(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(weight), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))], 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton's method with a small ridge, which keeps separable samples finite."""
    b = np.zeros(x.shape[1])
    penalty = ridge * len(y) * np.eye(x.shape[1])
    penalty[0, 0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if abs(step).max() < 1e-9:
            break
    return b


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, copy) for each different folded word of a text; copy is equal for near copies."""
    for part, texts in text_slices(batches):
        word, toxic, copy = [], [], []
        for text, label in zip(texts, part.column("toxic").to_pylist()):
            words = _WORD.findall(fold(text.decode())) if text else []
            found = set(words)
            if found:
                grams = map(" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [" ".join(words)]
                least = min(map(xxhash.xxh64_intdigest, grams))
                word.extend(found)
                toxic.extend([label] * len(found))
                copy.extend([least - (1 << 63)] * len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(word, pa.string()), pa.array(toxic, pa.int32()), pa.array(copy, pa.int64())],
            ["word", "toxic", "copy"],
        )


def _phrase_rows(terms: dict[str, float]):
    """(phrase, toxic) for each different pair of a term and its neighbour in a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            phrase, toxic = [], []
            for text, label in zip(texts, part.column("toxic").to_pylist()):
                words = list(_WORD.finditer(fold(text.decode()))) if text else []
                found = set()
                for a, b in zip(words, words[1:]):
                    if (a[0] in terms or b[0] in terms) and a.string[a.end() : b.start()] == " ":
                        found.add(f"{a[0]} {b[0]}")
                phrase.extend(found)
                toxic.extend([label] * len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrase, pa.string()), pa.array(toxic, pa.int32())], ["phrase", "toxic"]
            )

    return run


def _feature_rows(terms: dict[str, float], phrases: tuple[str, ...], keep: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms, phrases)
        for part, texts in text_slices(batches):
            found = [matcher.features(t.decode() if t else None) for t in texts]
            hits, weight, words = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [part.column(keep), pa.array(hits, pa.int32()), pa.array(weight, pa.float64()), pa.array(words, pa.int64())],
                [keep, "hits", "weight", "words"],
            )

    return run, f"{keep} {kind}, hits int, weight double, words long"


def learn(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    sample: int = SAMPLE,
    phrases: tuple[str, ...] = NOT_TOXIC,
) -> Model:
    """A model from texts (doc_id, text) and labels (doc_id, toxic) of the rows that ``train`` admits.

    A text is toxic if any of its label rows says 1; rows without an id or label teach nothing. Of rows that repeat a
    doc_id one text is learned from. Without toxic
    labels, or without others, the model has no terms and scores nothing.
    """
    known = labels.where("doc_id is not null and toxic is not null")
    if train is not None:
        known = known.where(train)
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))  # of rows that repeat an id, one
    texts = materialise(
        docs.select(F.col("doc_id").alias("id"), "text")
        .join(F.broadcast(known), F.col("id") == F.col("doc_id"))  # at most ``sample`` small rows
        .groupBy("id", "toxic")
        .agg(one.alias("one"))
        .select("one.text", "toxic"),
        "labelled",
    )
    words = texts.mapInArrow(_word_rows, "word string, toxic int, copy long").distinct()
    size = {
        r.toxic: r.n for r in words.groupBy("toxic").agg(F.count_distinct("copy").alias("n")).collect()
    }
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        return Model({}, (), (-30.0, 0.0, 0.0))
    share = bad / (bad + good)
    counts = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("n"))
    # How sure a word is: logarithm of the chance that so many of its texts are toxic (Chernoff's bound)
    rate = F.col("t") / (F.col("t") + F.col("n"))
    other = F.when(F.col("n") > 0, F.col("n") * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    evidence = F.col("t") * F.log(rate / share) + other
    weight = F.log((F.col("t") + 0.5) / (bad + 1.0)) - F.log((F.col("n") + 0.5) / (good + 1.0))
    seen = counts.where(F.col("t") >= MIN_TEXTS).where(rate > 0.5).withColumns({"evidence": evidence, "weight": weight})
    rare = math.log(max(1, counts.count()) / CHANCE)
    best = seen.where(F.col("evidence") >= rare).select("word", "weight").collect()
    terms = {r.word: r.weight for r in best}
    exceptions = {fold(p) for p in phrases}
    if terms:
        pairs = texts.mapInArrow(_phrase_rows(terms), "phrase string, toxic int")
        harmless = (
            pairs.groupBy("phrase")
            .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("n"))
            .where(f"t = 0 and n >= {MIN_TEXTS}")
            .select("phrase")
            .collect()
        )
        exceptions |= {r.phrase for r in harmless}
    found = tuple(sorted(exceptions))
    run, schema = _feature_rows(terms, found, "toxic", "int")
    rows = texts.mapInArrow(run, schema).select("toxic", "weight", "words").toPandas()
    x = _design(rows.weight.to_numpy(), rows.words.to_numpy())
    b = fit_logistic(x, rows.toxic.to_numpy().astype(float))
    return Model(terms, found, tuple(b.tolist()))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, hits, weight, words, score) for each row of ``docs``.

    Null and empty texts and texts without a term have the score of no hits. Repeated rows come out
    as often as they are there, null ids stay null; other columns are not read; an empty table gives an empty one.
    """
    run, schema = _feature_rows(model.terms, model.phrases, "doc_id", "long")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, schema).withColumn("score", score_column(model))


def score_column(model: Model) -> Column:
    a, b, c = model.coefficients
    z = a + b * F.log1p("weight") + c * F.log1p(100 * F.col("weight") / F.greatest("words", F.lit(1)))
    return 1 / (1 + F.exp(-z))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score is below ``threshold``, in one pass. Null and empty texts stay."""
    columns = docs.columns
    at = [c.lower() for c in columns].index(text_column.lower())
    a, b, c = model.coefficients

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.terms, model.phrases)
        for part, texts in text_slices(batches, columns[at]):
            found = [matcher.features(t.decode() if t else None) for t in texts]
            weight, words = (np.array([f[k] for f in found], float) for k in (1, 2))
            low = 1 / (1 + np.exp(-(_design(weight, words) @ [a, b, c]))) < threshold
            low |= np.array([not t for t in texts])
            yield part.filter(pa.array(low))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_text("doc_id") % 4 == 2, F.lit(False))
    model = learn(docs, labels, ~held_out)
    return score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "hits",
    )
