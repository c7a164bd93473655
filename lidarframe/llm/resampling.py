"""Importance resampling towards a target, with hashed word runs found by an Aho-Corasick dictionary.

Words are runs of letters, digits and non-ASCII characters in lower case. Each slice of texts gets a
dictionary of its distinct words, every one between two delimiters, so that a match is a whole word and
matches of neighbours share the delimiter between them. An entry's payload is the CRC-32 and the length
of the word. A scan emits payloads; the CRC of a run of words follows from the payloads of its words
by composition (the first CRC is carried over as many zero bytes as the second has), so no run is ever built
as a string. The CRC modulo the number of buckets is the feature's bucket.

Texts are scanned once. What is kept of a text are its buckets and how often it has each, at most as many as there are
buckets. Counts per bucket are added up in each task before they are shuffled. The log ratio of target and raw
counts is the gain of a bucket, and a text's weight the sum of its features' gains; a draw takes the
highest sums of weight and Gumbel noise, which a hash of the id gives.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import materialise, table, text_slices

BUCKETS = 10_000
RUN = 1  # most words of a feature
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
_BLOCK = 1 << 20  # bytes of words that share a dictionary

_DELIMITERS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes(
    k + 32 if 0x41 <= k <= 0x5A else 0x20 if k in _DELIMITERS else k for k in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8: lower case for A-Z only, cut at all other ASCII characters than digits and letters."""
    return (text or b"").translate(_FOLD).split()


def _dictionary(words: set[bytes]):
    """Automaton over " word " with payloads crc << 32 | length; characters stand for bytes."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word in words:
        automaton.add_word(f" {word.decode('latin-1')} ", zlib.crc32(word) << 32 | len(word))
    automaton.make_automaton()
    return automaton


def payloads(documents: list[list[bytes]]) -> Iterator[np.ndarray]:
    """For each list of words: the payloads of its words in order, as the scan emits them."""
    words = set().union(*documents)
    if not words:
        yield from (np.empty(0, np.uint64) for _ in documents)
        return
    automaton = _dictionary(words)
    for found in documents:
        line = f" {b' '.join(found).decode('latin-1')} " if found else ""
        yield np.fromiter((value for _, value in automaton.iter(line)), np.uint64, len(found))


@lru_cache(maxsize=4096)
def _zeros(length: int) -> np.ndarray:
    """What ``length`` zero bytes make of a CRC: its 32 bits' images."""
    if length == 1:
        images = np.empty(32, np.uint64)
        for bit in range(32):
            crc = 1 << bit
            for _ in range(8):
                crc = crc >> 1 ^ (0xEDB88320 if crc & 1 else 0)
            images[bit] = crc
        return images
    half = _zeros(length // 2)
    twice = _carry(half, half)
    return _carry(twice, _zeros(1)) if length % 2 else twice


def _carry(crcs: np.ndarray, images: np.ndarray) -> np.ndarray:
    out = np.zeros_like(crcs)
    for bit in range(32):
        out ^= images[bit] * (crcs >> np.uint64(bit) & np.uint64(1))
    return out


def compose(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Payloads of the texts that begin with the first and go on with the second."""
    low = np.uint64(0xFFFFFFFF)
    shift = np.uint64(32)
    crcs, lengths = first >> shift, second & low
    for length in np.unique(lengths[lengths > 0]).tolist():
        at = lengths == length
        crcs[at] = _carry(crcs[at], _zeros(length))
    return (crcs ^ (second >> shift)) << shift | ((first & low) + lengths)


_SPACE = np.uint64(zlib.crc32(b" ") << 32 | 1)


def run_buckets(words: np.ndarray, longest: int, buckets: int) -> np.ndarray:
    """Buckets of all runs of 1 to ``longest`` neighbouring words, given the words' payloads."""
    runs, found = words, [words]
    for n in range(1, min(longest, len(words))):
        spaced = compose(runs[: len(words) - n].copy(), np.full(len(words) - n, _SPACE))
        runs = compose(spaced, words[n:])
        found.append(runs)
    return (np.concatenate(found) >> np.uint64(32)) % np.uint64(buckets)


def _counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0), np.empty(0))


def _features(documents: list[list[bytes]], longest: int, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each document; those of very many words are scanned in blocks."""
    out, group, size = [], [], 0

    def close() -> None:
        nonlocal group, size
        out.extend(_counted([run_buckets(p, longest, buckets)]) for p in payloads(group))
        group, size = [], 0

    for words in documents:
        weight = sum(map(len, words)) + len(words)
        if weight > _BLOCK:
            close()
            out.append(_long(words, longest, buckets))
            continue
        group.append(words)
        size += weight
        if size > _BLOCK:
            close()
    close()
    return out


def _long(words: list[bytes], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Like a short document, with a dictionary for each block of words and the block's counts added up."""
    total = np.zeros(buckets, np.int64)
    step = max(longest, _BLOCK // 8)
    for start in range(0, len(words), step):
        before = max(0, start - longest + 1)  # runs that end in this block, also those begun before it
        (found,) = payloads([words[before : start + step]])
        total += np.bincount(run_buckets(found, longest, buckets).astype(np.int64), minlength=buckets)
        if start > before:  # runs wholly before the block were counted with the last one
            total -= np.bincount(
                run_buckets(found[: start - before], longest, buckets).astype(np.int64), minlength=buckets
            )
    kept = np.flatnonzero(total)
    return kept, total[kept]


def bucket_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    longest: int = RUN,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_words, n_features, buckets array<int>, counts array<long>) for each row of ``docs``.

    Null and empty texts and texts without words have no features. Repeated rows and null ids
    are rows like any other; other columns are not read; an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            words = [words_of(t) for t in texts]
            found = _features(words, longest, buckets)
            n_words = [len(w) for w in words]
            # runs of 1, 2, ... words
            n = [sum(max(0, k - m) for m in range(longest)) for k in n_words]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                    pa.array([c.astype(np.int64) for _, c in found], pa.list_(pa.int64())),
                ],
                ["id", "n_words", "n_features", "buckets", "counts"],
            )

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return rows.mapInArrow(run, "id long, n_words long, n_features long, buckets array<int>, counts array<long>")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of an Arrow list column, and the row of each."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values, np.repeat(np.arange(len(column)), np.diff(offsets))


def totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of :func:`bucket_counts`: one sum a bucket and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            if batch.num_rows:
                which, _ = _flat(batch.column("buckets"))
                np.add.at(total, which, _flat(batch.column("counts"))[0])
        kept = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(total[kept])], ["bucket", "n"])

    parts = counted.select("buckets", "counts").mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket, add-one smoothed."""
    s_all, t_all, n = int(raw.sum()), int(target.sum()), len(raw)
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * float(s_all + n) / ((float(s) + 1) * float(t_all + n))))
            for s, t in zip(raw.tolist(), target.tolist())
        ],
        np.int64,
    )


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """floor(1000 * Gumbel noise) of an id; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(counted: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score): a row for each row of :func:`bucket_counts`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows, np.int64)
            if batch.num_rows:
                which, row = _flat(batch.column("buckets"))
                np.add.at(weight, row, gain[which] * _flat(batch.column("counts"))[0])
            noise = np.array([gumbel(k, seed) for k in batch.column("id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight), pa.array(weight + noise)],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return counted.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` with rank: 1, 2, ... for the floor(percent * N / 100) highest scores of the N rows with at
    least ``min_words`` words, else null. Ties go to the smaller id, null ids last, then to fewer features.

    Rows are sorted by ranges of the score and numbered in their range; a range's first number
    follows from the sizes of the ranges before it, so no task sees more than its range.
    """
    able = F.col("n_words") >= min_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))],
                [*batch.schema.names, "__range", "__at"],
            )
            at += n

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.schema)
    ranged = scored.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialise(ranged.mapInArrow(run, f"{schema}, __range int, __at long"), "drawn")
    sizes = dict(numbered.groupBy("__range").count().collect())  # one row for each partition of the shuffle
    before = accumulate((sizes[k] for k in sorted(sizes)), initial=0)
    starts = scored.sparkSession.createDataFrame(list(zip(sorted(sizes), before)), "__r2 int, __start long")
    drawn = percent * sum(sizes.values()) // 100
    place = F.col("__start") + F.col("__at") + 1
    ranked = numbered.join(F.broadcast(starts), F.col("__range") == F.col("__r2")).select(
        *scored.columns, F.when(place <= drawn, place).alias("rank")
    )
    rest = scored.where(~F.coalesce(able, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    longest: int = RUN,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for each row of ``docs``; rank is null for rows not drawn.

    Null and empty texts, and those without words, have weight 0 and are not drawn (unless ``min_words`` is 0);
    a null doc_id gets the noise of an empty one. Repeated rows are scored and drawn as often as they are there.
    An empty target gives gains of what is rare in ``docs``; an empty table gives an empty table. Other columns are
    not read, so their names cannot clash.
    """
    counted = materialise(bucket_counts(docs, id_column, text_column, longest, buckets), "buckets")
    wanted = target.select(F.lit(None).cast("long").alias("id"), F.col(f"`{target_text}`").alias("text"))
    gain = gains(totals(counted, buckets), totals(bucket_counts(wanted, "id", "text", longest, buckets), buckets))
    scored = materialise(score(counted, gain, seed), "scored")
    return draw(scored, min_words, percent).select("doc_id", "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 bit by bit: for each byte, the byte itself (xor) and eight shifts (-1).
OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
used AS (SELECT r, unnest(words) AS w FROM d),
wanted AS (SELECT unnest(words) AS w FROM b),
w AS (SELECT DISTINCT w FROM (SELECT w FROM used UNION ALL SELECT w FROM wanted)),
bytes AS (
  SELECT w, list_transform(range(1, (length(hex(encode(w))) // 2 + 1)::BIGINT),
    lambda k: ('0x' || substr(hex(encode(w)), 2 * k - 1, 2))::BIGINT) AS v FROM w),
crc AS (
  SELECT w, xor(list_reduce(flatten([[4294967295::BIGINT], flatten(list_transform(v, lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END),
    4294967295::BIGINT) % 10000 AS bucket FROM bytes),
s AS (SELECT bucket, count(*) AS n FROM used JOIN crc USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN crc USING (w) GROUP BY 1),
gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM used) + 10000)::DOUBLE
    / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket)),
sums AS (SELECT r, sum(g)::BIGINT AS weight FROM used JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN sums USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS k FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN k <= 10 * (SELECT count(*) FROM ranked) // 100 THEN k END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
