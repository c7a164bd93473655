"""Quality rules as a ledger: measurements and one bit per failed rule, judged by policies later.

Every rule is evaluated once per text. A policy is a version and the rules it applies, so its verdict is
a bitwise and; what each rule costs (an ablation) follows from the counts of the distinct bit
patterns without looking at a text or a measurement again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import materialise, named, table, text_slices

MEASURES = (
    "n_words",  # runs of anything but ASCII white space
    "word_chars",  # code points in words
    "n_symbols",  # characters of # * $ % & | < >
    "n_lines",  # lines with a word
    "n_dup_lines",  # of these, equal to an earlier line
    "n_repeat_words",  # words in windows of five that the text has twice or more
    "n_upper_words",  # with letters of A-Z and none of a-z
)

# Rule -> SQL condition under which a text fails it. The place in this list is the bit.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "upper_case": "10 * n_upper_words > 3 * n_words",
}
BASE = ("few_words", "repeated_words")
POLICIES = {
    "base": BASE,
    "strict": tuple(RULES),
    # Without duplicate_lines: of the labelled documents that fail nothing else, all are good ones.
    "v1": tuple(r for r in RULES if r != "duplicate_lines"),
}

_WINDOW = 5
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_STARTS = np.array([(k & 0xC0) != 0x80 and k not in _SPACE for k in range(256)])  # code points in words
_IS_SYMBOL = np.array([k in _SYMBOLS for k in range(256)])


def measure(text: bytes) -> tuple[int, ...]:
    """MEASURES of a text in UTF-8."""
    words = text.split()  # bytes: ASCII white space only
    if not words:
        bytes_found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        return 0, 0, int(bytes_found[_IS_SYMBOL].sum()), 0, 0, 0, 0
    bytes_found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        int(bytes_found[_STARTS].sum()),
        int(bytes_found[_IS_SYMBOL].sum()),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(words),
        sum(map(bytes.isupper, words)),
    )


def _repeated(words: list[bytes]) -> int:
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    window = ids[:n]
    for k in range(1, _WINDOW):  # renumbered after each word, so equal numbers are equal windows
        pair = window * len(numbers) + ids[k : n + k]
        window = np.unique(pair, return_inverse=True)[1]
        if window.max() == n - 1:
            return 0  # all differ already
    twice = np.flatnonzero((np.bincount(window) > 1)[window])
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + _WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def failed_bits() -> Column:
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, the MEASURES as long, failed int): a row for each row of ``docs``.

    A null text counts as empty; a text without words fails few_words. Repeated rows and null ids
    are rows like any other; other columns are not read; an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = np.array([measure(t or b"") for t in texts], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, found.T)], ["doc_id", *MEASURES]
            )

    rows = docs.select(named(id_column).cast("long").alias("doc_id"), named(text_column).alias("text"))
    measured = rows.mapInArrow(run, ", ".join(["doc_id long", *(f"{m} long" for m in MEASURES)]))
    return measured.withColumn("failed", failed_bits())


def passes(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(found: DataFrame, policy: str) -> DataFrame:
    """(rule, failing, failing_alone, kept, kept_without) for each rule of a policy.

    failing_alone counts rows that only this rule of the policy fails, which are those that dropping it
    would keep. Works on the counts of distinct bit patterns, at most 2^rules rows. A table without
    rows gives counts of zero.
    """
    whole = mask(POLICIES[policy])
    patterns = found.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("bits")).count()
    out = []
    for rule in POLICIES[policy]:
        own = mask((rule,))
        hits = F.col("bits").bitwiseAND(F.lit(own)) != 0
        sums = {
            "failing": hits,
            "failing_alone": F.col("bits") == own,
            "kept": F.col("bits") == 0,
            "kept_without": F.col("bits").bitwiseAND(F.lit(whole & ~own)) == 0,
        }
        out += [F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).alias(f"{rule}.{n}") for n, c in sums.items()]
    names = ("failing", "failing_alone", "kept", "kept_without")
    structs = [
        F.struct(F.lit(r).alias("rule"), *[F.col(f"`{r}.{n}`").alias(n) for n in names]) for r in POLICIES[policy]
    ]
    return patterns.agg(*out).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Verdicts of the policies, and for rows that one rule of v1 alone fails what dropping that rule would keep."""
    found = materialise(ledger(table(spark, sf_dir, "documents")), "ledger")
    bits = F.create_map(*[F.lit(x) for rule in POLICIES["v1"] for x in (rule, mask((rule,)))])
    costs = ablations(found, "v1").select(bits[F.col("rule")].alias("bit"), "failing_alone")
    applied = F.col("failed").bitwiseAND(F.lit(mask(POLICIES["v1"])))
    return found.join(F.broadcast(costs), applied == F.col("bit"), "left").select(  # a row for each rule
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes("base")).alias("base_failed"),
        passes("v1").alias("kept"),
        "failed",
        F.col("failing_alone").alias("kept_without_rule"),
    )


_SPACES = r"[\x20\x09-\x0D]"
OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, string_split(t, chr(10)) AS lines FROM d),
grams AS (
  SELECT r, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] || ' ' || words[i+3] || ' ' || words[i+4] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twice AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
m AS (
  SELECT w.r, doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '{_SPACES}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper
  FROM w LEFT JOIN covered USING (r)),
k AS (
  SELECT *, (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines, len(full_lines) AS n_lines FROM m),
b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 10 * n_upper > 3 * n_words THEN 64 ELSE 0 END) AS failed FROM k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & 3) <> 0 AS base_failed, (failed & 119) = 0 AS kept, failed::INTEGER AS failed,
  CASE WHEN bit_count(failed & 119) = 1 THEN count(*) OVER (PARTITION BY failed & 119) END AS kept_without_rule FROM b
"""
