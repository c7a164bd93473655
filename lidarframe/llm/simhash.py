"""SimHash near-duplicates, found through one-wildcard variants of two fingerprint halves.

Two fingerprints of 64 bits that differ in at most three bits differ in at most one bit in one of
their two halves. A half is therefore indexed under 32 variants, each with one bit deleted: halves
that differ in no or one bit share a variant. Rows with equal variants meet by an equality
shuffle, and the whole fingerprints are compared. Random fingerprints share a variant with
probability 2^-31, hence buckets stay small; the exception are large groups of near copies. In a
bucket links are followed from fingerprint to fingerprint and what is reached is set aside, so that
a group of copies costs about its size and yields a spanning forest rather than all its pairs.
A bucket above ``HOT_BUCKET`` fingerprints is dealt out once more by the other half, cut into two
quarters of which again one differs in at most one bit; these buckets agree in 46 bits, which
bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarframe.llm.common import hidden, materialise, named, shown, table, text_slices
from lidarframe.llm.components import connected_components

MAX_BITS = 3
HOT_BUCKET = 8192
SHINGLE = 3
SEED = 42
_BLOCK = 1 << 15


def simhash(text: bytes | None) -> int:
    """Fingerprint of a UTF-8 text as an unsigned number; 0 for null and for texts without words."""
    words = (text or b"").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(SHINGLE))) if len(words) >= SHINGLE else iter([words])
    ones, total = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    while True:
        hashes = np.fromiter((digest(b" ".join(g), SEED) for g in islice(grams, _BLOCK)), np.dtype("<u8"))
        if not hashes.size:
            break
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += hashes.size
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp): a row for each row of ``docs``; fp has the bits of the unsigned fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = np.fromiter(map(simhash, texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    rows = docs.select(named(id_column).cast("long").alias("doc_id"), named(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _forest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links of at most MAX_BITS bits connect."""
    left, one, other = values, [], []
    while left.size > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and left.size:
            x = waiting.pop()
            near = np.bitwise_count(left ^ x) <= MAX_BITS
            hits = left[near]
            if hits.size:
                one.append(np.full(hits.size, x))
                other.append(hits)
                waiting.extend(hits)
                left = left[~near]
    if not one:
        return values[:0], values[:0]
    return np.concatenate(one), np.concatenate(other)


def _first_variant(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of the first variant that two linked fingerprints share."""
    out = np.full(a.size, 64)
    for half in (1, 0):
        diff = ((a ^ b) >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        count = np.bitwise_count(diff)
        place = np.bitwise_count(np.maximum(diff, 1) - np.uint64(1))  # of the only bit
        out = np.where(count == 0, 32 * half, np.where(count == 1, 32 * half + place, out))
    return out


def bucket_links(hot_bucket: int | None):
    """For rows (key, fp) sorted by key: edges (a, b, hot=false) of each key's fingerprints.

    With ``hot_bucket``, keys begin with the number of a variant; rows of larger buckets come out
    as (key, fp, hot=true). An edge is then left out if an earlier variant's bucket holds both its
    ends, as that bucket connects them.
    """

    def edges(key: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = _forest(values)
        if hot_bucket and a.size:
            own = _first_variant(a, b) == key >> 32
            a, b = a[own], b[own]
        return a, b

    def rows(a: np.ndarray, b: np.ndarray, hot: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(a.size, hot))],
            ["a", "b", "hot"],
        )

    def whole(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, keys.size])
        two = starts[sizes == 2]
        near = two[np.bitwise_count(values[two] ^ values[two + 1]) <= MAX_BITS]
        a, b = values[near], values[near + 1]
        if hot_bucket and a.size:
            own = _first_variant(a, b) == keys[near] >> 32
            a, b = a[own], b[own]
        found = [(a, b)]
        found += [edges(int(keys[s]), values[s : s + n]) for s, n in zip(starts, sizes) if n > 2]
        a, b = (np.concatenate(x) for x in zip(*found))
        if a.size:
            yield rows(a, b, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, hot_key = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            keys, values = np.concatenate([keys, more[0]]), np.concatenate([values, more[1]])
            if hot_key is not None:
                n = int(np.searchsorted(keys, hot_key, "right"))
                if n:
                    yield rows(keys[:n].view(np.uint64), values[:n], True)
                keys, values = keys[n:], values[n:]
                hot_key = hot_key if not keys.size else None
            if not keys.size:
                continue
            last = int(np.searchsorted(keys, keys[-1], "left"))
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[starts, keys.size])
            large = sizes > (hot_bucket or np.inf)
            for s, n in zip(starts[large], sizes[large]):
                yield rows(keys[s : s + n].view(np.uint64), values[s : s + n], True)
            if large[-1]:
                hot_key = keys[-1]
            small = np.repeat(~large, sizes)
            done = small.copy()
            done[last:] = False
            if done.any():
                yield from whole(keys[done], values[done])
            small[:last] = False
            keys, values = keys[small], values[small]
        if keys.size:
            yield from whole(keys, values)

    return run


def variants(classes: DataFrame) -> DataFrame:
    """(key, fp): 64 rows for each fingerprint; key: number of the variant, and the half's other bits."""
    number = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("n")
    return classes.select("fp", number).selectExpr(
        "shiftleft(cast(n as long), 32) | (shiftrightunsigned(fp, cast(shiftright(n, 5) * 32 as int))"
        " & 4294967295L & ~shiftleft(1L, n & 31)) as key",
        "fp",
    )


def _quarter_variants(hot: DataFrame) -> DataFrame:
    """(key, fp) of rows (a: key, b: fp): 32 rows each, by a hash of key and the other half's quarters."""
    number = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("n")
    return hot.select("a", "b", number).selectExpr(
        "xxhash64(a, n, shiftrightunsigned(b, cast(if(a < 137438953472L, 32, 0) + shiftright(n, 4) * 16 as int))"
        " & 65535L & ~shiftleft(1L, n & 15)) as key",
        "b as fp",
    )


def fingerprint_links(classes: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Edges (src, dst) over different fingerprints that connect all within MAX_BITS bits."""
    schema = "a long, b long, hot boolean"
    spread = variants(classes).repartition("key").sortWithinPartitions("key")
    first = materialise(spread.mapInArrow(bucket_links(hot_bucket), schema), "links")
    again = _quarter_variants(first.where("hot")).repartition("key").sortWithinPartitions("key", "fp")
    second = again.mapInArrow(bucket_links(None), schema)
    return first.where("not hot").unionByName(second).selectExpr("a as src", "b as dst")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot_bucket: int = HOT_BUCKET
) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most three bits. Null and empty
    texts and texts without words have fingerprint zero and are linked like any other; shorter
    texts than a shingle are one shingle. Repeated rows come out as often as they went in. Rows with
    a null doc_id take part; component_id is null only if no reachable row has an id. An empty table
    gives an empty table; other columns are not read.
    """
    prints = materialise(fingerprints(docs, id_column, text_column), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    parts = connected_components(fingerprint_links(classes.select("fp"), hot_bucket))
    member = classes.join(parts, classes.fp == parts.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    member = materialise(member, "members")
    least = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each group of near copies: that with the smallest id.

    Of rows that repeat the smallest id the first one read stays. Rows without any id in their group: one
    stays as well. Column names are free.
    """
    columns = docs.columns
    names = [c.lower() for c in columns]
    id_at, text_at = (f"c{names.index(c.lower())}" for c in (id_column, text_column))
    marked = docs.select(*hidden(columns), F.monotonically_increasing_id().alias("row"))
    marked = materialise(marked, "rows", "zstd")
    groups = near_duplicates(marked, "row", text_at).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    ids = marked.select("row", F.col(id_at).alias("id")).join(groups, "row")
    first = F.min(F.struct(F.isnull("id").alias("none"), "id", "row")).alias("first")
    kept = ids.groupBy("group").agg(first).select(F.col("first.row").alias("row"))
    return marked.join(kept, "row", "left_semi").select(*shown(columns))


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", text.alias("fingerprint"), "component_id")
