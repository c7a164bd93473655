"""Repeated passages: units of lines hashed, grouped globally, all but the first occurrence removed.

Units are lines, cut at sentence ends, and sentences of more than ``LONG_UNIT`` words after words whose
hash is the least of their neighbours' (short sentences go with the next one), so that a passage has the
same units wherever it stands, also in the middle of a line and without sentence ends; only some words at
its ends go with the text around it. Units are
compared in lower case with single spaces and without the punctuation at their end. A unit is repeated if an
equal one comes earlier, by document id, then row, then place. Short units say little: only runs of
repeated units (with short ones in between) of ``MIN_WORDS`` words or more are removed, and whole lines of
``MIN_LINE_WORDS`` or more. The first occurrence of a unit always stays.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarframe.llm.common import materialise, named, shown, table, text_slices, with_row_keys

MIN_WORDS = 20
MIN_LINE_WORDS = 20  # shorter lines that repeat are mostly single stock sentences (README)
SHORT_UNIT = 4  # units of fewer words are not looked up
LONG_UNIT = 12  # longer ones are cut
LONGEST_UNIT = 32  # also without a word to cut at
NEAR = SHORT_UNIT - 1
PLACE_BITS = 28  # a text of at most 2^31 bytes has fewer than 2^28 units of four words
_BREAK = re.compile(r"(?<=[.!?…。！？])\s+|[^\S\n]*\n\s*")
_WORD = re.compile(r"\S+")


def _cuts(words: list[str]) -> list[int]:
    """Numbers of the words that end a piece of a long unit, the last one included.

    Such a word's hash is the least among its ``NEAR`` neighbours on both sides, so pieces have more than
    ``NEAR`` words and two texts cut a common passage alike from ``NEAR`` words within it. Texts without
    such a word (a few words over and over) are cut every ``LONGEST_UNIT`` words.
    """
    n, out, last = len(words), [], -1
    h = [zlib.crc32(w.encode("utf-8", "replace")) for w in words]
    for k in range(NEAR, n):
        v = h[k]
        least = k < n - NEAR - 1 and v < h[k - 1] and v <= h[k + 1]
        least = least and v < min(h[k - NEAR : k]) and v <= min(h[k + 1 : k + 1 + NEAR])
        if not least and k < n - 1:
            continue
        while k - last > LONGEST_UNIT:
            last += min(LONGEST_UNIT, k - last - NEAR - 1)
            out.append(last)
        out.append(k)
        last = k
    return out


def units(text: str) -> list[tuple[int, int, int]]:
    """(start, end, words) of each unit that has a word; the white space between units belongs to none."""
    found, start = [], 0

    def add(a: int, b: int) -> None:
        n = len(text[a:b].split())
        if n <= LONG_UNIT:
            if n:
                found.append((a, b, n))
            return
        places = [w.span() for w in _WORD.finditer(text, a, b)]
        first = 0
        for last in _cuts([text[c:d].lower() for c, d in places]):
            end = places[last][1] if last + 1 < len(places) else b
            found.append((places[first][0], end, last + 1 - first))
            first = last + 1

    for gap in _BREAK.finditer(text):
        if "\n" not in gap[0] and len(text[start : gap.start()].split()) < SHORT_UNIT:
            continue  # a short sentence goes with the next one of its line
        add(start, gap.start())
        start = gap.end()
    add(start, len(text))
    return found


def digest(unit: str) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(unit.lower().split()).rstrip(" .!?…。！？,;:").encode("utf-8", "replace"))


def removed_spans(
    text: str, repeated: set[int], min_words: int = MIN_WORDS, min_line_words: int = MIN_LINE_WORDS
) -> list[tuple[int, int]]:
    """Spans to take out, given the numbers of the units that are repeated."""
    all_units = units(text)
    spans: list[tuple[int, int]] = []
    run: list[int] = []

    def close() -> None:
        while run and run[-1] not in repeated:
            run.pop()  # short units at the end
        if not run:
            return
        words = sum(all_units[k][2] for k in run)
        start, end = all_units[run[0]][0], all_units[run[-1]][1]
        after = all_units[run[-1] + 1][0] if run[-1] + 1 < len(all_units) else len(text)
        line_start = not text[:start].rpartition("\n")[2].strip()
        line_end = "\n" in text[end:after] or not text[end:].strip()
        if words >= min_words or (line_start and line_end and words >= min_line_words):
            if "\n" in text[end:after] and not line_start:
                after = end  # what stays keeps its line end
            spans.append((start, after))
        run.clear()

    for k, (_, _, words) in enumerate(all_units):
        if k in repeated or (run and words < SHORT_UNIT):
            run.append(k)
        else:
            close()
    close()
    return spans


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]])


_UNITS = ["d0", "d1", "rank", "row_file", "spot"]  # digest; spot: place in the file, then the unit's number


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        digests, row, place = [], [], []
        for doc, text in enumerate(texts):
            if not text:
                continue
            text = text.decode()
            for k, (a, b, words) in enumerate(units(text)):
                if words >= SHORT_UNIT:
                    digests.append(digest(text[a:b]))
                    row.append(doc)
                    place.append(k)
        if digests:
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rank, file, at = (part.column(name).to_numpy()[row] for name in ("rank", "row_file", "row_at"))
            if (at >> (63 - PLACE_BITS)).any():
                raise ValueError(f"a file of more than 2^{63 - PLACE_BITS} rows")
            columns = [both[:, 0], both[:, 1], rank, file, at << PLACE_BITS | np.asarray(place)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _UNITS)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = MIN_WORDS,
    min_line_words: int = MIN_LINE_WORDS,
) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut out of the text, and a column removed_spans.

    removed_spans (array of start, end in characters of the original text) says what is gone; it is
    empty for texts that stay as they are. Null texts stay null, a text may become empty, no row is dropped. Rows with a
    null id rank last. Repeated rows rank one after the other, so the second loses what the first has.
    An empty table gives an empty table. A column named removed_spans is replaced, other names are free. Runs of
    ``min_words`` words are removed, and whole lines (or runs of them) of ``min_line_words``.
    """
    columns = [c for c in docs.columns if c.lower() != "removed_spans"]
    rank = F.coalesce(named(id_column).cast("long"), F.lit(2**63 - 1)).alias("rank")
    numbered = with_row_keys(docs.select(*map(named, columns)), rank, named(text_column).alias("text"))
    row = ["row_file", "row_at"]
    found = numbered.select("rank", *row, "text").mapInArrow(_unit_rows, ", ".join(f"{c} long" for c in _UNITS))
    found = materialise(found, "units", "zstd")
    at = F.struct("rank", "row_file", "spot")
    first = found.groupBy("d0", "d1").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select("d0", "d1", F.col("first.row_file").alias("first_file"), F.col("first.spot").alias("first_spot"))
    first = materialise(first, "firsts", "zstd")  # written, so that AQE can split a frequent digest's rows in the join
    later = found.drop("rank").join(first, ["d0", "d1"]).where("row_file <> first_file or spot <> first_spot")
    places = later.select(
        "row_file",
        F.shiftright("spot", PLACE_BITS).alias("row_at"),
        F.col("spot").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int").alias("place"),
    )
    places = places.groupBy(*row).agg(F.collect_list("place").alias("places"))
    joined = numbered.drop("rank", "text").join(places, row, "left").drop(*row)

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = docs.select(*map(named, columns)).schema.fields
    schema = T.StructType([*(T.StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)), T.StructField("spans", spans)])
    text_at = [c.lower() for c in columns].index(text_column.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, f"c{text_at}"):
            new, gone = [], []
            for text, places_found in zip(texts, part.column("places").to_pylist()):
                text = None if text is None else text.decode()
                out = removed_spans(text, set(places_found), min_words, min_line_words) if places_found else []
                new.append(cut(text, out) if out else text)
                gone.append([{"start": a, "end": b} for a, b in out])
            arrays = [part.column(f"c{k}") for k in range(len(columns))]
            arrays[text_at] = pa.array(new, arrays[text_at].type)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(gone, kind)], schema.names)

    return joined.mapInArrow(run, schema).select(*shown(columns), F.col("spans").alias("removed_spans"))


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id",
        "text",
        "removed_spans",
        F.expr("aggregate(removed_spans, 0L, (n, s) -> n + s.end - s.start)").alias("removed_chars"),
    )
