"""The ``las_headers`` source (one row per file) and ``las_range_stats`` (one row per byte range)."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema

from lidarframe.sources.boxes import Box
from lidarframe.sources.files import (
    ByteRange,
    FileEntry,
    FilePartition,
    RangePartition,
    chunk_files,
    filesystem,
    folder_choice,
    list_files,
    partition_fields,
    read_head,
    split_files,
)
from lidarframe.sources.layouts import (
    COORDINATES,
    MAX_HEADER_BYTES,
    Header,
    LasFormatError,
    parse_header,
)
from lidarframe.sources.points import BATCH_POINTS, point_blocks, point_range

HEADER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("file_length", T.LongType(), False),
        T.StructField("version", T.StringType()),
        T.StructField("header_size", T.IntegerType()),
        T.StructField("point_offset", T.LongType()),
        T.StructField("n_vlr", T.LongType()),
        T.StructField("point_format", T.IntegerType()),
        T.StructField("record_length", T.IntegerType()),
        T.StructField("point_count", T.LongType()),
    ]
    + [T.StructField(f"scale_{c}", T.DoubleType()) for c in COORDINATES]
    + [T.StructField(f"offset_{c}", T.DoubleType()) for c in COORDINATES]
    + [T.StructField(f"{m}_{c}", T.DoubleType()) for c in COORDINATES for m in ("min", "max")]
    + [T.StructField("error", T.StringType())]
)
STATS_SCHEMA = T.StructType(
    HEADER_SCHEMA.fields
    + [T.StructField("scanned_points", T.LongType())]
    + [T.StructField(f"scanned_{m}_{c}", T.DoubleType()) for c in COORDINATES for m in ("min", "max")]
)
# A listed file: what ``las_files`` gives, and what an index of headers is kept by
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("file_length", T.LongType(), False),
        T.StructField("modified_ns", T.LongType(), False),
        T.StructField("root", T.StringType(), False),
        T.StructField("inner", T.StringType(), False),
        T.StructField("keys", T.MapType(T.StringType(), T.StringType()), False),
    ]
)
HEADER_THREADS = 16


class LasFileSource(DataSource):
    """One row per file, none of which is opened."""

    @classmethod
    def name(cls) -> str:
        return "las_files"

    def schema(self) -> T.StructType:
        return FILE_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FileReader(self.options)


class FileReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self) -> list[FilePartition]:
        return chunk_files(list_files(self.options), self.options)

    def read(self, partition: FilePartition | None) -> Iterator[pa.RecordBatch]:
        rows = [
            {"path": f.name, "file_length": f.size, "modified_ns": f.mtime_ns, "root": f.root, "inner": f.path, "keys": f.keys}
            for f in (partition.files if partition else [])
        ]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(FILE_SCHEMA))


class BoundedRow:
    """A row of header values as far as ``boxes.relation`` looks at it."""

    def __init__(self, row: dict):
        self.point_count = row["point_count"]
        self.scale = [row[f"scale_{c}"] for c in COORDINATES]
        self.minimum, self.maximum = ([row[f"{m}_{c}"] for c in COORDINATES] for m in ("min", "max"))


class LasHeaderSource(DataSource):
    """One row per file. ``badFiles=keep`` reports unreadable files in ``error`` instead of failing."""

    @classmethod
    def name(cls) -> str:
        return "las_headers"

    def schema(self) -> T.StructType:
        return T.StructType(HEADER_SCHEMA.fields + partition_fields(self.options))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return HeaderReader(self.options, schema)


class HeaderReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.options = options
        self.arrow_schema = to_arrow_schema(schema)
        bad_files = str(options.get("badFiles") or "fail").lower()
        if bad_files not in ("fail", "keep"):
            raise ValueError(f"badFiles must be 'fail' or 'keep', not {bad_files!r}")
        self.keep_bad = bad_files == "keep"
        self.box = Box(options)
        self.folders = folder_choice(options)

    def partitions(self) -> list[FilePartition]:
        files = list_files(self.options)
        return chunk_files([f for f in files if self.folders is None or f.keys in self.folders], self.options)

    def read(self, partition: FilePartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        rows = list(header_rows(partition.files, self.keep_bad, self.box))
        columns = {f.name: [row.get(f.name) for row in rows] for f in self.arrow_schema}
        arrays = []
        for field in self.arrow_schema:
            array = pa.array(columns[field.name])
            arrays.append(array if array.type == field.type else array.cast(field.type))
        yield pa.RecordBatch.from_arrays(arrays, schema=self.arrow_schema)


def header_rows(files: list[FileEntry], keep_bad: bool = False, box: Box | None = None) -> Iterator[dict]:
    """Header values of each file that ``box`` takes; a broken file is an error, or has one with ``keep_bad``."""
    for file, head in _read_heads(files):
        try:
            header = parse_header(head, file.name)
        except LasFormatError as e:
            if not keep_bad:
                raise
            yield header_row(file, None, str(e))
            continue
        if box is None or box.takes(header):
            short = keep_bad and header.end > file.size
            yield header_row(file, header, "points end behind the end of the file" if short else None)


def _read_heads(files: list[FileEntry]) -> Iterator[tuple[FileEntry, bytes]]:
    """First bytes of each file; on remote stores, where waiting dominates, several at a time."""

    def head(file: FileEntry) -> bytes:
        return read_head(file, MAX_HEADER_BYTES)

    if all(isinstance(filesystem(f.root)[0], pafs.LocalFileSystem) for f in files):
        yield from ((f, head(f)) for f in files)
        return
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        yield from zip(files, pool.map(head, files), strict=True)


def header_row(file: FileEntry, head: Header | None, error: str | None = None) -> dict:
    row = {"path": file.name, "file_length": file.size, "error": error, **dict(file.keys)}
    if head is None:
        return row
    for name in HEADER_SCHEMA.fieldNames()[2:9]:
        row[name] = getattr(head, name)
    for axis, c in enumerate(COORDINATES):
        row[f"scale_{c}"], row[f"offset_{c}"] = head.scale[axis], head.offset[axis]
        row[f"min_{c}"], row[f"max_{c}"] = head.minimum[axis], head.maximum[axis]
    return row


class LasRangeStatsSource(DataSource):
    """Header, and count and bounds of the points, of every byte range.

    The audit reads all points through it but moves one row per range into Spark. A file that
    cannot be read is reported in ``error``. Points are counted by the bytes up to the next block or the
    file's end, whatever number the header announces.
    """

    @classmethod
    def name(cls) -> str:
        return "las_range_stats"

    def schema(self) -> T.StructType:
        return STATS_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return RangeStatsReader(self.options, schema)


class RangeStatsReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.options = options
        self.arrow_schema = to_arrow_schema(schema)

    def partitions(self) -> list[RangePartition]:
        return split_files(list_files(self.options), self.options)

    def read(self, partition: RangePartition | None) -> Iterator[pa.RecordBatch]:
        rows = [self._stats(piece) for piece in partition.ranges] if partition else []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=self.arrow_schema)

    def _stats(self, piece: ByteRange) -> dict:
        file = piece.file
        fs, _ = filesystem(file.root)
        with fs.open_input_file(file.path) as stream:
            try:
                header = parse_header(stream.read(min(MAX_HEADER_BYTES, file.size)), file.name)
            except LasFormatError as e:
                return header_row(file, None, str(e))
            # what the bytes hold, not what the header announces: an undercount shows as well
            held = replace(header, point_count=header.records_held(file.size))
            first, last = point_range(held, piece)
            codec = header.codec()
            lows: dict[str, int] = {}
            highs: dict[str, int] = {}
            for block in point_blocks(stream, header, first, last, BATCH_POINTS, file.name):
                records = codec.records(block, list(COORDINATES))
                for c in COORDINATES:
                    lows[c] = min(lows.get(c, 2**31), int(records[c].min()))
                    highs[c] = max(highs.get(c, -(2**31)), int(records[c].max()))
        row = header_row(file, header)
        row["scanned_points"] = last - first
        for axis, c in enumerate(COORDINATES if lows else ()):
            ends = [raw * codec.scale[axis] + codec.offset[axis] for raw in (lows[c], highs[c])]
            row[f"scanned_min_{c}"], row[f"scanned_max_{c}"] = min(ends), max(ends)
        return row
