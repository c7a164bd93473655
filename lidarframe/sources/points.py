"""The ``las`` data source: LAS files as rows of points (batch read, stream read, write)."""

from __future__ import annotations

import json
import operator
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_type

from lidarframe.sources.boxes import Box
from lidarframe.sources.files import (
    ByteRange,
    FileEntry,
    RangePartition,
    filesystem,
    flag,
    folder_choice,
    list_files,
    partition_fields,
    split_files,
)
from lidarframe.sources.layouts import (
    ATTRIBUTES,
    COORDINATES,
    MAX_HEADER_BYTES,
    PATH_COLUMN,
    POINT_COLUMN,
    POINT_FORMATS,
    WAVE_COLUMN,
    Header,
    LasFormatError,
    column_type,
    parse_header,
)
from lidarframe.sources.waveforms import WAVE_FIELDS, Packets, slices

BATCH_POINTS = 1 << 17
READ_BYTES = 8 << 20
SMALL_BATCH = 1 << 15  # fewer rows are joined with those of the next file
_COMPARISONS = {
    "=": operator.eq,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


class LasDataSource(DataSource):
    """``spark.read.format("las")``; the default schema is x, y, z plus any k=v folder columns."""

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> T.StructType:
        fields = [T.StructField(n, column_type(n), False) for n in COORDINATES]
        return T.StructType(fields + partition_fields(self.options))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PointReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool):
        from lidarframe.sources.writer import LasWriter

        return LasWriter(self.options, schema, overwrite)

    def streamWriter(self, schema: T.StructType, overwrite: bool):
        from lidarframe.sources.writer import LasStreamWriter

        return LasStreamWriter(self.options, schema, overwrite)

    def streamReader(self, schema: T.StructType):
        from lidarframe.streaming.ingest import LasStreamReader

        return LasStreamReader(self.options, schema)


class PointRanges:
    """Turns byte ranges of files into Arrow batches of the declared columns."""

    def __init__(self, options, schema: T.StructType):
        self.schema = schema
        self.arrow_types = {f.name: to_arrow_type(f.dataType) for f in schema}
        self.unsigned = flag(options, "unsigned")
        self.strict = flag(options, "strict")
        missing = str(options.get("missingColumns") or "error").lower()
        if missing not in ("error", "null"):
            raise ValueError(f"missingColumns must be 'error' or 'null', not {missing!r}")
        self.null_missing = missing == "null"
        self.batch_points = int(options.get("batchPoints") or BATCH_POINTS)
        self.trust_bounds = flag(options, "trustBounds")
        bad_files = str(options.get("badFiles") or "fail").lower()
        if bad_files not in ("fail", "skip"):
            raise ValueError(f"badFiles must be 'fail' or 'skip', not {bad_files!r}")
        self.skip_bad = bad_files == "skip"
        self.folders = folder_choice(options)
        self.box = Box(options)
        self.filters = parse_filters(options.get("filters"))
        self.tested = list(dict.fromkeys(name for name, _, _ in self.filters))
        # type in which a filter sees a column: as declared, else as by default
        self.tested_types = {
            n: self.arrow_types.get(n)
            or to_arrow_type(column_type(n, self.unsigned, self.strict) if n in ATTRIBUTES else T.StringType())
            for n in self.tested
        }

    def check_keys(self, files: list[FileEntry]) -> None:
        """Every declared name must be a point attribute, the path column or a k=v folder."""
        known = {PATH_COLUMN, POINT_COLUMN, WAVE_COLUMN, *ATTRIBUTES}
        unknown = [n for n in dict.fromkeys([*self.arrow_types, *self.tested]) if n not in known]
        for file in files if unknown else []:
            present = {key for key, _ in file.keys}
            for name in unknown:
                if name not in present:
                    raise LasFormatError(
                        f"{file.name}: column {name!r} is neither a point attribute nor a k=v folder"
                    )

    def keep_file(self, file: FileEntry) -> bool:
        """Folder pruning: whether the k=v folders of a file pass the filters on them."""
        if self.folders is not None and file.keys not in self.folders:
            return False
        keys = {**dict(file.keys), PATH_COLUMN: file.name}
        for name, test, value in self.filters:
            if name in ATTRIBUTES:
                continue
            if keys[name] is None:
                return False
            if value == []:
                return False
            # an undeclared folder column compares like the value it is compared with
            sample = value[0] if test == "in" else value
            kind = self.arrow_types.get(name) or pa.scalar(sample).type
            try:
                found = pa.scalar(keys[name], pa.string()).cast(kind).as_py()
            except pa.ArrowInvalid:
                found = None
            if isinstance(found, str) != isinstance(sample, str) or found is None:
                raise LasFormatError(f"{file.name}: cannot compare {name}={keys[name]} with {value!r}")
            passed = _passes(np.array([found]), test, value)[0]
            if not passed:
                return False
        return True

    def batches(self, pieces: list[ByteRange]) -> Iterator[pa.RecordBatch]:
        """Batches of all ranges; those of small files or few passing points are joined."""
        small: list[pa.RecordBatch] = []
        rows = 0
        for piece in pieces:
            if self.skip_bad and not readable(piece.file):
                continue
            with open_points(piece.file) as (stream, header):
                for batch in self._decode(stream, header, piece):
                    small.append(batch)
                    rows += batch.num_rows
                    if rows >= SMALL_BATCH or not self.arrow_types or batch.nbytes > READ_BYTES:
                        yield pa.concat_batches(small) if len(small) > 1 else batch
                        small, rows = [], 0
        if small:
            yield pa.concat_batches(small)

    def _decode(self, stream, header: Header, piece: ByteRange) -> Iterator[pa.RecordBatch]:
        path = piece.file.name
        codec = header.codec(self.unsigned, self.strict)
        wanted = [n for n in self.arrow_types if n in ATTRIBUTES and codec.has(n)]
        tested = [n for n in self.tested if n in ATTRIBUTES]
        absent = [n for n in self.arrow_types if n in ATTRIBUTES and not codec.has(n)]
        waves = WAVE_COLUMN in self.arrow_types
        if waves and not codec.has(WAVE_FIELDS[0]):
            absent.append(WAVE_COLUMN)
            waves = False
        lacking = absent + [n for n in tested if not codec.has(n)]
        if lacking and not self.null_missing:
            raise LasFormatError(
                f"{path}: point format {header.point_format} has no column {lacking[0]!r}; "
                "set missingColumns=null to read it as null"
            )
        for name in absent:
            if not self.schema[name].nullable:
                raise LasFormatError(
                    f"{path}: column {name!r} is missing in point format {header.point_format} "
                    "but declared non-nullable"
                )
        filters = [f for f in self.filters if f[0] in ATTRIBUTES]
        if any(not codec.has(n) for n in tested):
            return  # a comparison with null never holds
        if not self.box.takes(header):
            return
        if self.trust_bounds and not all(_within_bounds(f, header) for f in filters):
            return
        decoded = list(dict.fromkeys([*wanted, *tested, *(WAVE_FIELDS if waves else ())]))
        packets = Packets(piece.file, header) if waves else None
        constants = {PATH_COLUMN: path, POINT_COLUMN: "1", **dict(piece.file.keys)}
        first, last = point_range(header, piece)
        if decoded:
            blocks = (
                codec.records(block, decoded)
                for block in point_blocks(stream, header, first, last, self.batch_points, path)
            )
        else:
            # the number of points is all that is needed, not their bytes
            starts = range(first, last, self.batch_points)
            blocks = (np.empty(min(self.batch_points, last - at), "V1") for at in starts)
        if waves:
            blocks = (part for block in blocks for part in slices(block))
        for records in blocks:
            rows = len(records)
            columns: dict[str, pa.Array] = {}
            try:
                if filters:
                    # decode the tested columns first; the rest only for points that pass
                    for name in tested:
                        columns[name] = codec.column(records, name, self.tested_types[name])
                    keep = np.ones(rows, bool)
                    for name, test, value in filters:
                        keep &= _passes(columns[name].to_numpy(zero_copy_only=False), test, value)
                    if not keep.any():
                        continue
                    if not keep.all():
                        records, columns = records[keep], {}
                        rows = len(records)
                for name in wanted:
                    if name not in columns:
                        columns[name] = codec.column(records, name, self.arrow_types[name])
                if waves:
                    columns[WAVE_COLUMN] = packets.column(records, self.arrow_types[WAVE_COLUMN])
            except pa.ArrowInvalid as e:
                raise LasFormatError(f"{path}: column {name!r} does not fit its declared type: {e}") from e
            for name, kind in self.arrow_types.items():
                if name in absent:
                    columns[name] = pa.nulls(rows, kind)
                elif name not in columns:
                    value = pa.scalar(constants.get(name), pa.string()).cast(kind)
                    columns[name] = pa.repeat(value, rows)
            if self.arrow_types:
                yield pa.RecordBatch.from_arrays(
                    [columns[n] for n in self.arrow_types], names=list(self.arrow_types)
                )
            else:
                yield pa.record_batch([pa.nulls(rows)], names=["row"]).select([])
        if waves:
            packets.close()


class PointReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.options = options
        self.points = PointRanges(options, schema)

    def partitions(self) -> list[RangePartition]:
        files = list_files(self.options)
        self.points.check_keys(files)
        kept = [f for f in files if self.points.keep_file(f)]
        if self.options.get("headerIndex") and self.points.box.tree is not None:
            kept = list(_not_ruled_out(kept, json.loads(self.options["headerIndex"]), self.points))
        return split_files(kept, self.options)

    def read(self, partition: RangePartition | None) -> Iterator[pa.RecordBatch]:
        yield from self.points.batches(partition.ranges if partition else [])


def _not_ruled_out(files: list[FileEntry], index: list[str], points: PointRanges) -> Iterator[FileEntry]:
    """Files that a kept header does not leave out; what the index does not know, or knows otherwise, stays."""
    from lidarframe.sources.headers import BoundedRow

    names = ["path", "file_length", "modified_ns", "point_count", "point_format"]
    names += [f"{n}_{c}" for n in ("scale", "min", "max") for c in COORDINATES]
    ruled_out = set()
    for version in index:
        fs, inner = filesystem(version)
        for batch in ds.dataset(inner, filesystem=fs, format="parquet").to_batches(columns=names):
            for row in batch.to_pylist():
                lacking = any(n in ATTRIBUTES and n not in POINT_FORMATS.get(row["point_format"], ()) for n in points.arrow_types)
                if row["point_count"] is None or (lacking and not points.null_missing):
                    continue  # broken, or without a column: the scan must say so
                if not points.box.takes(BoundedRow(row)):
                    ruled_out.add((row["path"], row["file_length"], row["modified_ns"]))
    return (f for f in files if (f.name, f.size, f.mtime_ns) not in ruled_out)


class open_points:
    """Open a file, read its header and check that all announced points are in it."""

    def __init__(self, file: FileEntry):
        self.file = file

    def __enter__(self):
        fs, _ = filesystem(self.file.root)
        self.stream = fs.open_input_file(self.file.path)
        try:
            head = self.stream.read(min(MAX_HEADER_BYTES, self.file.size))
            header = parse_header(head, self.file.name)
            if header.end > self.file.size:
                raise LasFormatError(
                    f"{self.file.name}: file has {self.file.size} bytes, its header announces points "
                    f"up to byte {header.end}"
                )
        except BaseException:
            self.stream.close()
            raise
        return self.stream, header

    def __exit__(self, *exc):
        self.stream.close()


def readable(file: FileEntry) -> bool:
    """Whether a file has a header that holds; asked only where bad files are to be skipped."""
    try:
        with open_points(file):
            return True
    except LasFormatError:
        return False


def point_range(header: Header, piece: ByteRange) -> tuple[int, int]:
    """Points whose first byte lies in the range; neighbours never share or lose a point."""

    def first_at(byte: int) -> int:
        points = -(-(byte - header.point_offset) // header.record_length)
        return min(max(points, 0), header.point_count)

    return first_at(piece.start), first_at(piece.end)


def point_blocks(
    stream, header: Header, first: int, last: int, batch_points: int, path: str
) -> Iterator[pa.Buffer]:
    """Bytes of the points in blocks of at most ``batch_points``; several blocks come from one
    read, since each request to a remote store takes its time."""
    length = header.record_length
    points_per_read = max(1, READ_BYTES // (length * batch_points)) * batch_points
    for at in range(first, last, points_per_read):
        wanted = min(points_per_read, last - at) * length
        stream.seek(header.point_offset + at * length)
        data = stream.read_buffer(wanted)
        if data.size != wanted:
            raise LasFormatError(f"{path}: got {data.size} of {wanted} bytes at point {at}")
        for start in range(0, wanted, batch_points * length):
            yield data.slice(start, min(batch_points * length, wanted - start))


def parse_filters(text: str | None) -> list[tuple[str, str, object]]:
    """The option ``filters``: a JSON list of [column, comparison, value], all of which must hold."""
    filters = []
    for name, test, value in json.loads(text) if text else []:
        test = "=" if test == "==" else test
        values = value if isinstance(value, list) else [value]
        shape_fits = isinstance(value, list) if test == "in" else test in _COMPARISONS and values[0] is value
        kinds = {type(v) for v in values}
        if not shape_fits or not (kinds <= {int, float} or kinds == {str}):
            raise ValueError(f"filter {[name, test, value]} is not a comparison with numbers or texts")
        if name in ATTRIBUTES and str in kinds:
            raise ValueError(f"filter on {name!r} needs numbers, not {value!r}")
        if name == POINT_COLUMN:
            raise ValueError(f"column {name!r} cannot be filtered")
        filters.append((name, test, value))
    return filters


def _passes(values: np.ndarray, test: str, value) -> np.ndarray:
    """Rows for which the comparison holds: floats as doubles, NaN equal to itself and above all
    numbers, as everywhere in Spark; decimals with the decimal number that a value is written as."""
    if values.dtype == object and len(values) and isinstance(values[0], Decimal):
        if test == "in":
            wanted = {Decimal(repr(v)) for v in value}
            return np.array([v in wanted for v in values], bool)
        number = Decimal(repr(value))
        return np.array([_COMPARISONS[test](v, number) if number == number else test in ("<", "<=") for v in values], bool)
    if values.dtype.kind != "f":
        if test == "in":
            return np.isin(values, [v for v in value if v == v]) if value else np.zeros(len(values), bool)
        return _COMPARISONS[test](values, np.inf if value != value else value)
    values = values.astype(np.float64)
    nan = np.isnan(values)
    if test == "in":
        found = np.isin(values, value) if value else np.zeros(len(values), bool)
        return found | (nan & any(v != v for v in value))
    if value != value:
        return _COMPARISONS[test](nan.astype(np.int8), 1)  # numbers are below, NaN is equal
    passed = _COMPARISONS[test](values, value)
    return np.where(nan, _COMPARISONS[test](1, 0), passed)


def _within_bounds(condition: tuple[str, str, object], header: Header) -> bool:
    """Whether a file can hold a passing point, by header bounds widened by one scale step."""
    name, test, value = condition
    if name not in COORDINATES:
        return True
    axis = COORDINATES.index(name)
    slack = abs(header.scale[axis])
    low, high = header.minimum[axis] - slack, header.maximum[axis] + slack
    if test in (">", ">="):
        return high >= value
    if test in ("<", "<="):
        return low <= value
    return any(low <= v <= high for v in (value if test == "in" else [value]))
