"""Packed point records in a table column: bytes to typed columns and back."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lidarframe.functions.fields import point_schema
from lidarframe.operators.session import register
from lidarframe.sources.layouts import POINT_FORMATS, PointCodec, format_length

Triple = float | Sequence[float]


def _codec(point_format, record_length, scale: Triple, offset: Triple, unsigned, strict) -> PointCodec:
    if point_format not in POINT_FORMATS:
        raise ValueError(f"unknown point format {point_format}")

    def triple(value: Triple) -> tuple[float, float, float]:
        return (float(value),) * 3 if isinstance(value, (int, float)) else tuple(map(float, value))

    length = record_length or format_length(point_format)
    if length < format_length(point_format):
        raise ValueError(f"record length {length} is too short for point format {point_format}")
    return PointCodec(point_format, length, triple(scale), triple(offset), unsigned, strict)


def decode_points(
    df: DataFrame,
    column: str,
    point_format: int,
    *,
    scale: Triple = 0.01,
    offset: Triple = 0.0,
    columns: Sequence[str] | None = None,
    record_length: int | None = None,
    unsigned: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Replace a binary column of packed records by typed point columns; other columns stay.

    A null record gives null point columns. ``columns`` limits what is decoded.
    """
    register(df.sparkSession)
    codec = _codec(point_format, record_length, scale, offset, unsigned, strict)
    names = list(columns or POINT_FORMATS[point_format])
    for name in names:
        if not codec.has(name):
            raise ValueError(f"point format {point_format} has no column {name!r}")
    kept = [f for f in df.schema if f.name != column]
    clash = {f.name for f in kept} & set(names)
    if clash:
        raise ValueError(f"columns already present: {', '.join(sorted(clash))}")
    points = point_schema(*names, unsigned=unsigned, strict=strict, nullable=True)
    arrow_types = {f.name: to_arrow_type(f.dataType) for f in points}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(column)
            records = codec.records(_contiguous(packed, codec.record_length), names)
            arrays = [batch.column(f.name) for f in kept]
            rows = None
            if packed.null_count:
                # position of each row's record among the non-null ones
                valid = packed.is_valid().to_numpy(zero_copy_only=False)
                rows = pa.array(np.cumsum(valid) - 1, mask=~valid)
            for name, kind in arrow_types.items():
                array = codec.column(records, name, kind)
                arrays.append(array if rows is None else array.take(rows))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in kept] + names)

    return df.mapInArrow(decode, T.StructType(kept + points.fields))


def _contiguous(packed: pa.Array, length: int) -> pa.Buffer | bytes:
    """The non-null records back to back; without nulls this is the column's own buffer."""
    packed = packed.cast(pa.binary()).drop_null()
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    wrong = np.flatnonzero(np.diff(offsets) != length)
    if len(wrong):
        size = int(np.diff(offsets)[wrong[0]])
        raise ValueError(f"packed record has {size} bytes instead of {length}")
    if not len(packed):
        return b""
    return packed.buffers()[2].slice(int(offsets[0]), len(packed) * length)


def encode_points(
    df: DataFrame,
    point_format: int,
    *,
    column: str = "record",
    scale: Triple = 0.01,
    offset: Triple = 0.0,
    keep: Sequence[str] = (),
    unsigned: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Pack the point columns of a table into one binary column; ``keep`` names columns to carry.

    x, y, z are required, other attributes of the format are zero where the table has no such
    column. A null or a value outside an attribute's range is an error.
    """
    register(df.sparkSession)
    codec = _codec(point_format, None, scale, offset, unsigned, strict)
    names = [n for n in POINT_FORMATS[point_format] if n in df.columns]
    for name in ("x", "y", "z"):
        if name not in names:
            raise ValueError(f"column {name!r} is required to pack points")
    kept = [df.schema[n] for n in keep]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = codec.encode({n: batch.column(n) for n in names}, batch.num_rows)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * codec.record_length
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(records.tobytes())]
            )
            arrays = [batch.column(f.name) for f in kept] + [packed]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in kept] + [column])

    inputs = df.select(*dict.fromkeys([*keep, *names]))
    return inputs.mapInArrow(encode, T.StructType(kept + [T.StructField(column, T.BinaryType(), False)]))
