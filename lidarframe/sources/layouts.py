"""Byte layouts of LAS files: public header, point records, point attributes.

Everything is expressed as numpy structured dtypes, so one block of bytes turns into columns
without a per-point step. The same dtypes serve the scan, the sink and the record functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

# Fixed values (ASPRS LAS 1.0-1.4): attribute name, type on disk, column type by default.
ATTRIBUTES = {
    "x": ("i4", "double"),
    "y": ("i4", "double"),
    "z": ("i4", "double"),
    "intensity": ("u2", "short"),
    "r_n_s_e": ("u1", "byte"),
    "classification": ("u1", "byte"),
    "scan_angle_rank_left_side": ("i1", "byte"),
    "user_data": ("u1", "byte"),
    "point_source_id": ("u2", "short"),
    "gps_time": ("f8", "double"),
    "r": ("u2", "short"),
    "g": ("u2", "short"),
    "b": ("u2", "short"),
    "wave_packet_descriptor_index": ("u1", "byte"),
    "byte_offset_to_waveform_data": ("u8", "long"),
    "waveform_packet_size_in_bytes": ("u4", "int"),
    "return_point_waveform_location": ("f4", "int"),
    "parametric_dx": ("f4", "int"),
    "parametric_dy": ("f4", "int"),
    "parametric_dz": ("f4", "int"),
    "r_n_c_s_s_e": ("u2", "short"),
    "scan_angle": ("i2", "short"),
    "nir": ("u2", "short"),
}

# Fixed values (ASPRS LAS 1.0-1.4): attribute order of the point formats.
_CORE = "x y z intensity r_n_s_e classification scan_angle_rank_left_side user_data point_source_id".split()
_CORE_EXTENDED = (
    "x y z intensity r_n_c_s_s_e classification user_data scan_angle point_source_id gps_time".split()
)
_RGB = ["r", "g", "b"]
_WAVE = (
    "wave_packet_descriptor_index byte_offset_to_waveform_data waveform_packet_size_in_bytes "
    "return_point_waveform_location parametric_dx parametric_dy parametric_dz"
).split()
POINT_FORMATS = {
    0: _CORE,
    1: _CORE + ["gps_time"],
    2: _CORE + _RGB,
    3: _CORE + ["gps_time"] + _RGB,
    4: _CORE + ["gps_time"] + _WAVE,
    5: _CORE + ["gps_time"] + _RGB + _WAVE,
    6: _CORE_EXTENDED,
    7: _CORE_EXTENDED + _RGB,
    8: _CORE_EXTENDED + _RGB + ["nir"],
    9: _CORE_EXTENDED + _WAVE,
    10: _CORE_EXTENDED + _RGB + ["nir"] + _WAVE,
}

# Fixed values (ASPRS LAS 1.0-1.4): public header block, little-endian, no padding.
_HEADER_1_0 = [
    ("signature", "S4"),
    ("file_source_id", "<u2"),
    ("global_encoding", "<u2"),
    ("project_id", "V16"),
    ("version_major", "u1"),
    ("version_minor", "u1"),
    ("system_identifier", "S32"),
    ("generating_software", "S32"),
    ("creation_day", "<u2"),
    ("creation_year", "<u2"),
    ("header_size", "<u2"),
    ("point_offset", "<u4"),
    ("n_vlr", "<u4"),
    ("point_format", "u1"),
    ("record_length", "<u2"),
    ("legacy_count", "<u4"),
    ("legacy_by_return", "<u4", 5),
    ("scale", "<f8", 3),
    ("offset", "<f8", 3),
    ("bounds", "<f8", (3, 2)),  # (max, min) of x, then y, then z
]
_HEADER_1_3 = _HEADER_1_0 + [("waveform_offset", "<u8")]
_HEADER_1_4 = _HEADER_1_3 + [
    ("evlr_offset", "<u8"),
    ("n_evlr", "<u4"),
    ("point_count", "<u8"),
    ("by_return", "<u8", 15),
]
HEADER_DTYPES = {minor: np.dtype(_HEADER_1_0) for minor in (0, 1, 2)}
HEADER_DTYPES[3] = np.dtype(_HEADER_1_3)
HEADER_DTYPES[4] = np.dtype(_HEADER_1_4)
MAX_HEADER_BYTES = HEADER_DTYPES[4].itemsize

COORDINATES = ("x", "y", "z")
PATH_COLUMN = "_path"
WAVE_COLUMN = "_waveform"  # a point's waveform packet
POINT_COLUMN = "_point"  # a constant byte per point, known without reading points
COMPRESSED_BIT = 0x80
LEGACY_COUNT_LIMIT = 2**32 - 1

_SPARK_TYPES = {
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}
_WIDENED = {"u1": "short", "u2": "int", "u4": "long"}


class LasFormatError(ValueError):
    """A file that is not readable as LAS; the message names the file."""


def stored_dtype(name: str, unsigned: bool, strict: bool) -> str:
    """numpy type through which an attribute is read from and written to its bytes."""
    disk = ATTRIBUTES[name][0]
    if disk == "f4" and not strict:
        return "<i4"
    if disk[0] == "u" and not (unsigned and disk in _WIDENED):
        return "<i" + disk[1]
    return "<" + disk


def column_type(name: str, unsigned: bool = False, strict: bool = False, exact: int | None = None) -> T.DataType:
    disk, default = ATTRIBUTES[name]
    if exact is not None and name in COORDINATES:
        return T.DecimalType(18, exact)
    if strict and disk == "f4":
        default = "float"
    if unsigned and disk in _WIDENED:
        default = _WIDENED[disk]
    return _SPARK_TYPES[default]


def format_length(point_format: int) -> int:
    return sum(int(ATTRIBUTES[n][0][1]) for n in POINT_FORMATS[point_format])


def record_dtype(
    point_format: int,
    record_length: int | None = None,
    names: list[str] | None = None,
    unsigned: bool = False,
    strict: bool = False,
) -> np.dtype:
    """dtype of one record; with ``names`` it holds those attributes only, at their byte offsets."""
    offsets, at = {}, 0
    for name in POINT_FORMATS[point_format]:
        offsets[name] = at
        at += int(ATTRIBUTES[name][0][1])
    wanted = POINT_FORMATS[point_format] if names is None else names
    return np.dtype(
        {
            "names": list(wanted),
            "formats": [stored_dtype(n, unsigned, strict) for n in wanted],
            "offsets": [offsets[n] for n in wanted],
            "itemsize": record_length or at,
        }
    )


@dataclass(frozen=True)
class PointCodec:
    """Bytes <-> Arrow columns for one point format, scale and offset."""

    point_format: int
    record_length: int
    scale: tuple[float, float, float]
    offset: tuple[float, float, float]
    unsigned: bool = False
    strict: bool = False

    def has(self, name: str) -> bool:
        return name in POINT_FORMATS[self.point_format]

    def records(self, data, names: list[str]) -> np.ndarray:
        return np.frombuffer(
            data,
            record_dtype(self.point_format, self.record_length, names, self.unsigned, self.strict),
        )

    def column(self, records: np.ndarray, name: str, arrow_type: pa.DataType) -> pa.Array:
        values = np.ascontiguousarray(records[name])
        if name in COORDINATES:
            axis = COORDINATES.index(name)
            if pa.types.is_decimal(arrow_type):
                return exact_coordinates(values, self.scale[axis], self.offset[axis], arrow_type)
            values = values * self.scale[axis] + self.offset[axis]
        array = pa.array(values)
        return array if array.type == arrow_type else array.cast(arrow_type)

    def encode(self, columns: dict[str, pa.Array], rows: int) -> np.ndarray:
        """Packed records; attributes of the format that are not given are written as zero."""
        dtype = record_dtype(
            self.point_format, self.record_length, None, self.unsigned, self.strict
        )
        records = np.zeros(rows, dtype)
        for name, array in columns.items():
            if array.null_count:
                raise ValueError(f"column {name!r} holds null; LAS attributes cannot be null")
            if name in COORDINATES:
                records[name] = self._quantise(name, array)
                continue
            target = pa.from_numpy_dtype(dtype[name])
            try:
                records[name] = array.cast(target).to_numpy(zero_copy_only=False)
            except pa.ArrowInvalid as e:
                raise ValueError(f"column {name!r} does not fit {target} of the format: {e}") from e
        return records

    def _quantise(self, name: str, array: pa.Array) -> np.ndarray:
        axis = COORDINATES.index(name)
        values = array.cast(pa.float64()).to_numpy(zero_copy_only=False)
        raw = np.rint((values - self.offset[axis]) / self.scale[axis])
        limit = np.iinfo(np.int32)
        bad = ~((raw >= limit.min) & (raw <= limit.max))
        if bad.any():
            raise ValueError(
                f"column {name!r}: value {values[bad][0]!r} does not fit a 32-bit coordinate with "
                f"scale {self.scale[axis]} and offset {self.offset[axis]}"
            )
        return raw.astype("<i4")


def exact_coordinates(raw: np.ndarray, scale: float, offset: float, kind: pa.Decimal128Type) -> pa.Array:
    """raw * scale + offset as decimals, with scale and offset read as the decimal numbers that they are written as."""
    unit = Decimal(1).scaleb(-kind.scale)
    step, start = (Decimal(repr(v)) / unit for v in (scale, offset))
    if step != step.to_integral_value() or start != start.to_integral_value():
        raise pa.ArrowInvalid(f"scale {scale} and offset {offset} need more than {kind.scale} digits after the point")
    ends = [int(step) * int(r) + int(start) for r in ((raw.min(), raw.max()) if len(raw) else ())]
    if any(abs(e) >= min(10**kind.precision, 2**63) for e in ends):
        raise pa.ArrowInvalid(f"coordinates need more than {min(kind.precision, 18)} digits")
    low = raw.astype(np.int64) * int(step) + int(start)
    words = np.stack([low, low >> 63], 1)  # 128 bits, the lower half first
    return pa.Array.from_buffers(kind, len(raw), [None, pa.py_buffer(np.ascontiguousarray(words))])


@dataclass(frozen=True)
class Header:
    """The parsed values of one public header block."""

    version: str
    header_size: int
    point_offset: int
    n_vlr: int
    point_format: int
    record_length: int
    point_count: int
    scale: tuple[float, float, float]
    offset: tuple[float, float, float]
    minimum: tuple[float, float, float]
    maximum: tuple[float, float, float]
    waveform_offset: int = 0  # of the record that holds the waveform packets, 0 if the file has none
    waveforms_outside: bool = False  # in a file of the same name that ends in .wdp
    next_block: int = 0  # where the first block after the points begins, 0 if the file has none

    def records_held(self, file_length: int) -> int:
        """Whole records in the bytes between the point offset and the next block or the file's end."""
        end = min(file_length, self.next_block) if self.next_block else file_length
        return max(0, end - self.point_offset) // self.record_length

    @property
    def end(self) -> int:
        """First byte after the last point."""
        return self.point_offset + self.record_length * self.point_count

    def codec(self, unsigned: bool = False, strict: bool = False) -> PointCodec:
        return PointCodec(
            self.point_format, self.record_length, self.scale, self.offset, unsigned, strict
        )


def parse_header(data: bytes, path: str) -> Header:
    """Read the leading bytes of a file; ``path`` only goes into error messages."""
    base = HEADER_DTYPES[0]
    if data[:4] != b"LASF":
        raise LasFormatError(f"{path}: not a LAS file (signature {bytes(data[:4])!r})")
    if len(data) < base.itemsize:
        raise LasFormatError(f"{path}: file ends inside the header")
    head = np.frombuffer(data, base, 1)[0]
    major, minor = int(head["version_major"]), int(head["version_minor"])
    if major != 1 or minor not in HEADER_DTYPES:
        raise LasFormatError(f"{path}: LAS version {major}.{minor} is not supported")
    point_format = int(head["point_format"])
    if point_format & COMPRESSED_BIT:
        raise LasFormatError(f"{path}: compressed points (LAZ) are not supported")
    if point_format not in POINT_FORMATS:
        raise LasFormatError(f"{path}: unknown point format {point_format}")
    length, needed = int(head["record_length"]), format_length(point_format)
    if length < needed:
        raise LasFormatError(
            f"{path}: record length {length} is below the {needed} bytes of point format {point_format}"
        )
    count = int(head["legacy_count"])
    full = HEADER_DTYPES[4]
    if minor >= 4 and int(head["header_size"]) >= full.itemsize:
        if len(data) < full.itemsize:
            raise LasFormatError(f"{path}: file ends inside the header")
        # the 64-bit count rules; some writers fill the legacy count only
        count = int(np.frombuffer(data, full, 1)[0]["point_count"]) or count
    following, waves = [], 0
    if minor >= 3 and int(head["header_size"]) >= HEADER_DTYPES[3].itemsize <= len(data):
        waves = int(np.frombuffer(data, HEADER_DTYPES[3], 1)[0]["waveform_offset"])
        following.append(waves)
    if minor >= 4 and int(head["header_size"]) >= full.itemsize:
        last = np.frombuffer(data, full, 1)[0]
        following.append(int(last["evlr_offset"]) if last["n_evlr"] else 0)
    return Header(
        version=f"{major}.{minor}",
        header_size=int(head["header_size"]),
        point_offset=int(head["point_offset"]),
        n_vlr=int(head["n_vlr"]),
        point_format=point_format,
        record_length=length,
        point_count=count,
        scale=tuple(head["scale"].tolist()),
        offset=tuple(head["offset"].tolist()),
        minimum=tuple(head["bounds"][:, 1].tolist()),
        maximum=tuple(head["bounds"][:, 0].tolist()),
        waveform_offset=waves,
        waveforms_outside=bool(int(head["global_encoding"]) & 4),
        next_block=min((f for f in following if f > int(head["point_offset"])), default=0),
    )


def pack_header(
    minor: int,
    codec: PointCodec,
    point_count: int,
    by_return: np.ndarray,
    minimum: list[float],
    maximum: list[float],
    created: tuple[int, int],
    n_vlr: int = 0,
    vlr_bytes: int = 0,
    waveforms: bool = False,
) -> bytes:
    """Header bytes of a file; ``vlr_bytes`` of variable-length records lie between them and the points,
    ``waveforms`` says that a record of waveform packets follows the points."""
    dtype = HEADER_DTYPES[minor]
    block = np.zeros(1, dtype)
    head = block[0]
    head["signature"] = b"LASF"
    head["version_major"], head["version_minor"] = 1, minor
    head["generating_software"] = b"lidarframe"
    head["creation_year"], head["creation_day"] = created
    head["header_size"] = dtype.itemsize
    head["point_offset"] = dtype.itemsize + vlr_bytes
    head["n_vlr"] = n_vlr
    head["point_format"] = codec.point_format
    head["record_length"] = codec.record_length
    head["scale"], head["offset"] = codec.scale, codec.offset
    head["bounds"][:, 0], head["bounds"][:, 1] = maximum, minimum
    extended = codec.point_format >= 6
    if extended:
        head["global_encoding"] = 1 << 4  # formats 6-10 carry WKT coordinate systems
    if waveforms:
        head["global_encoding"] |= 2  # waveform packets are in this file
        head["waveform_offset"] = int(head["point_offset"]) + point_count * codec.record_length
        if minor >= 4:
            head["evlr_offset"], head["n_evlr"] = head["waveform_offset"], 1
    if not extended and point_count <= LEGACY_COUNT_LIMIT:
        head["legacy_count"] = point_count
        head["legacy_by_return"] = by_return[1:6]
    if minor >= 4:
        head["point_count"] = point_count
        head["by_return"] = by_return[1:16]
    return block.tobytes()
