"""Golden bytes: headers and records packed by hand, read by the source without Spark."""

import struct

import golden
import numpy as np
import pytest
from pyspark.sql import types as T

from lidarframe import format_schema, point_schema
from lidarframe.sources.headers import HEADER_SCHEMA, LasHeaderSource
from lidarframe.sources.layouts import (
    ATTRIBUTES,
    POINT_FORMATS,
    LasFormatError,
    format_length,
    parse_header,
)
from lidarframe.sources.points import LasDataSource

FLOATS = ("return_point_waveform_location", "parametric_dx", "parametric_dy", "parametric_dz")


def read(schema, **options):
    reader = LasDataSource(options).reader(schema)
    return [row for p in reader.partitions() for b in reader.read(p) for row in b.to_pylist()]


def as_int(value: float) -> int:
    return struct.unpack("<i", struct.pack("<f", value))[0]


@pytest.mark.parametrize("minor,size", [(0, 227), (1, 227), (2, 227), (3, 235), (4, 375)])
def test_header_fields(minor, size):
    data = golden.header(
        minor, 1, 30, 123, gap=9, scale=(0.1, 0.2, 0.3), offset=(1.0, 2.0, 3.0),
        bounds=(60.0, 10.0, 61.0, 11.0, 62.0, 12.0),
    )
    head = parse_header(data, "f")
    assert (head.version, head.header_size, head.point_offset) == (f"1.{minor}", size, size + 9)
    assert (head.n_vlr, head.point_format, head.record_length, head.point_count) == (1, 1, 30, 123)
    assert (head.scale, head.offset) == ((0.1, 0.2, 0.3), (1.0, 2.0, 3.0))
    assert (head.minimum, head.maximum) == ((10.0, 11.0, 12.0), (60.0, 61.0, 62.0))
    assert head.end == size + 9 + 30 * 123


def test_count_of_1_4_is_64_bit():
    assert parse_header(golden.header(4, 6, count=2**33, legacy=0), "f").point_count == 2**33
    assert parse_header(golden.header(4, 1, count=5, legacy=5), "f").point_count == 5
    assert parse_header(golden.header(4, 1, count=0, legacy=7), "f").point_count == 7


def test_formats_have_spec_lengths():
    assert {f: format_length(f) for f in POINT_FORMATS} == golden.LENGTHS


@pytest.mark.parametrize("fmt", POINT_FORMATS)
def test_every_attribute_of_every_format(tmp_path, fmt):
    path = golden.cloud(tmp_path / "a.las", 3, fmt)
    rows = read(format_schema(fmt), path=path)
    expected = dict(golden.VALUES[fmt])
    for name in set(FLOATS) & set(expected):
        expected[name] = as_int(expected[name])
    for i, row in enumerate(rows):
        want = expected | {"x": i * 0.01 + 0.0, "y": -202 * 0.02 + 10.0, "z": 303 * 0.5 + -1.0}
        assert row == want
    assert len(rows) == 3


@pytest.mark.parametrize("fmt", POINT_FORMATS)
def test_each_attribute_alone(tmp_path, fmt):
    path = golden.cloud(tmp_path / "a.las", 2, fmt, extra=3)
    whole = read(format_schema(fmt), path=path)
    for name in POINT_FORMATS[fmt]:
        assert read(point_schema(name), path=path) == [{name: row[name]} for row in whole]


def test_unsigned(tmp_path):
    data = golden.header(2, 2, count=1) + golden.record(2, intensity=65535, r=40000, classification=200)
    path = golden.write(tmp_path / "a.las", data)
    names = ("intensity", "r", "classification")
    assert read(point_schema(*names), path=path) == [{"intensity": -1, "r": -25536, "classification": -56}]
    wide = point_schema(*names, unsigned=True)
    assert [f.dataType for f in wide] == [T.IntegerType(), T.IntegerType(), T.ShortType()]
    assert read(wide, path=path, unsigned="true") == [{"intensity": 65535, "r": 40000, "classification": 200}]


def test_strict_waveform_floats(tmp_path):
    path = golden.cloud(tmp_path / "a.las", 1, 9)
    row = read(point_schema(*FLOATS, strict=True), path=path, strict="true")[0]
    assert row == {n: golden.WAVE_VALUES[n] for n in FLOATS}


def test_declared_type_is_cast_or_refused(tmp_path):
    path = golden.cloud(tmp_path / "a.las", 1)
    assert read(T.StructType().add("intensity", "long"), path=path) == [{"intensity": 404}]
    assert read(T.StructType().add("intensity", "double"), path=path) == [{"intensity": 404.0}]
    with pytest.raises(LasFormatError, match="'intensity' does not fit"):
        read(T.StructType().add("intensity", "byte"), path=path)


def test_field_catalogue():
    assert len(ATTRIBUTES) == 23
    schema = point_schema()
    assert schema.fieldNames() == list(ATTRIBUTES)
    assert not any(f.nullable for f in schema)
    by_type = {}
    for f in schema:
        by_type.setdefault(f.dataType.typeName(), []).append(f.name)
    assert by_type["double"] == ["x", "y", "z", "gps_time"]
    assert by_type["long"] == ["byte_offset_to_waveform_data"]
    assert by_type["integer"] == ["waveform_packet_size_in_bytes", *FLOATS]
    assert by_type["short"] == ["intensity", "point_source_id", "r", "g", "b", "r_n_c_s_s_e", "scan_angle", "nir"]
    assert point_schema("z", "x").fieldNames() == ["z", "x"]
    with pytest.raises(ValueError, match="'nope'"):
        point_schema("nope")
    with pytest.raises(ValueError, match="11"):
        format_schema(11)


@pytest.mark.parametrize(
    "data,message",
    [
        (golden.header(magic=b"LAZZ") + golden.points(1), "not a LAS file"),
        (b"", "not a LAS file"),
        (b"LASF" + bytes(90), "inside the header"),
        (golden.header(4, 6)[:300], "inside the header"),
        (golden.header(fmt=128) + golden.points(1), "LAZ"),
        (golden.header(fmt=11, length=90) + bytes(90), "point format 11"),
        (golden.header(fmt=1, length=20) + golden.points(1), "record length 20"),
        (golden.header(minor=5, size=375) + golden.points(1), "1.5"),
        (golden.header(count=3) + golden.points(2), "announces points"),
        (golden.header(count=3) + golden.points(3)[:-1], "announces points"),
    ],
)
def test_broken_files_name_the_file(tmp_path, data, message):
    path = golden.write(tmp_path / "broken.las", data)
    with pytest.raises(LasFormatError, match=message) as raised:
        read(point_schema("x"), path=path)
    assert path in str(raised.value)


def test_missing_column(tmp_path):
    path = golden.cloud(tmp_path / "a.las", 2)
    with pytest.raises(LasFormatError, match="point format 0 has no column 'gps_time'") as raised:
        read(point_schema("x", "gps_time"), path=path)
    assert path in str(raised.value)
    loose = point_schema("gps_time", "x", nullable=True)
    assert read(loose, path=path, missingColumns="null") == [
        {"gps_time": None, "x": 0.0},
        {"gps_time": None, "x": 0.01},
    ]
    with pytest.raises(LasFormatError, match="non-nullable"):
        read(point_schema("gps_time"), path=path, missingColumns="null")


def test_header_table(tmp_path):
    path = golden.cloud(tmp_path / "a.las", 4, 7, extra=2, gap=5)
    reader = LasHeaderSource({"path": path}).reader(HEADER_SCHEMA)
    (row,) = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert row["path"] == path and row["version"] == "1.4" and row["error"] is None
    assert (row["header_size"], row["point_offset"], row["n_vlr"]) == (375, 380, 1)
    assert (row["point_format"], row["record_length"], row["point_count"]) == (7, 38, 4)
    assert row["file_length"] == 380 + 4 * 38
    assert (row["min_x"], row["max_x"]) == (0.0, 3 * 0.01)
    assert (row["scale_y"], row["offset_y"], row["min_y"]) == (0.02, 10.0, -202 * 0.02 + 10.0)


def test_little_endian_vector():
    # bytes 111, 123, -4, -98 make the int -1627620497
    data = bytes([111, 123, 252, 158])
    assert np.frombuffer(data, "<i4")[0] == -1627620497
