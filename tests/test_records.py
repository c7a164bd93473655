"""Packed records in a table column."""

import golden
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarframe import decode_points, encode_points, read_las
from lidarframe.sources.layouts import POINT_FORMATS

SCALE, OFFSET = (0.01, 0.02, 0.5), (0.0, 10.0, -1.0)


@pytest.mark.parametrize("fmt", POINT_FORMATS)
def test_decode_and_encode_equal_hand_packed(spark, tmp_path, fmt):
    rows = [(i, bytearray(golden.record(fmt, x=i))) for i in range(20)]
    packed = spark.createDataFrame(rows, "id long, record binary")
    points = decode_points(packed, "record", fmt, scale=SCALE, offset=OFFSET)
    assert points.columns == ["id", *POINT_FORMATS[fmt]]
    path = golden.cloud(tmp_path / "a.las", 20, fmt)
    scanned = read_las(spark, path, POINT_FORMATS[fmt])
    assert points.drop("id").orderBy("x").collect() == scanned.orderBy("x").collect()
    again = encode_points(points, fmt, scale=SCALE, offset=OFFSET, keep=["id"])
    assert {(r["id"], bytes(r["record"])) for r in again.collect()} == {(i, bytes(b)) for i, b in rows}


def test_nulls_subsets_and_lengths(spark):
    rows = [(1, bytearray(golden.record(1, x=5) + b"zz")), (2, None), (3, bytearray(golden.record(1, x=7) + b"zz"))]
    packed = spark.createDataFrame(rows, "id int, record binary")
    points = decode_points(packed, "record", 1, columns=["gps_time", "x"], record_length=30, scale=1)
    assert points.schema["x"].dataType == T.DoubleType()
    assert [tuple(r) for r in points.orderBy("id").collect()] == [
        (1, 1234.5, 5.0), (2, None, None), (3, 1234.5, 7.0),
    ]
    with pytest.raises(Exception, match="30 bytes instead of 28"):
        decode_points(packed, "record", 1).collect()
    with pytest.raises(ValueError, match="no column 'nir'"):
        decode_points(packed, "record", 1, columns=["nir"])
    with pytest.raises(ValueError, match="already present"):
        decode_points(packed.withColumnRenamed("id", "x"), "record", 1)
    only_null = decode_points(packed.where("id = 2"), "record", 1, columns=["x"])
    assert only_null.collect() == [(2, None)]
    assert decode_points(packed.where("id = 9"), "record", 1).count() == 0


def test_encode_refuses(spark):
    base = spark.range(3).select(*[F.lit(1.0).alias(c) for c in "xyz"])
    with pytest.raises(Exception, match="null"):
        encode_points(base.withColumn("x", F.expr("cast(null as double)")), 0).collect()
    with pytest.raises(Exception, match="does not fit"):
        encode_points(base.withColumn("intensity", F.lit(70000)), 0).collect()
    with pytest.raises(ValueError, match="'z' is required"):
        encode_points(base.drop("z"), 0)
    with pytest.raises(ValueError, match="point format 12"):
        encode_points(base, 12)


def test_missing_attributes_are_zero(spark):
    base = spark.range(1).select(*[F.lit(1.0).alias(c) for c in "xyz"])
    (row,) = encode_points(base, 3).collect()
    assert bytes(row["record"]) == bytes([100, 0, 0, 0] * 3) + bytes(22)
