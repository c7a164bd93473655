"""Coordinates as decimals."""

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lidarframe import las_agg, read_las, write_las
from lidarframe.sources.layouts import exact_coordinates

STEPS = st.sampled_from([0.01, 0.001, 1.0, 0.25, 1e-5, 0.1, 2.5])
STARTS = st.sampled_from([0.0, -1.0, 500000.0, 0.1, -123456.75, 4.2e6])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-(2**31), 2**31 - 1), max_size=20), STEPS, STARTS)
def test_like_decimal_arithmetic(raw, scale, offset):
    kind = pa.decimal128(18, 5)
    found = exact_coordinates(np.array(raw, np.int32), scale, offset, kind)
    found.validate(full=True)
    assert found.to_pylist() == [r * Decimal(repr(scale)) + Decimal(repr(offset)) for r in raw]


def test_limits():
    raw = np.array([2**31 - 1, -5], np.int32)
    with pytest.raises(pa.ArrowInvalid, match="digits after"):
        exact_coordinates(raw, 0.001, 0.0, pa.decimal128(18, 2))
    with pytest.raises(pa.ArrowInvalid, match="digits after"):
        exact_coordinates(raw, 1.0, 1 / 3, pa.decimal128(18, 2))
    with pytest.raises(pa.ArrowInvalid, match="need more than"):
        exact_coordinates(raw, 1e9, 0.0, pa.decimal128(18, 2))
    assert exact_coordinates(raw[:0], 1e9, 0.0, pa.decimal128(18, 2)).to_pylist() == []


@pytest.fixture(scope="module")
def cents(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cents") / "las")
    points = spark.range(0, 1000, 1, 4).selectExpr("id * 0.01D + 0.1D as x", "id * 0.1D as y", "-id * 0.01D as z")
    write_las(points, path, offsetX=0.1, maxPointsPerFile=200)
    return path


def test_reads_and_filters(spark, cents):
    points = read_las(spark, cents, exact=2)
    assert dict(points.dtypes) == {c: "decimal(18,2)" for c in "xyz"}
    assert sorted(r.x for r in points.collect()) == [Decimal(10 + k).scaleb(-2) for k in range(1000)]
    row = points.selectExpr("sum(x) as x", "sum(y) as y", "sum(z) as z").first()
    assert (str(row.x), str(row.y), str(row.z)) == ("5095.00", "49950.00", "-4995.00")
    tests = [(("x", "=", 0.3), 1), (("x", "<=", 0.3), 21), (("x", ">", 0.29), 980), (("x", "in", [0.1, 0.35, 7]), 3), (("x", "<", 1), 90)]
    for test, count in tests:
        assert read_las(spark, cents, ["x"], filters=[test], exact=2).count() == count
    for where, count in (("x = 0.3", 1), ("x <= 0.30", 21), ("y in (0.3, 0.7)", 2)):
        assert read_las(spark, cents, ["x"], where=where, exact=2, trustBounds=True).count() == count
    declared = spark.read.format("las").schema("z DECIMAL(18,3), x DOUBLE").load(cents)
    assert min(r.z for r in declared.collect()) == Decimal("-9.990")


@pytest.mark.parametrize("where", [None, "x < 3.5", "x >= 2.1 and z > -8"])
def test_headers_like_scans(spark, cents, where):
    aggs = {"a": "min(x)", "b": "max(z)", "n": "count(*)", "d": "max(y) - min(y)"}
    found, scan = (las_agg(spark, cents, aggs, where=where, exact=2, verify=v) for v in (False, True))
    assert found.first() == scan.first() and isinstance(found.first().a, Decimal)
    assert dict(found.dtypes)["a"] == dict(scan.dtypes)["a"] == "decimal(18,2)"


def test_too_few_digits(spark, cents):
    for verify in (False, True):
        with pytest.raises(Exception, match="digits"):
            las_agg(spark, cents, {"a": "max(x)"}, exact=1, verify=verify).collect()
