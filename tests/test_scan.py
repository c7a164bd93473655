"""Listing, splitting, folders and filters of the scan."""

import json
import os

import golden
import numpy as np
import pytest
from pyspark.sql import types as T

from lidarframe import las_agg, las_view, point_schema, read_headers, read_las, register
from lidarframe.sources.files import list_files, split_files
from lidarframe.sources.layouts import LasFormatError
from lidarframe.sources.points import LasDataSource

X = point_schema("x")


def reader_of(schema=X, **options):
    return LasDataSource(options).reader(schema)


def xs(**options):
    reader = reader_of(**options)
    return [x for p in reader.partitions() for b in reader.read(p) for x in b.column("x").to_pylist()]


@pytest.mark.parametrize("split", [1, 19, 20, 21, 97, 100, 227, 1000, 10**6])
@pytest.mark.parametrize("extra,gap,trailing", [(0, 0, 0), (3, 11, 50), (0, 500, 0), (0, 0, 1000)])
def test_splits_never_share_or_lose_a_point(tmp_path, split, extra, gap, trailing):
    path = golden.cloud(tmp_path / "a.las", 57, extra=extra, gap=gap, trailing=trailing)
    if split == 1:
        split = 7  # a range without any first byte of a record
    assert xs(path=path, splitBytes=str(split)) == [i * 0.01 for i in range(57)]


def test_small_batches(tmp_path):
    path = golden.cloud(tmp_path / "a.las", 57)
    assert xs(path=path, batchPoints="10") == [i * 0.01 for i in range(57)]


def test_file_without_points(tmp_path):
    golden.cloud(tmp_path / "a.las", 0)
    golden.cloud(tmp_path / "b.las", 2)
    assert xs(path=str(tmp_path)) == [0.0, 0.01]


def test_small_files_share_tasks_and_large_files_are_cut(tmp_path):
    for i in range(40):
        golden.cloud(tmp_path / f"{i:02}.las", 10)
    few = reader_of(path=str(tmp_path), minSplits="4").partitions()
    assert len(few) == 4 and sum(len(p.ranges) for p in few) == 40
    big = golden.cloud(tmp_path / "big" / "a.las", 200_000)
    files = list_files({"path": big})
    assert len(split_files(files, {"minSplits": "1"})) == 1
    assert len(split_files(files, {"minSplits": "3"})) > 1
    assert len(split_files(files, {"minSplits": "1000", "maxSplits": "2"})) <= 2


def test_listing(tmp_path):
    golden.cloud(tmp_path / "a" / "1.las", 1)
    golden.cloud(tmp_path / "a" / "deep" / "2.las", 2)
    golden.cloud(tmp_path / "b" / "3.las", 3)
    (tmp_path / "a" / "_temporary" / "x").mkdir(parents=True)
    golden.write(tmp_path / "a" / "_temporary" / "x" / "no.las", b"junk")
    golden.write(tmp_path / "a" / ".hidden", b"junk")
    golden.write(tmp_path / "a" / "_SUCCESS", b"")
    golden.write(tmp_path / "b" / "note.txt", b"junk")
    assert len(xs(path=str(tmp_path / "a"))) == 3
    assert len(xs(path=str(tmp_path), pathGlobFilter="*.las")) == 6
    assert len(xs(path=str(tmp_path / "*" / "*.las"))) == 4
    assert len(xs(path=str(tmp_path / "{a,b}" / "[13].las"))) == 4
    assert len(xs(path=f"file://{tmp_path}/a")) == 3
    assert len(xs(path=f"file:{tmp_path}/a/1.las")) == 1
    with pytest.raises(FileNotFoundError, match="nothing"):
        xs(path=str(tmp_path / "nothing"))
    with pytest.raises(FileNotFoundError):
        xs(path=str(tmp_path / "*.none"))


def test_odd_file_names(tmp_path):
    golden.cloud(tmp_path / "a b" / "50% [x].las", 2)
    assert len(xs(path=str(tmp_path))) == 2
    assert len(xs(path=str(tmp_path / "a b"))) == 2
    assert len(xs(path=str(tmp_path / "a b" / "50% [x].las"))) == 2


def test_folder_columns(tmp_path):
    golden.cloud(tmp_path / "day=1" / "name=a%20b" / "1.las", 1)
    golden.cloud(tmp_path / "day=2" / "name=__HIVE_DEFAULT_PARTITION__" / "1.las", 2)
    options = {"path": str(tmp_path)}
    schema = LasDataSource(options).schema()
    assert schema.fieldNames() == ["x", "y", "z", "day", "name"]
    assert schema["day"].dataType == T.IntegerType()
    assert schema["name"].dataType == T.StringType()
    reader = LasDataSource(options).reader(schema)
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted((r["day"], r["name"] or "") for r in rows) == [(1, "a b"), (2, ""), (2, "")]
    with pytest.raises(LasFormatError, match="'town'"):
        LasDataSource(options).reader(schema.add("town", "string")).partitions()


def test_base_path(spark, tmp_path):
    for day in (1, 2, 3):
        golden.cloud(tmp_path / f"day={day}" / "1.las", day)
    some = [str(tmp_path / "day=1"), str(tmp_path / "day=[3-9]" / "*.las")]
    found = read_las(spark, some, basePath=str(tmp_path)).groupBy("day").count().collect()
    assert {tuple(r) for r in found} == {(1, 1), (3, 3)}
    assert "day" not in read_las(spark, some).columns
    with pytest.raises(Exception, match="not below basePath"):
        read_las(spark, some, basePath=str(tmp_path / "day=1")).count()


@pytest.mark.parametrize(
    "values,kind",
    [
        (["1", "2"], T.IntegerType()),
        (["1", "3000000000"], T.LongType()),
        (["1", "2.5"], T.DoubleType()),
        (["01", "2"], T.StringType()),
        (["1", "x"], T.StringType()),
    ],
)
def test_folder_column_types(tmp_path, values, kind):
    for value in values:
        golden.cloud(tmp_path / f"k={value}" / "1.las", 1)
    assert LasDataSource({"path": str(tmp_path)}).schema()["k"].dataType == kind


def test_folder_filter_prunes_files(tmp_path):
    for day in (1, 2, 3, "__HIVE_DEFAULT_PARTITION__"):
        golden.cloud(tmp_path / f"day={day}" / "1.las", 3)

    def days(*filters, schema=point_schema("x").add("day", T.IntegerType())):
        reader = reader_of(schema, path=str(tmp_path), filters=json.dumps(filters))
        return [r.file.keys[0][1] for p in reader.partitions() for r in p.ranges]

    assert days(["day", "=", 2]) == ["2"]
    assert days(["day", "==", 2], schema=point_schema("x")) == ["2"]
    assert days(["day", "=", "2"], schema=point_schema("x")) == ["2"]
    assert days(["day", "in", [1, 3]]) == ["1", "3"]
    assert days(["day", "in", []]) == []
    assert days(["day", ">", 1], ["day", "<=", 2]) == ["2"]
    assert days(["day", ">=", 0]) == ["1", "2", "3"]  # null is never compared
    with pytest.raises(LasFormatError, match="'town'"):
        days(["town", "=", 2])
    golden.cloud(tmp_path / "day=monday" / "1.las", 3)
    with pytest.raises(LasFormatError, match="cannot compare day=monday"):
        days(["day", "=", 2], schema=point_schema("x"))


def test_row_filters_are_exact(tmp_path):
    path = golden.cloud(tmp_path / "a.las", 100, 1)

    def kept(*filters, names=("gps_time", "x"), **options):
        reader = reader_of(point_schema(*names), path=path, filters=json.dumps(filters), **options)
        return sum(b.num_rows for p in reader.partitions() for b in reader.read(p))

    assert kept(["x", ">", 0.5]) == sum(i * 0.01 > 0.5 for i in range(100))
    assert kept(["x", "<=", 0.1], ["intensity", "=", 404]) == 11
    assert kept(["x", "<", 0.1], names=("intensity",)) == 10
    assert kept(["intensity", "=", 405]) == 0
    assert kept(["intensity", ">", 403.5]) == 100
    assert kept(["x", "in", [0.0, 0.01, 77.0]]) == 2
    assert kept(["x", "in", []]) == 0
    assert kept(["x", ">=", 0.98], batchPoints="7", splitBytes="64") == 2
    with pytest.raises(LasFormatError, match="no column 'nir'"):
        kept(["nir", ">", 1])
    assert kept(["nir", ">", 1], missingColumns="null") == 0


@pytest.mark.parametrize(
    "condition",
    [["x", "~", 1], ["x", "=", None], ["x", "=", "a"], ["x", "in", 3], ["x", "=", [1]], ["k", "in", [1, "a"]]],
)
def test_odd_filters_are_refused(tmp_path, condition):
    path = golden.cloud(tmp_path / "a.las", 1)
    with pytest.raises(ValueError, match="filter"):
        reader_of(path=path, filters=json.dumps([condition]))


def test_filters_treat_nan_like_spark(spark, tmp_path):
    data = golden.record(1, gps_time=float("nan")) + golden.record(1, gps_time=3.0)
    path = golden.write(tmp_path / "a.las", golden.header(2, 1, count=2) + data)
    points = read_las(spark, path, ["gps_time"])
    for test in ("<", "<=", "=", ">=", ">"):
        for value in (2.0, 3.0, 5.0):
            filtered = read_las(spark, path, ["x"], filters=[("gps_time", test, value)])
            assert filtered.count() == points.where(f"gps_time {test} {value}D").count()


def test_bounds_skip_only_when_trusted(tmp_path):
    def kept(path, **options):
        reader = reader_of(path=path, filters='[["x", ">", 0.5], ["y", "<", 100]]', **options)
        return sum(b.num_rows for p in reader.partitions() for b in reader.read(p))

    lying = golden.cloud(tmp_path / "a.las", 100, lie=(0.0,) * 6)
    assert kept(lying) == 49
    assert kept(lying, trustBounds="true") == 0
    honest = golden.cloud(tmp_path / "b.las", 100)
    assert kept(honest, trustBounds="true") == 49


def test_mixed_versions_and_formats(spark, tmp_path):
    for i, (fmt, minor) in enumerate([(0, 0), (1, 1), (3, 2), (5, 3), (6, 4), (10, 4), (2, 4)]):
        golden.cloud(tmp_path / f"{i}.las", 10, fmt, minor=minor, first=i * 10)
    points = read_las(spark, str(tmp_path), ["x", "classification"])
    found = points.orderBy("x").collect()
    assert [r["x"] for r in found] == [i * 0.01 for i in range(70)]
    assert {r["classification"] for r in found} == {6}


def test_spark_surface(spark, tmp_path):
    a = golden.cloud(tmp_path / "a.las", 10)
    b = golden.cloud(tmp_path / "b.las", 5, first=100)
    register(spark)
    plain = spark.read.format("las").load([a, b])
    assert plain.columns == ["x", "y", "z"] and plain.count() == 15
    assert read_las(spark, [a, b]).count() == 15
    assert read_las(spark, str(tmp_path), []).columns == []
    assert read_las(spark, str(tmp_path), []).count() == 15
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW v (intensity SHORT, x DOUBLE) USING las OPTIONS (path '{a}')")
    assert spark.sql("SELECT intensity, x FROM v WHERE x > 0.055").count() == 4
    paths = read_las(spark, str(tmp_path), ["_path", "x"]).groupBy("_path").count().collect()
    assert {(os.path.basename(r["_path"]), r["count"]) for r in paths} == {("a.las", 10), ("b.las", 5)}
    with pytest.raises(ValueError, match="'town'"):
        read_las(spark, a, ["town"])
    with pytest.raises(Exception, match="path does not exist"):
        read_las(spark, str(tmp_path / "none"), ["x"]).count()


def test_pruned_files_are_never_opened(spark, tmp_path):
    golden.cloud(tmp_path / "k=good" / "1.las", 3)
    golden.write(tmp_path / "k=bad" / "1.las", b"junk")
    assert read_las(spark, str(tmp_path), ["x", "k"], filters=[("k", "=", "good")]).count() == 3
    assert read_las(spark, str(tmp_path), filters=[("k", "=", "good")]).count() == 3
    with pytest.raises(Exception, match="not a LAS file"):
        read_las(spark, str(tmp_path), ["x", "k"]).count()


def test_where_prunes_folders(spark, tmp_path):
    golden.cloud(tmp_path / "k=1" / "1.las", 300)
    golden.cloud(tmp_path / "k=3" / "1.las", 100)
    golden.write(tmp_path / "k=2" / "1.las", b"junk")
    golden.write(tmp_path / "k=__HIVE_DEFAULT_PARTITION__" / "1.las", b"junk")
    path = str(tmp_path)
    assert read_las(spark, path, ["x", "k"], where="k = 1").count() == 300
    assert read_las(spark, path, where="k % 2 = 1 AND x < 0.095").columns == ["x", "y", "z", "k"]
    both = read_las(spark, path, ["z"], where="k % 2 = 1 AND (x < 0.095 OR k = 3) AND isnotnull(k)")
    assert both.columns == ["z"] and both.count() == 110
    assert read_las(spark, path, [], where="k in (1, 3)").count() == 400
    assert read_las(spark, path, ["x"], where="k > 7").count() == 0
    assert las_agg(spark, path, {"n": "count(*)"}, where="k = 3").first().n == 100
    las_view(spark, "some_points", path, ["x", "k"], where="k <> 2")
    assert spark.sql("select count(*) from some_points where k = 3").first()[0] == 100
    for where in ("k = 1 OR x < 5", "x < 5"):  # says nothing about folders alone
        with pytest.raises(Exception, match="not a LAS file"):
            read_las(spark, path, ["x"], where=where).count()


def test_bad_files_can_be_skipped(spark, tmp_path):
    golden.cloud(tmp_path / "a.las", 300)
    golden.write(tmp_path / "b.las", b"junk")
    whole = (tmp_path / "a.las").read_bytes()
    golden.write(tmp_path / "c.las", whole[:-1])
    path = str(tmp_path)
    assert read_las(spark, path, ["x"], badFiles="skip", splitBytes=1000).count() == 300
    assert read_las(spark, path, [], badFiles="skip").count() == 300
    bad = read_headers(spark, path, badFiles="keep").where("error is not null")
    assert sorted(r.path[-5:] for r in bad.collect()) == ["b.las", "c.las"]
    with pytest.raises(Exception, match="LAS|announces"):
        read_las(spark, path, ["x"]).count()
    with pytest.raises(Exception, match="badFiles"):
        read_las(spark, path, ["x"], badFiles="perhaps").count()


def test_one_scan_serves_several_queries(spark, tmp_path):
    path = golden.cloud(tmp_path / "a.las", 100)
    points = read_las(spark, path, ["x"])
    assert points.where("x < 0.095").count() == 10
    assert points.count() == 100
    both = points.where("x < 0.095").union(points.where("x > 0.895"))
    assert both.count() == 20 and both.where("x > 0.5").count() == 10
    joined = points.where("x < 0.095").join(points.where("x < 0.045"), "x")
    assert joined.count() == 5


def test_columns_known_without_points(spark, tmp_path):
    golden.cloud(tmp_path / "k=1" / "1.las", 300)
    golden.cloud(tmp_path / "k=2" / "1.las", 200)
    counts = read_las(spark, str(tmp_path), ["k"], splitBytes=1000).groupBy("k").count().collect()
    assert {tuple(r) for r in counts} == {(1, 300), (2, 200)}
    bare = spark.read.format("las").schema(T.StructType()).load(str(tmp_path))
    assert bare.count() == 500 and bare.columns == []


def test_remote_paths():
    from lidarframe.sources.files import FileEntry, _uri_parts

    assert _uri_parts("s3a://bucket/a b/*.las?region=x&y=z") == ("s3", "bucket", "/a b/*.las", "?region=x&y=z")
    assert _uri_parts("hdfs://nn:8020/a/?.las") == ("hdfs", "nn:8020", "/a/?.las", "")
    assert FileEntry("hdfs://nn:8020/a", "/a/1.las", 0, 0, ()).name == "hdfs://nn:8020/a/1.las"
    assert FileEntry("s3a://bucket/a", "bucket/a/1.las", 0, 0, ()).name == "s3://bucket/a/1.las"
    assert FileEntry("/data", "/data/1.las", 0, 0, ()).name == "/data/1.las"


def test_comparisons_like_spark(spark):
    from pyspark.sql import functions as F

    from lidarframe.sources.points import _passes

    values = np.array([0.1, -1.0, np.nan, np.inf, 0.5, 0.0], np.float32)
    table = spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "k int, v double").select(
        "k", F.col("v").cast("float").alias("v")
    )
    for test in ("=", "<", "<=", ">", ">="):
        for literal in (0.1, 0.5, float("nan"), float("inf"), 0):
            value = F.lit(float(literal))
            column = F.col("v").cast("double")
            condition = {
                "=": column == value, "<": column < value, "<=": column <= value, ">": column > value, ">=": column >= value
            }[test]
            want = {r.k for r in table.where(condition).collect()}
            assert set(np.flatnonzero(_passes(values, test, literal)).tolist()) == want, (test, literal)
    assert _passes(values, "in", [0.1, float("nan"), 0.5]).tolist() == [False, False, True, False, True, False]
    assert _passes(np.array([1, 2]), "<", float("nan")).all() and not _passes(np.array([1]), "=", float("nan")).any()


def test_filter_on_path(spark, tmp_path):
    kept = golden.cloud(tmp_path / "a.las", 3)
    golden.write(tmp_path / "b.las", b"junk")  # never opened
    assert read_las(spark, str(tmp_path), ["x"], filters=[("_path", "=", kept)]).count() == 3
    with pytest.raises(Exception, match="cannot be filtered"):
        read_las(spark, str(tmp_path), ["x"], filters=[("_point", "=", 1)]).count()
