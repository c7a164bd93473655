"""Aggregates over a part of the points: files inside, outside and astride a predicate; curve clustering."""

import random
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lidarframe import las_agg, read_headers, read_las, write_las
from lidarframe.functions.curves import hilbert_keys
from lidarframe.operators.predicates import box_tree, column_names
from lidarframe.sources import boxes
from lidarframe.sources.layouts import parse_header

AGGS = {"n": "count(*)", "low": "min(x)", "high": "max(y)", "mid": "(min(z) + max(z)) / 2", "timed": "count(gps_time)"}


@pytest.fixture(scope="module")
def tiles(spark, tmp_path_factory):
    """Points on an integer grid, a file for each 10 x 10 square, in folders by row of squares; one file without points."""
    path = str(tmp_path_factory.mktemp("tiles") / "las")
    points = spark.range(0, 3600).selectExpr(
        "cast(id % 60 as double) as x", "cast(id div 60 as double) as y", "cast(id % 7 as double) as z",
        "cast(id as double) as gps_time", "cast(id % 3 as byte) as classification",
        "cast(id div 600 as int) as row", "cast(id % 60 div 10 as int) as tile",
    )
    for tile in range(6):
        one = points.where(f"tile = {tile}").drop("tile").coalesce(1)
        write_las(one, path, "append", partition_by=["row"], pointFormat=1)
    return path


def spoil(path, keep):
    """Overwrites the points of all files but those whose header ``keep`` admits; returns how many are spoiled."""
    done = 0
    for file in Path(path).rglob("*.las"):
        data = bytearray(file.read_bytes())
        header = parse_header(bytes(data), str(file))
        if not keep(header):
            data[header.point_offset :] = b"\x7f" * (len(data) - header.point_offset)
            file.write_bytes(data)
            done += 1
    return done


WHERES = [
    "x > 14.5",
    "x >= 10 and x < 30 and y between 5 and 40",
    "not (x > 20 or y <= 12.25)",
    "x in (3, 11, 57) and z < 100",
    "x = 3",
    "x <> 3 and y > 100",
    "1 = 0",
    "1 = 1",
    "x > 10 and classification = 1",
    "row = 2",
    "row >= 2 and x > 25",
    "row = 2 or x > 45",
    "row in (1, 2) and row is not null and x < 35 and _path like '%las'",
    "abs(x) < 12",
    "20 > x and -y < -3",
    "x in (1,2,3,4,5,6,7,8,9,10,11,12,13)",
    "x > y",
    "x > 10 and z > null",
]


@pytest.mark.parametrize("group_by", [[], ["row"]])
@pytest.mark.parametrize("where", WHERES)
def test_same_as_scan(spark, tiles, where, group_by):
    found = las_agg(spark, tiles, AGGS, where=where, group_by=group_by)
    scan = las_agg(spark, tiles, AGGS, where=where, group_by=group_by, verify=True)
    assert found.columns == scan.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, scan.collect()))


def copied(tiles, tmp_path):
    import shutil

    path = tmp_path / "copy"
    shutil.copytree(tiles, path)
    return str(path)


def test_points_of_files_inside_and_outside_are_not_read(spark, tiles, tmp_path):
    path = copied(tiles, tmp_path)
    where = "x > 14.5 and x < 44 and y < 35"
    want = las_agg(spark, tiles, AGGS, where=where).first()

    def astride(h):
        return h.minimum[0] < 14.5 < h.maximum[0] or h.minimum[0] < 44 <= h.maximum[0] or h.minimum[1] < 35 <= h.maximum[1]

    assert spoil(path, astride) >= 18
    assert las_agg(spark, path, AGGS, where=where).first() == want
    assert las_agg(spark, path, AGGS, where=where, verify=True).first() != want


def test_folders_alone_need_headers_alone(spark, tiles, tmp_path):
    found = las_agg(spark, tiles, AGGS, where="row % 2 = 1 or row is null", group_by=["row"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "las_headers" in plan and plan.count("BatchScan") == 1
    path = copied(tiles, tmp_path)
    assert spoil(path, lambda h: False) == 36
    same = las_agg(spark, path, AGGS, where="row % 2 = 1 or row is null", group_by=["row"])
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, found.collect())) != []


def test_trusted_bounds_skip_files_of_a_scan(spark, tiles, tmp_path):
    path = copied(tiles, tmp_path)
    want = read_las(spark, tiles, ["x", "y"], where="x < 5 and classification = 1").collect()
    spoil(path, lambda h: h.minimum[0] < 5)
    assert sorted(read_las(spark, path, ["x", "y"], where="x < 5 and classification = 1", trustBounds=True).collect()) == sorted(want)


def test_missing_columns_are_told_alike(spark, tiles, tmp_path):
    path = copied(tiles, tmp_path)
    write_las(spark.range(1).selectExpr("1D as x", "2D as y", "3D as z"), f"{path}/row=0", "append", pointFormat=0)
    for where in ("x > -5", "x > 30"):
        with pytest.raises(Exception, match="no column"):
            las_agg(spark, path, {"n": "count(gps_time)"}, where=where).collect()
        found = las_agg(spark, path, AGGS, where=where, missingColumns="null").first()
        assert found == las_agg(spark, path, AGGS, where=where, verify=True, missingColumns="null").first()


NUMBERS = st.integers(-3, 6)
LEAVES = st.one_of(
    st.tuples(st.sampled_from(["<", "<=", ">", ">=", "="]), st.sampled_from("xyz"), NUMBERS).map(list),
    st.tuples(st.just("in"), st.sampled_from("xyz"), st.lists(NUMBERS, max_size=3)).map(list),
    st.just(["unknown"]),
)
TREES = st.recursive(
    LEAVES,
    lambda t: st.one_of(st.lists(t, max_size=3).map(lambda p: ["and", *p]), st.lists(t, max_size=3).map(lambda p: ["or", *p]), t.map(lambda p: ["not", p])),
    max_leaves=8,
)


def holds(tree, point, unknown):
    kind, *parts = tree
    if kind == "unknown":
        return unknown
    if kind == "not":
        return not holds(parts[0], point, unknown)
    if kind in ("and", "or"):
        return (all if kind == "and" else any)(holds(p, point, unknown) for p in parts)
    v = point["xyz".index(parts[0])]
    if kind == "in":
        return v in parts[1]
    return {"<": v < parts[1], "<=": v <= parts[1], ">": v > parts[1], ">=": v >= parts[1], "=": v == parts[1]}[kind]


class Head:
    point_count, scale = 1, (0.25, 0.0, 0.5)

    def __init__(self, ends):
        self.minimum, self.maximum = ([min(e) for e in ends], [max(e) for e in ends])


@settings(max_examples=400, deadline=None)
@given(TREES, st.tuples(*[st.tuples(NUMBERS, NUMBERS)] * 3), st.randoms())
def test_relation_like_all_points(tree, ends, rng):
    head = Head(ends)
    found = boxes.relation(tree, head)
    points = [[rng.randint(min(e), max(e)) for e in ends] for _ in range(30)]
    seen = {holds(tree, p, u) for p in points for u in (True, False)}
    if found == boxes.INSIDE:
        assert seen == {True} and boxes.decidable(tree)[0]
    if found == boxes.OUTSIDE:
        assert seen == {False} and boxes.decidable(tree)[1]


def test_trees_and_names(spark):
    assert box_tree(spark, "NOT (x > 2 * 3) AND 1 <= y") == ["and", ["<=", "x", 6.0], [">=", "y", 1.0]]
    assert box_tree(spark, "x > y OR z = 'NaN'") == ["or", ["unknown"], ["unknown"]]
    assert column_names(spark, ["cast(`a b` AS bigint) AS c", "count(DISTINCT x) + min(t.y) + count(*)"]) == {"a b", "x", "y"}


@pytest.mark.parametrize("axes,bits", [(1, 5), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    keys = hilbert_keys(list(cells.T), bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_small_boxes_touch_few_files(spark, tmp_path):
    points = spark.range(0, 40_000).selectExpr("rand(1) * 1000 as x", "pow(rand(2), 3) * 1000 as y", "rand(3) as z")
    touched = {}
    for name, how in {"curve": {"curve_by": ["x", "y"]}, "strips": {"cluster_by": ["x", "y"]}}.items():
        path = str(tmp_path / name)
        write_las(points, path, num_partitions=60, **how)
        headers = read_headers(spark, path).collect()
        rng, share = random.Random(1), []
        for _ in range(50):
            x, y = rng.uniform(0, 900), rng.uniform(0, 900)
            hit = [h for h in headers if h.min_x <= x + 60 and h.max_x >= x and h.min_y <= y + 60 and h.max_y >= y]
            share.append(len(hit) / len(headers))
        touched[name] = share
        assert sum(h.point_count for h in headers) == 40_000 and len(headers) == 60
    assert max(touched["curve"]) <= 0.2


def test_curve_over_copies_nulls_and_nothing(spark, tmp_path):
    same = spark.range(0, 4000).selectExpr("5D as x", "6D as y", "7D as z", "cast(id as double) as gps_time")
    write_las(same, str(tmp_path / "same"), curve_by=["x", "y", "z"], num_partitions=8, pointFormat=1)
    counts = [h.point_count for h in read_headers(spark, str(tmp_path / "same")).collect()]
    assert sum(counts) == 4000 and max(counts) < 1500
    write_las(same.limit(0), str(tmp_path / "none"), curve_by=["x"], pointFormat=1)
    with pytest.raises(ValueError, match="curve_by"):
        write_las(same, str(tmp_path / "both"), curve_by=["x"], cluster_by=["x"])


def test_folders_ruled_out_are_not_opened(spark, tiles, tmp_path):
    path = copied(tiles, tmp_path)
    (Path(path) / "row=9").mkdir()
    (Path(path) / "row=9" / "junk.las").write_bytes(b"junk")
    for where in ("row < 9", "row < 9 and x > 14.5", "row + 1 in (3, 4) and x > 5"):
        assert las_agg(spark, path, AGGS, where=where).first() == las_agg(spark, tiles, AGGS, where=where, verify=True).first()


def test_a_query_is_planned_from_one_listing(spark, tiles, monkeypatch):
    from lidarframe.sources import files

    calls = []
    real = files._list_files
    monkeypatch.setattr(files, "_list_files", lambda options: (calls.append(1), real(options))[1])
    found = las_agg(spark, tiles, AGGS, where="row in (1, 2) and x < 35.5", group_by=["row"])
    assert len(calls) == 1  # here; Spark's planner lists once more for each source
    assert read_las(spark, tiles, ["x", "row"], where="row = 1").columns == ["x", "row"] and len(calls) == 2
    assert len(found.collect()) == 2
