"""The kept index of headers."""

import os
from pathlib import Path

import pytest

from lidarframe import header_index, las_agg, read_headers, read_las, refresh_header_index, write_las

AGGS = {"n": "count(*)", "low": "min(x)", "high": "max(y)"}


def drop(spark, path, start, n=100, **how):
    points = spark.range(start, start + n).selectExpr("cast(id as double) as x", "cast(id % 10 as double) as y", "0D as z")
    write_las(points, path, "append", num_partitions=2, **how)


def same(found, want):
    columns = want.columns
    assert sorted(map(repr, found.select(columns).collect())) == sorted(map(repr, want.collect()))


def close_to_reading(path):
    """Makes the files that are there now unreadable and keeps their lengths and times; returns how to undo it."""
    held = {}
    for file in Path(path).rglob("*.las"):
        stat = file.stat()
        held[file] = (file.read_bytes(), (stat.st_atime_ns, stat.st_mtime_ns))
        file.write_bytes(b"\0" * stat.st_size)
        os.utime(file, ns=held[file][1])

    def undo():
        for file, (data, times) in held.items():
            file.write_bytes(data)
            os.utime(file, ns=times)

    return undo


def test_refresh_opens_what_is_new_alone(spark, tmp_path):
    path, index = str(tmp_path / "las"), str(tmp_path / "index")
    drop(spark, f"{path}/day=1", 0)
    assert header_index(spark, index) is None
    refresh_header_index(spark, path, index)
    undo = close_to_reading(path)
    drop(spark, f"{path}/day=2", 1000)
    found = refresh_header_index(spark, path, index)
    assert found.count() == 4 and found.agg({"max_x": "max"}).first()[0] == 1099
    undo()
    same(found, read_headers(spark, path).drop("day"))


def test_changed_and_vanished_files(spark, tmp_path):
    path, index = str(tmp_path / "las"), str(tmp_path / "index")
    drop(spark, path, 0)
    drop(spark, path, 500)
    refresh_header_index(spark, path, index)
    files = sorted(Path(path).glob("*.las"))
    files[0].unlink()
    drop(spark, str(tmp_path / "other"), 9000, 50)
    os.replace(sorted((tmp_path / "other").glob("*.las"))[0], files[1])
    found = refresh_header_index(spark, path, index)
    assert found.count() == 3
    same(found, read_headers(spark, path))
    assert las_agg(spark, path, AGGS, index=index).first() == las_agg(spark, path, AGGS, verify=True).first()


def test_versions(spark, tmp_path):
    path, index = str(tmp_path / "las"), str(tmp_path / "index")
    versions = lambda: sorted(p.name for p in Path(index).glob("version-*"))
    for k in range(4):
        drop(spark, path, 100 * k)
        refresh_header_index(spark, path, index)
        refresh_header_index(spark, path, index)  # nothing new: no version
    assert versions() == ["version-00000003", "version-00000004"]
    Path(index, "version-00000005").mkdir()  # a refresh that failed
    assert header_index(spark, index).count() == 8
    drop(spark, path, 9000)
    assert refresh_header_index(spark, path, index).count() == 10


@pytest.mark.parametrize("where", [None, "x >= 100 and x < 350.5", "day = 1", "day < 3 and x > 120", "x > 1e9"])
def test_aggregates_open_files_astride_alone(spark, tmp_path, where):
    path, index = str(tmp_path / "las"), str(tmp_path / "index")
    for k in range(5):
        drop(spark, f"{path}/day={k}", 100 * k)
    refresh_header_index(spark, path, index)
    want = las_agg(spark, path, AGGS, where=where, verify=True).first()
    grouped = sorted(map(tuple, las_agg(spark, path, AGGS, where=where, verify=True, group_by=["day"]).collect()))
    astride = {None: (), "x >= 100 and x < 350.5": (0, 1, 3), "day < 3 and x > 120": (1,)}.get(where, ())
    for day in set(range(5)) - set(astride):
        close_to_reading(f"{path}/day={day}")
    assert las_agg(spark, path, AGGS, where=where, index=index).first() == want
    assert sorted(map(tuple, las_agg(spark, path, AGGS, where=where, index=index, group_by=["day"]).collect())) == grouped


def test_scans_leave_out_files_by_the_index(spark, tmp_path):
    path, index = str(tmp_path / "las"), str(tmp_path / "index")
    drop(spark, f"{path}/a", 0)
    drop(spark, f"{path}/b", 1000)
    refresh_header_index(spark, path, index)
    drop(spark, f"{path}/c", 1040)  # not in the index
    close_to_reading(f"{path}/a")
    found = read_las(spark, path, ["x"], where="x >= 1050", trustBounds=True, index=index)
    assert sorted(r.x for r in found.collect()) == sorted([*range(1050, 1100), *range(1050, 1140)])


def test_broken_files(spark, tmp_path):
    path, index = str(tmp_path / "las"), str(tmp_path / "index")
    drop(spark, path, 0)
    Path(path, "bad.las").write_bytes(b"no header")
    with pytest.raises(Exception, match="bad.las"):
        refresh_header_index(spark, path, index)
    assert header_index(spark, index) is None
    found = refresh_header_index(spark, path, index, badFiles="keep")
    assert [bool(r.error) for r in found.orderBy("error").collect()] == [False, False, True]
