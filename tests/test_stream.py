"""Streaming ingest: drops, restart, late files."""

import os
import time

import golden
import pytest

from lidarframe import point_schema, stream_las, write_las
from lidarframe.streaming.ingest import LasStreamReader


def ingest(spark, folder, schema=None, **options):
    points = spark.readStream.format("las").schema(schema or point_schema("x", "classification"))
    query = (
        points.options(**options)
        .load(str(folder / "in"))
        .writeStream.format("parquet")
        .option("path", str(folder / "out"))
        .option("checkpointLocation", str(folder / "check"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(r["x"] for r in spark.read.parquet(str(folder / "out")).select("x").collect())


def test_two_drops_and_restarts(spark, tmp_path):
    golden.cloud(tmp_path / "in" / "a.las", 50)
    assert ingest(spark, tmp_path) == [i * 0.01 for i in range(50)]
    assert len(ingest(spark, tmp_path)) == 50  # nothing new
    golden.cloud(tmp_path / "in" / "b.las", 30, 6, first=50)
    late = golden.cloud(tmp_path / "in" / "late.las", 20, 1, first=80)
    os.utime(late, (os.path.getmtime(late) - 3600,) * 2)  # older than what was read already
    assert ingest(spark, tmp_path, splitBytes="100") == [i * 0.01 for i in range(100)]
    assert len(ingest(spark, tmp_path)) == 100


def test_folders_and_filters(spark, tmp_path):
    golden.cloud(tmp_path / "in" / "k=1" / "a.las", 10)
    golden.cloud(tmp_path / "in" / "k=2" / "b.las", 20, first=100)
    golden.write(tmp_path / "in" / "k=3" / "broken.las", b"junk")
    schema = point_schema("x").add("k", "integer")
    wanted = '[["k", "<", 3], ["x", ">=", 0.05]]'
    found = ingest(spark, tmp_path, schema, filters=wanted)
    assert found == [i * 0.01 for i in (*range(5, 10), *range(100, 120))]


def test_schema_by_default(spark, tmp_path):
    golden.cloud(tmp_path / "in" / "a.las", 1)
    assert spark.readStream.format("las").load(str(tmp_path / "in")).columns == ["x", "y", "z"]


def reader(folder, **options):
    return LasStreamReader({"path": str(folder), **options}, point_schema("x"))


def taken(r, start, end):
    return sorted(os.path.basename(p.file.path) for part in r.partitions(start, end) for p in part.ranges)


def test_offsets(tmp_path):
    for i, name in enumerate(["a", "b", "c"]):
        path = golden.cloud(tmp_path / f"{name}.las", 1)
        os.utime(path, (1000 + i,) * 2)
    r = reader(tmp_path)
    none = r.initialOffset()
    first = r.latestOffset()
    assert first == reader(tmp_path).latestOffset()  # a function of the listing
    assert taken(r, none, first) == ["a.las", "b.las", "c.las"]
    assert taken(r, first, first) == []
    path = golden.cloud(tmp_path / "same.las", 1)
    os.utime(path, (1002,) * 2)  # same time as the newest
    second = r.latestOffset()
    assert taken(r, first, second) == ["same.las"]
    assert taken(r, none, first) == ["a.las", "b.las", "c.las"]  # replay of the first batch
    os.remove(tmp_path / "same.las")
    with pytest.raises(FileNotFoundError):
        r.partitions(first, second)


def test_age_window(tmp_path):
    for i, name in enumerate(["a", "b", "c"]):
        path = golden.cloud(tmp_path / f"{name}.las", 1)
        os.utime(path, (1000 + 100 * i,) * 2)
    r = reader(tmp_path, maxFileAge="50")
    first = r.latestOffset()
    assert len(first["seen"]) == 1  # the offset stays small
    assert taken(r, r.initialOffset(), first) == ["a.las", "b.las", "c.las"]
    inside = golden.cloud(tmp_path / "inside.las", 1)
    os.utime(inside, (1180,) * 2)
    newest = golden.cloud(tmp_path / "newest.las", 1)
    os.utime(newest, (1400,) * 2)
    assert taken(r, first, r.latestOffset()) == ["inside.las", "newest.las"]


def drain(frame, tmp_path):
    query = (
        frame.writeStream.format("parquet")
        .option("path", str(tmp_path / "table"))
        .option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def test_file_stream_takes_files_of_any_time(spark, tmp_path):
    folder = tmp_path / "in"

    def arrive(name, count, age):
        path = golden.cloud(folder / name, count)
        os.utime(path, (time.time() - age,) * 2)

    def ingest():
        return drain(stream_las(spark, str(folder), ["x"], max_files_per_trigger=1, split_bytes=512), tmp_path)

    arrive("a.las", 50, 0)
    ingest()
    arrive("old.las", 20, 30 * 86400)
    arrive("future.las", 5, -86400)
    assert len(ingest().recentProgress) >= 2
    arrive("today.las", 7, 0)
    ingest()
    ingest()  # nothing new
    assert spark.read.parquet(str(tmp_path / "table")).count() == 82


def test_file_stream_filters_and_reports_lost_files(spark, tmp_path):
    path = golden.cloud(tmp_path / "in" / "a.las", 10)
    frame = stream_las(spark, str(tmp_path / "in"), ["x"], filters='[["x", ">=", 0.05]]')
    drain(frame, tmp_path)
    assert spark.read.parquet(str(tmp_path / "table")).count() == 5
    golden.cloud(tmp_path / "in" / "b.las", 10)
    with open(tmp_path / "in" / "b.las", "r+b") as f:
        f.truncate(300)
    with pytest.raises(Exception, match="announces points"):
        drain(frame, tmp_path)
    assert os.path.exists(path)


def test_las_stream_source_without_age_takes_old_files(tmp_path):
    golden.cloud(tmp_path / "a.las", 1)
    r = reader(tmp_path)
    first = r.latestOffset()
    old = golden.cloud(tmp_path / "old.las", 1)
    os.utime(old, (1000,) * 2)
    assert taken(r, first, r.latestOffset()) == ["old.las"]
    far = golden.cloud(tmp_path / "far.las", 1)
    os.utime(far, (time.time() + 10**6,) * 2)
    aged = reader(tmp_path, maxFileAge="3600")
    before = aged.latestOffset()
    golden.cloud(tmp_path / "new.las", 1)
    assert taken(aged, before, aged.latestOffset()) == ["new.las"]


def test_stream_with_folders_paths_and_types(spark, tmp_path):
    inbox = tmp_path / "in"
    points = spark.range(12).selectExpr("cast(id as double) as x", "0D as y", "0D as z", "cast(id % 3 as int) as day", "if(id < 6, null, 'é=b') as name")
    write_las(points, str(inbox), partition_by=["day", "name"])

    def run(name, **how):
        query = (
            stream_las(spark, str(inbox), ["name", "x", "day", "_path"], **how)
            .writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.table(name)

    found = run("folders", pathGlobFilter="*.las")
    assert dict(found.dtypes)["day"] == "int"
    want = sorted((int(r.x), r.day, r.name) for r in points.collect())
    assert sorted((int(r.x), r.day, r.name) for r in found.collect()) == want
    assert all(f"/day={r.day}/" in r._path and r._path.startswith("/") for r in found.collect())
    typed = run("typed", pathGlobFilter="*.las", folders={"day": "bigint"}, filters='[["day", "=", 1]]')
    assert dict(typed.dtypes)["day"] == "bigint"
    assert sorted(int(r.x) for r in typed.collect()) == [1, 4, 7, 10]
