"""The sink: bytes on disk, commit, modes, folders, refusals."""

import struct
from pathlib import Path

import golden
import pytest
from pyspark.sql import functions as F

from lidarframe import format_schema, read_headers, read_las, write_las
from lidarframe.sources.layouts import POINT_FORMATS


def las_files(path) -> list[Path]:
    return sorted(p for p in Path(path).rglob("*.las"))


def some_points(spark, n=100, parts=4):
    ids = spark.range(0, n, 1, parts)
    return ids.select(
        (F.col("id") * 0.01).alias("x"), (F.col("id") % 7 * 1.0).alias("y"), F.lit(-1.5).alias("z")
    )


@pytest.mark.parametrize("fmt", POINT_FORMATS)
def test_written_bytes_equal_hand_packed_bytes(spark, tmp_path, fmt):
    source = golden.cloud(tmp_path / "in" / "a.las", 5, fmt)
    points = read_las(spark, source, POINT_FORMATS[fmt])
    scale = {"scaleX": 0.01, "scaleY": 0.02, "scaleZ": 0.5, "offsetX": 0, "offsetY": 10, "offsetZ": -1}
    write_las(points, str(tmp_path / "out"), pointFormat=fmt, **scale)
    (file,) = las_files(tmp_path / "out")
    data = file.read_bytes()
    size = struct.unpack_from("<H", data, 94)[0]
    assert data[size:] == golden.points(5, fmt)
    assert struct.unpack_from("<BH", data, 104) == (fmt, golden.LENGTHS[fmt])
    assert struct.unpack_from("<6d", data, 131) == (0.01, 0.02, 0.5, 0.0, 10.0, -1.0)
    assert struct.unpack_from("<6d", data, 179) == (
        4 * 0.01 + 0.0, 0.0, -202 * 0.02 + 10.0, -202 * 0.02 + 10.0, 303 * 0.5 - 1.0, 303 * 0.5 - 1.0,
    )
    if fmt >= 6:
        assert struct.unpack_from("<I5I", data, 107) == (0,) * 6
        assert struct.unpack_from("<QQQ", data, 247) == (5, 0, 0)  # count, returns 1 and 2
        assert struct.unpack_from("<Q", data, 255 + 8 * 4) == (5,)  # 1717 & 15 == return 5
    else:
        assert struct.unpack_from("<I5I", data, 107) == (5, 5, 0, 0, 0, 0)  # 17 & 7 == return 1


def test_versions(spark, tmp_path):
    points = some_points(spark, 3, 1)
    for fmt, want in [(0, "1.2"), (3, "1.2"), (4, "1.3"), (6, "1.4")]:
        write_las(points, str(tmp_path / str(fmt)), pointFormat=fmt)
        assert read_headers(spark, str(tmp_path / str(fmt))).first()["version"] == want
    write_las(points, str(tmp_path / "v"), version="1.4")
    head = read_headers(spark, str(tmp_path / "v")).first()
    assert (head["version"], head["point_count"], head["header_size"]) == ("1.4", 3, 375)
    with pytest.raises(Exception, match="needs LAS 1.4"):
        write_las(points, str(tmp_path / "w"), pointFormat=6, version="1.2")


def test_rolling_and_header_counts(spark, tmp_path):
    write_las(some_points(spark, 100, 1), str(tmp_path / "p"), maxPointsPerFile=30)
    counts = [r["point_count"] for r in read_headers(spark, str(tmp_path / "p")).collect()]
    assert sorted(counts) == [10, 30, 30, 30]
    assert read_las(spark, str(tmp_path / "p")).count() == 100


def test_save_modes(spark, tmp_path):
    path = str(tmp_path / "p")
    write_las(some_points(spark, 10), path)
    assert (tmp_path / "p" / "_SUCCESS").exists()
    assert not (tmp_path / "p" / "_temporary").exists()
    with pytest.raises(FileExistsError):
        write_las(some_points(spark, 1), path)
    write_las(some_points(spark, 1), path, mode="ignore")
    assert read_las(spark, path).count() == 10
    write_las(some_points(spark, 5), path, mode="append")
    assert read_las(spark, path).count() == 15
    # reading from the files that are replaced
    write_las(read_las(spark, path).where("x < 0.035"), path, mode="overwrite")
    assert read_las(spark, path).count() == 8
    some_points(spark, 2).write.format("las").mode("append").save(path)
    assert read_las(spark, path).count() == 10


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "p")
    write_las(some_points(spark, 10).where("x < 0"), path)
    assert las_files(path) == []
    assert read_las(spark, path).count() == 0


def test_failed_job_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "p")
    write_las(some_points(spark, 10), path)
    before = las_files(path)
    bad = some_points(spark, 100).withColumn("x", F.when(F.col("x") > 0.9, 1e300).otherwise(F.col("x")))
    with pytest.raises(Exception, match="32-bit coordinate"):
        write_las(bad, path, mode="overwrite")
    assert las_files(path) == before
    assert not (tmp_path / "p" / "_temporary").exists()


def test_retried_tasks_write_once(spark, tmp_path):
    """Every first attempt dies after it has written files; the table comes out whole all the same."""

    def dies_at_first(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    points = some_points(spark, 100, 4)
    flaky = points.mapInPandas(dies_at_first, points.schema)
    path = str(tmp_path / "p")
    write_las(flaky, path, maxPointsPerFile=5)
    found = sorted(r["x"] for r in read_las(spark, path).collect())
    assert found == [i * 0.01 + 0.0 for i in range(100)]
    assert len(las_files(path)) == 20 and not (tmp_path / "p" / "_temporary").exists()


@pytest.mark.parametrize(
    "column,value,message",
    [
        ("x", "cast(null as double)", "null"),
        ("x", "double('NaN')", "32-bit coordinate"),
        ("intensity", "40000", "does not fit"),
        ("intensity", "cast(null as int)", "null"),
        ("user_data", "-200", "does not fit"),
        ("gps_time", "1.0", "not part of point format 0"),
        ("foo", "1", "not part of point format 0"),
    ],
)
def test_refusals(spark, tmp_path, column, value, message):
    points = some_points(spark, 3, 1).withColumn(column, F.expr(value))
    with pytest.raises(Exception, match=message):
        write_las(points, str(tmp_path / "p"))


def test_options_are_checked(spark, tmp_path):
    points = some_points(spark, 3, 1)
    for options in ({"pointFormat": 11}, {"scale": 0}, {"scaleX": -1}, {"maxPointsPerFile": 0}):
        with pytest.raises(Exception, match="unknown|finite|between"):
            write_las(points, str(tmp_path / "p"), **options)
    with pytest.raises(Exception, match="'z' is required"):
        write_las(points.drop("z"), str(tmp_path / "p"))
    with pytest.raises(ValueError, match="save mode"):
        write_las(points, str(tmp_path / "p"), mode="upsert")


def test_unsigned_values(spark, tmp_path):
    points = some_points(spark, 3, 1).withColumn("intensity", F.lit(65535))
    write_las(points, str(tmp_path / "p"), unsigned=True)
    assert {r[0] for r in read_las(spark, str(tmp_path / "p"), ["intensity"]).collect()} == {-1}
    wide = read_las(spark, str(tmp_path / "p"), ["intensity"], unsigned=True)
    assert {r[0] for r in wide.collect()} == {65535}
    with pytest.raises(Exception, match="does not fit"):
        write_las(points.withColumn("intensity", F.lit(-1)), str(tmp_path / "q"), unsigned=True)


def test_folders(spark, tmp_path):
    path = str(tmp_path / "p")
    kinds = F.when(F.col("y") < 5, "a/b c").when(F.col("y") < 6, F.lit(None)).otherwise("ü=1")
    points = some_points(spark, 700).withColumn("kind", kinds).withColumn("n", F.col("y").cast("int"))
    write_las(points, path, partition_by=["kind", "n"])
    found = read_las(spark, path).groupBy("kind", "n").agg(F.count("*").alias("c")).collect()
    wanted = points.groupBy("kind", "n").agg(F.count("*").alias("c")).collect()
    assert {tuple(r) for r in found} == {tuple(r) for r in wanted}
    named = read_las(spark, path, ["n", "x", "kind"]).where("n = 6 and kind = 'ü=1'")
    assert named.count() == 100


def test_folders_of_odd_values(spark, tmp_path):
    odd = F.expr("case id % 4 when 0 then double('NaN') when 1 then null when 2 then 0.5 else -1.0 end")
    points = some_points(spark, 100).withColumn("id", F.round(F.col("x") * 100).cast("int"))
    keyed = points.withColumn("f", odd).withColumn("even", F.col("id") % 2 == 0).drop("id")
    write_las(keyed, str(tmp_path / "p"), partition_by=["f", "even"])
    names = {f"{p.parent.parent.name}/{p.parent.name}" for p in las_files(tmp_path / "p")}
    assert names == {"f=nan/even=true", "f=__HIVE_DEFAULT_PARTITION__/even=false", "f=0.5/even=true", "f=-1.0/even=false"}
    assert read_las(spark, str(tmp_path / "p")).count() == 100


def test_unsorted_folders_keep_all_rows(spark, tmp_path):
    points = some_points(spark, 500, 2).withColumn("k", (F.col("x") * 100).cast("int") % 40)
    path = str(tmp_path / "p")
    points.write.format("las").mode("append").option("partitionColumns", "k").save(path)
    assert read_las(spark, path).groupBy("k").count().count() == 40
    assert read_las(spark, path).count() == 500


def test_clustering_tightens_bounds(spark, tmp_path):
    points = some_points(spark, 10_000, 4).withColumn("x", F.pmod(F.hash("x"), F.lit(1000)) * 0.01)
    write_las(points, str(tmp_path / "c"), cluster_by=["x"], num_partitions=8)
    heads = read_headers(spark, str(tmp_path / "c")).collect()
    assert len(heads) == 8 and max(h["max_x"] - h["min_x"] for h in heads) < 5
    same = some_points(spark, 10_000, 4).withColumn("x", F.lit(1.0))
    write_las(same, str(tmp_path / "d"), cluster_by=["x"], num_partitions=8)
    sizes = [h["point_count"] for h in read_headers(spark, str(tmp_path / "d")).collect()]
    assert len(sizes) > 1 and sum(sizes) == 10_000  # one place, still several files


def test_memory_limit(spark, tmp_path, monkeypatch):
    """A task that holds more than the memory limit goes on in a new file; no point is lost."""
    from lidarframe.sources import writer as sink

    monkeypatch.setattr(sink, "HELD_BYTES", 1000)
    schema = format_schema(0)
    task = sink.LasWriter({"path": str(tmp_path / "p")}, schema, False)
    import pyarrow as pa

    n = 5000
    batch = pa.RecordBatch.from_pydict(
        {f.name: pa.array(range(n)).cast("double") if f.name in "xyz" else pa.array([1] * n) for f in schema}
    )
    message = task.write(iter([batch, batch]))
    task.commit([message, None])
    files = las_files(tmp_path / "p")
    assert [f.stat().st_size for f in files] == [227 + n * 20] * 2
    assert read_las(spark, str(tmp_path / "p")).agg(F.sum("x")).first()[0] == pytest.approx(n * (n - 1))


def test_failed_commit_leaves_the_old_files(spark, tmp_path):
    import pyarrow as pa

    from lidarframe.sources import writer as sink

    target = tmp_path / "p"
    write_las(some_points(spark, 10, 1), str(target))
    before = {f: f.read_bytes() for f in las_files(target)}
    schema = format_schema(0)
    batch = pa.RecordBatch.from_pydict(
        {f.name: pa.array([1.0] * 5) if f.name in "xyz" else pa.array([1] * 5) for f in schema}
    )
    for overwrite in (True, False):
        job = sink.LasWriter({"path": str(target)}, schema, overwrite)
        message = job.write(iter([batch]))
        gone = sink.WrittenFiles([(f"{target}/_temporary/{job.job}/lost.las", "lost.las")])
        with pytest.raises(FileNotFoundError):
            job.commit([message, gone])
        job.abort([message, gone])
        assert {f: f.read_bytes() for f in las_files(target)} == before
        assert not (target / "_temporary").exists()
