"""Commits: journals, writes that end half way, batches of a stream that are run again."""

import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lidarframe import format_schema, publish_las, read_las, stream_las, write_las
from lidarframe.sources import journal, writer
from lidarframe.sources.files import list_files


def points(spark, start, n=20):
    return spark.range(start, start + n, 1, 4).selectExpr("cast(id as double) as x", "0D as y", "0D as z", "cast(id % 2 as int) as k")


def xs(spark, path):
    return sorted(int(r.x) for r in read_las(spark, str(path), ["x"]).collect())


def stop_at(monkeypatch, name, calls):
    """Lets the named file operation fail after some calls."""
    real, left = getattr(journal, name), [calls]

    def failing(fs, base, entry):
        if left[0] == 0:
            raise OSError("storage is down")
        left[0] -= 1
        real(fs, base, entry)

    monkeypatch.setattr(journal, name, failing)
    monkeypatch.setattr(writer, name, failing)


def committed(spark, path, monkeypatch, overwrite):
    """A write that has got as far as its journal."""
    with monkeypatch.context() as m:
        m.setattr("lidarframe.operators.tables.publish_las", lambda *a: 0)
        write_las(points(spark, 100), path, "overwrite" if overwrite else "append", partition_by=["k"])


@pytest.mark.parametrize("overwrite", [True, False])
def test_half_published_files_count_once(spark, tmp_path, monkeypatch, overwrite):
    path = str(tmp_path / "p")
    write_las(points(spark, 0), path, partition_by=["k"])
    committed(spark, path, monkeypatch, overwrite)
    want = [*([] if overwrite else range(20)), *range(100, 120)]
    assert xs(spark, path) == want  # nothing moved, nothing deleted
    assert sorted({r.k for r in read_las(spark, path, ["k"]).collect()}) == [0, 1]
    fs, base = writer.filesystem(path)
    for name, steps in (("move", (1, 2, 2)), ("remove", (1, 3) if overwrite else ())):
        for calls in steps:
            with monkeypatch.context() as m:
                stop_at(m, name, calls)
                with pytest.raises(OSError):
                    writer.publish(fs, journal.pending(fs, base)[0])
            assert xs(spark, path) == want
    assert publish_las(spark, path) > 0 and publish_las(spark, path) == 0
    assert xs(spark, path) == want and not (tmp_path / "p" / "_temporary").exists()
    assert sum(1 for _ in (tmp_path / "p").rglob("*.las")) == len(list_files({"path": path}))


def test_next_write_finishes_the_last(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    write_las(points(spark, 0), path, partition_by=["k"])
    committed(spark, path, monkeypatch, True)
    write_las(points(spark, 500).drop("k"), path, "append")
    assert xs(spark, path) == [*range(100, 120), *range(500, 520)]
    committed(spark, path, monkeypatch, False)
    points(spark, 700).drop("k").write.format("las").mode("overwrite").save(path)
    assert xs(spark, path) == list(range(700, 720)) and not (tmp_path / "p" / "_temporary").exists()


def test_commit_touches_no_single_file(spark, tmp_path, monkeypatch):
    target = tmp_path / "p"
    write_las(points(spark, 0), str(target), partition_by=["k"])
    schema = format_schema(0)
    batch = pa.RecordBatch.from_pydict({f.name: pa.array([1.0] * 5 if f.name in "xyz" else [1] * 5) for f in schema})
    job = writer.LasWriter({"path": str(target), "publishLater": "true", "maxPointsPerFile": "1"}, schema, True)
    message = job.write(iter([batch]))
    for module in (journal, writer):
        for name in ("move", "remove", "side_by_side", "make_folders"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, lambda *a: pytest.fail("a file was touched"))
    job.commit([message])
    found = json.loads((target / "_temporary" / job.job / journal.JOURNAL).read_text())
    assert len(found["moves"]) == 5 and len(found["gone"]) > 3
    job.abort([message])  # too late: the journal is there
    assert xs(spark, target) == [1] * 5


def test_plain_save_leaves_the_old_files_if_moves_fail(spark, tmp_path):
    target = tmp_path / "p"
    write_las(points(spark, 0), str(target), partition_by=["k"])
    schema = format_schema(0)
    job = writer.LasWriter({"path": str(target)}, schema, True)
    lost = writer.WrittenFiles([(f"{target}/_temporary/{job.job}/lost.las", "lost.las")])
    with pytest.raises(FileNotFoundError):
        job.commit([lost])
    job.abort([lost])
    assert xs(spark, target) == list(range(20))


# streams


def batch_of(start):
    schema = format_schema(0)
    data = {f.name: pa.array([float(start + k) for k in range(3)] if f.name in "xyz" else [1] * 3) for f in schema}
    return schema, pa.RecordBatch.from_pydict(data)


def run_batch(target, start, batch, commit=True):
    schema, data = batch_of(start)
    sink = writer.LasStreamWriter({"path": str(target), "sinkId": "query"}, schema, False)
    message = sink.write(iter([data]))
    if commit:
        sink.commit([message, None], batch)
    return sink, message


def test_replayed_batches_count_once(spark, tmp_path, monkeypatch):
    target = tmp_path / "p"
    run_batch(target, 0, 0)
    run_batch(target, 0, 0)  # the whole batch again
    assert xs(spark, target) == [0, 1, 2]
    for step in ("side_by_side", "finish"):  # lost before the moves, lost before the journal goes
        with monkeypatch.context() as m:
            m.setattr(writer, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                run_batch(target, 100, 1 if step == "side_by_side" else 2)
        seen = [0, 1, 2, 100, 101, 102] if step == "side_by_side" else [0, 1, 2, 100, 100, 101, 101, 102, 102]
        assert xs(spark, target) == seen
        run_batch(target, 100, 1 if step == "side_by_side" else 2)
        assert xs(spark, target) == seen
    sink, message = run_batch(target, 500, 3, commit=False)
    sink.abort([message], 3)
    run_batch(target, 900, 3)
    assert xs(spark, target) == [0, 1, 2, 100, 100, 101, 101, 102, 102, 900, 901, 902]
    assert not (target / "_temporary").exists()


def test_stream_of_files_to_files(spark, tmp_path):
    inbox, outbox, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = (
            stream_las(spark, inbox, ["x", "y", "z"], max_files_per_trigger=1, pathGlobFilter="*.las")
            .withColumn("x", F.col("x") + 1)
            .writeStream.format("las")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start(outbox)
        )
        stream.awaitTermination()
        return [p["batchId"] for p in stream.recentProgress]

    write_las(points(spark, 0).drop("k"), inbox, num_partitions=3)
    run()
    write_las(points(spark, 50).drop("k"), inbox, "append", num_partitions=2)
    last = max(run())
    want = [*range(1, 21), *range(51, 71)]
    assert xs(spark, outbox) == want
    (Path(state) / "commits" / str(last)).unlink()  # Spark will run the last batch again
    for crc in (Path(state) / "commits").glob(f".{last}.crc"):
        crc.unlink()
    run()
    assert xs(spark, outbox) == want


def test_streams_need_a_name(tmp_path):
    with pytest.raises(ValueError, match="sinkId"):
        writer.LasStreamWriter({"path": str(tmp_path)}, format_schema(0), False)
    with pytest.raises(ValueError, match="appended"):
        writer.LasStreamWriter({"path": str(tmp_path), "sinkId": "a"}, format_schema(0), True)
