"""Faulty headers of a larger table: a folder is written by several tasks."""

import re

from lidarframe import read_headers
from lidarframe.plans import catalog, fixtures


def test_a_folder_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(fixtures, "POINTS_PER_FILE", 200)
    found = {r.part: r for r in catalog.las_audit_faults(spark, str(tmp_path)).collect()}
    assert sorted(found) == list(range(8)) and sum(r.scanned_points for r in found.values()) == 6000
    assert [found[p].off_by for p in range(8)] == [fixtures.FAULTS[p][0] for p in range(8)]
    assert [found[p].ok for p in range(8)] == [1, 0, 0, 0, 0, 0, 0, 0]
    paths = [r.path for r in read_headers(spark, fixtures.faulty_las(spark, str(tmp_path)), ["path"]).collect()]
    for part in range(8):
        tasks = {re.search("part-([0-9]+)-", p.rsplit("/", 1)[1])[1] for p in paths if f"/part={part}/" in p}
        assert len(tasks) > 1
