"""Streaming ingest: points of files that arrive in a folder."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSourceStreamReader

from lidarframe.sources.files import FileEntry, RangePartition, list_files, split_files
from lidarframe.sources.points import PointRanges


class LasStreamReader(DataSourceStreamReader):
    """``spark.readStream.format("las")``.

    An offset lists the files that are taken, whatever their times, so none is read twice or lost. It
    grows with the folder; for folders of very many files use :func:`stream_las`, whose log Spark
    keeps. Only if the user sets ``maxFileAge`` are files with a time below ``floor``, which trails the newest
    file (or the present, if that is earlier) by so many seconds, taken to be read and no longer listed.
    A restart needs nothing but the checkpoint.
    """

    def __init__(self, options, schema: T.StructType):
        self.options = options
        self.points = PointRanges(options, schema)
        age = options.get("maxFileAge")
        self.max_age_ns = int(float(age) * 1e9) if age else None

    def initialOffset(self) -> dict:
        return {"floor": 0, "seen": []}

    def latestOffset(self) -> dict:
        files = list_files(self.options)
        floor = 0
        if self.max_age_ns is not None:
            newest = min(max((f.mtime_ns for f in files), default=0), time.time_ns())
            floor = max(0, newest - self.max_age_ns)
        return {"floor": floor, "seen": sorted(_key(f) for f in files if f.mtime_ns >= floor)}

    def partitions(self, start: dict, end: dict) -> list[RangePartition]:
        before, after = set(start["seen"]), set(end["seen"])

        def taken(file: FileEntry, floor: int, seen: set[str]) -> bool:
            return file.mtime_ns < floor or _key(file) in seen

        listed = list_files(self.options)
        files = [
            f
            for f in listed
            if taken(f, end["floor"], after) and not taken(f, start["floor"], before)
        ]
        gone = after - before - {_key(f) for f in listed}
        if gone:
            raise FileNotFoundError(f"{len(gone)} files of this batch are no longer in the folder")
        self.points.check_keys(files)
        return split_files([f for f in files if self.points.keep_file(f)], self.options)

    def read(self, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        yield from self.points.batches(partition.ranges if partition else [])

    def commit(self, end: dict) -> None:
        """Input files are never removed."""


def _key(file: FileEntry) -> str:
    return hashlib.blake2b(file.name.encode(), digest_size=12).hexdigest()
