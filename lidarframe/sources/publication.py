"""The ``las_publish`` source: moves or deletes the files of a journal in the tasks of a Spark job."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lidarframe.sources.files import filesystem
from lidarframe.sources.journal import move, read_journal, remove, side_by_side

PER_TASK = 256


@dataclass
class EntryPartition(InputPartition):
    entries: list


class LasPublishSource(DataSource):
    """A row with the number of files done for each task; options: path, job, work (move or delete)."""

    @classmethod
    def name(cls) -> str:
        return "las_publish"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("files", T.LongType(), False)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PublishReader(self.options)


class PublishReader(DataSourceReader):
    def __init__(self, options):
        self.options = options
        self.deletes = options.get("work") == "delete"

    def partitions(self) -> list[EntryPartition]:
        fs, inner = filesystem(self.options["path"])
        journal = read_journal(fs, inner.rstrip("/"), self.options["job"])
        entries = [] if journal is None else journal.gone if self.deletes else journal.moves
        size = max(8, min(PER_TASK, -(-len(entries) // int(self.options.get("minSplits") or 1))))
        return [EntryPartition(list(entries[k : k + size])) for k in range(0, len(entries), size)]

    def read(self, partition: EntryPartition | None) -> Iterator[pa.RecordBatch]:
        fs, inner = filesystem(self.options["path"])
        base = inner.rstrip("/")
        work = remove if self.deletes else move
        entries = partition.entries if partition else []
        side_by_side(lambda entry: work(fs, base, entry), entries)
        yield pa.RecordBatch.from_arrays([pa.array([len(entries)], pa.int64())], ["files"])
