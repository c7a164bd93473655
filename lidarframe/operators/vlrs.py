"""Variable-length records of LAS files as a table, and from a table into files."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe.operators.session import register
from lidarframe.operators.tables import Paths, load, source_options
from lidarframe.sources.vlrs import MOST_PLAIN, VLR_SCHEMA, Vlr, put_records


def read_vlrs(spark: SparkSession, path: Paths, with_data: bool = True, **options) -> DataFrame:
    """A row (path, extended, place, user_id, record_id, description, length, data) for each variable-length record.

    ``with_data=False`` reads heads alone, the option ``extendedData=False`` no data of extended records (null); points are never read.
    """
    register(spark)
    fields = [f for f in VLR_SCHEMA if with_data or f.name != "data"]
    return load(spark.read.format("las_vlrs").options(**source_options(spark, options)).schema(type(VLR_SCHEMA)(fields)), path)


def write_vlrs(records: DataFrame, mode: str = "append") -> DataFrame:
    """Puts records (path, user_id, record_id, description, data) into the files they name.

    Each file is written anew beside the old one, which it then replaces; ``mode="replace"`` drops the records that it had. Data of more than
    65,535 bytes become extended records (LAS 1.4). A record that a file has already is not added twice, so a repeated task
    changes nothing. Returns (path, added), one row per file, when it has been done. Records of a file keep their order and
    stream into it; ``records`` is read twice, the first time for its paths alone.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    register(records.sparkSession)

    def text(value, most: int) -> bytes:
        raw = ("" if value is None else value).encode()
        if len(raw) > most:
            raise ValueError(f"{value!r} is longer than {most} bytes")
        return raw.ljust(most, b"\0")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Vlr]]:
        for batch in batches:
            for r in batch.to_pylist():
                data = r["data"] or b""
                head = text(r["user_id"], 16), int(r["record_id"]), text(r["description"], 32)
                yield r["path"], Vlr(len(data) > MOST_PLAIN, *head, len(data), data)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, found in groupby(rows(batches), lambda row: row[0]):
            added = put_records(path, (vlr for _, vlr in found), mode == "replace")
            yield pa.RecordBatch.from_pydict({"path": [path], "added": [added]})

    wanted = records.select("path", "user_id", F.col("record_id").cast("int").alias("record_id"), "description", "data")
    # a task for each file: by the hash of their paths several files would meet, and a plain shuffle is joined by compressed size
    paths = sorted((r.path for r in wanted.select("path").distinct().collect()), key=str)  # one row per file
    numbers = F.broadcast(records.sparkSession.createDataFrame([(p, n) for n, p in enumerate(paths)], "file string, number int"))
    numbered = wanted.withColumn("order", F.monotonically_increasing_id()).join(numbers, F.col("path").eqNullSafe(F.col("file")))
    dealt = numbered.repartitionById(max(1, len(paths)), "number").drop("file", "number")
    done = dealt.sortWithinPartitions("path", "order").drop("order").mapInArrow(put, "path string, added long")
    rows_done = done.collect()  # one row per file; the work is done here and once
    return records.sparkSession.createDataFrame(rows_done, "path string, added long")
