"""Stream of points on top of Spark's own file stream."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarframe.functions.fields import point_schema
from lidarframe.operators.session import register
from lidarframe.sources.files import (
    DEFAULT_SPLIT_BYTES,
    ByteRange,
    FileEntry,
    filesystem,
    flag,
    folder_keys,
    partition_fields,
)
from lidarframe.sources.layouts import ATTRIBUTES, PATH_COLUMN, WAVE_COLUMN
from lidarframe.sources.points import PointRanges

_ALWAYS = "36500d"  # Spark's stream forgets files older than maxFileAge; a century keeps all
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_las(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = ("x", "y", "z"),
    max_files_per_trigger: int | None = None,
    split_bytes: int = DEFAULT_SPLIT_BYTES,
    folders: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Points of LAS files as they arrive in a folder, each file once, whatever its time.

    Spark lists the files, keeps the log of those taken and admits ``max_files_per_trigger`` of them
    to a batch; contents are read by ranges of ``split_bytes``, in parallel. ``columns`` may be point attributes,
    ``_path`` and k=v folders below ``path`` (or the option ``basePath``); a folder column has the type given in ``folders``, else that of the values
    that are there when the stream is defined, else string. Options are those of
    ``format("las")`` for reading (``filters``, ``strict``, ...) and ``pathGlobFilter``. A file that is gone
    before it is read is an error.
    """
    register(spark)
    schema = _schema(path, columns, dict(folders or {}), options)
    base = filesystem(options.get("basePath") or path)[1].rstrip("/") + "/"
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("maxFileAge", _ALWAYS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    reader = reader.option("pathGlobFilter", options.pop("pathGlobFilter", "*"))
    begins = F.sequence(F.lit(0), F.greatest("length", F.lit(1)) - 1, F.lit(split_bytes).cast("long"))
    ranges = reader.load(path).select("path", "length", F.explode(begins).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = PointRanges(options, schema)
        for batch in batches:
            for row in batch.to_pylist():
                inner = filesystem(row["path"])[1]
                keys = folder_keys(inner[len(base) :].split("/")[:-1]) if inner.startswith(base) else ()
                file = FileEntry(row["path"], inner, row["length"], 0, keys)
                points.check_keys([file])
                if points.keep_file(file):
                    yield from points.batches([ByteRange(file, row["start"], row["start"] + split_bytes)])

    return ranges.repartition(F.col("path"), F.col("start")).mapInArrow(run, schema)


def _schema(path: str, columns: Sequence[str], folders: dict[str, str], options: dict) -> T.StructType:
    kinds = {name: flag(options, name) for name in ("unsigned", "strict")}
    nullable = str(options.get("missingColumns", "")).lower() == "null"
    found: dict[str, T.StructField] | None = None
    fields = []
    for name in columns:
        if name in ATTRIBUTES:
            fields.append(point_schema(name, **kinds, nullable=nullable)[0])
        elif name == PATH_COLUMN:
            fields.append(T.StructField(PATH_COLUMN, T.StringType(), False))
        elif name == WAVE_COLUMN:
            fields.append(T.StructField(WAVE_COLUMN, T.BinaryType()))
        elif name in folders:
            fields.append(T.StructField(name, T.DataType.fromDDL(folders[name])))
        else:
            if found is None:
                try:
                    found = {f.name: f for f in partition_fields({**options, "path": path})}
                except FileNotFoundError:
                    found = {}
            fields.append(found.get(name, T.StructField(name, T.StringType())))
    return T.StructType(fields)
