"""A kept table of file headers, refreshed by comparison with the files that are there.

Each version is a folder of Parquet with a row for each file: path, length, time of change, k=v folders and header. A refresh lists the
files, keeps the rows of files whose path, length and time are the same, and opens the others alone. It writes
a new version beside the old ones; a version counts once its write has succeeded, so a refresh that fails leaves the last one.
A file replaced by one of equal length with the same time of change goes unnoticed, as everywhere in Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lidarframe.operators.listing import Listing
from lidarframe.operators.session import register
from lidarframe.operators.tables import Paths, load, path_options, source_options
from lidarframe.sources.boxes import Box
from lidarframe.sources.files import FileEntry, filesystem, partition_fields
from lidarframe.sources.headers import FILE_SCHEMA, HEADER_SCHEMA, BoundedRow, header_rows

INDEX_SCHEMA = T.StructType([*FILE_SCHEMA, *(f for f in HEADER_SCHEMA if f.name not in FILE_SCHEMA.fieldNames())])
_FILE = ["path", "file_length", "modified_ns"]


def header_index(spark: SparkSession, index: str) -> DataFrame | None:
    """The newest version of an index, or None if there is none."""
    found = _versions(index)
    return spark.read.schema(INDEX_SCHEMA).parquet(found[-1]) if found else None


def refresh_header_index(
    spark: SparkSession, path: Paths, index: str, listing: Listing | None = None, **options
) -> DataFrame:
    """Brings the index up to date with the files below ``path``, or those of ``listing``, and returns it.

    Options are those of ``read_headers``; with ``badFiles="keep"`` broken files have a row with their error. Two versions
    are kept: a query that began with the last one can end. If nothing has changed, no version is written.
    """
    register(spark)
    if listing is not None:
        files = listing.files
    else:
        files = load(spark.read.format("las_files").options(**source_options(spark, options)), path)
    old = header_index(spark, index)
    fresh, kept = files, None
    if old is not None:
        known = old.select(*_FILE)
        fresh = files.join(known, _FILE, "left_anti")
        kept = old.join(files.select(*_FILE), _FILE, "left_semi")
        # a row for each file that has gone or changed, and each that is new
        if fresh.isEmpty() and known.join(files, _FILE, "left_anti").isEmpty():
            return old
    headers = fresh.mapInArrow(_opener(options), INDEX_SCHEMA)
    versions = _versions(index)
    number = int(versions[-1].rpartition("-")[2]) + 1 if versions else 1
    target = f"{index.rstrip('/')}/version-{number:08d}"
    whole = headers if kept is None else kept.select(*INDEX_SCHEMA.fieldNames()).unionByName(headers)
    whole.write.mode("overwrite").parquet(target)  # of a refresh that failed nothing is left
    fs, _ = filesystem(index)
    for gone in versions[:-1]:
        fs.delete_dir(filesystem(gone)[1])
    return spark.read.schema(INDEX_SCHEMA).parquet(target)


def indexed_headers(spark: SparkSession, path: Paths, index: str, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """What ``read_headers`` gives, from the index, which is refreshed first."""
    rows = refresh_header_index(spark, path, index, **options)
    box = Box(options)
    if box.tree is not None:
        rows = rows.mapInArrow(_box_filter(options), rows.schema)
    if columns is not None:
        return rows.select(*columns)
    folders = partition_fields(path_options(path, options))
    keys = [F.col("keys")[f.name].cast(f.dataType).alias(f.name) for f in folders]
    return rows.select(*HEADER_SCHEMA.fieldNames(), *keys)


def newest_version(index: str) -> str | None:
    found = _versions(index)
    return found[-1] if found else None


def _versions(index: str) -> list[str]:
    """Complete versions, oldest first."""
    fs, inner = filesystem(index)
    below = fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    names = sorted(i.base_name for i in below if i.type == pafs.FileType.Directory and i.base_name.startswith("version-"))
    done = fs.get_file_info([f"{inner.rstrip('/')}/{n}/_SUCCESS" for n in names])
    return [f"{index.rstrip('/')}/{n}" for n, mark in zip(names, done) if mark.type == pafs.FileType.File]


def _opener(options):
    """Rows of the index for rows of ``las_files``."""
    schema = to_arrow_schema(INDEX_SCHEMA)
    keep_bad = str(options.get("badFiles") or "").lower() == "keep"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.to_pylist()
            files = [FileEntry(r["root"], r["inner"], r["file_length"], r["modified_ns"], tuple(r["keys"])) for r in listed]
            for row, header in zip(listed, header_rows(files, keep_bad)):
                row.update({n: header.get(n) for n in HEADER_SCHEMA.fieldNames()})
            if listed:
                yield pa.RecordBatch.from_pylist(listed, schema=schema)

    return run


def _box_filter(options):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = Box(options)
        for batch in batches:
            yield batch.filter(pa.array([box.takes(BoundedRow(r)) for r in batch.to_pylist()], pa.bool_()))

    return run


def index_option(index: str) -> dict[str, str]:
    """Options by which a scan leaves out files that its ``box`` does, by the index instead of their own headers."""
    version = newest_version(index)
    return {"headerIndex": json.dumps([version])} if version else {}
