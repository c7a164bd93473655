"""Listing of large folder trees as Spark jobs, kept as a table for all steps of a query.

The tree is gone through level by level: the folders of a level are listed in parallel, each once, and their
sub-folders are the next level. What is found is a table of files, from which follow the
types of k=v columns, the files that a predicate on them admits, and the byte ranges of a scan: the driver
holds neither files nor folders, and nothing is listed twice.
"""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lidarframe.functions.fields import point_schema
from lidarframe.operators.predicates import box_tree, split_by_columns
from lidarframe.operators.session import register
from lidarframe.operators.tables import Paths, kinds, path_options, sql_words
from lidarframe.sources.files import (
    DEFAULT_SPLIT_BYTES,
    MAX_SPLITS,
    OPEN_COST,
    ByteRange,
    FileEntry,
    base_folder,
    expand,
    filesystem,
    flag,
    folder_keys,
    given_paths,
    hidden,
    list_files,
)
from lidarframe.sources.headers import FILE_SCHEMA
from lidarframe.sources.journal import pending
from lidarframe.sources.layouts import ATTRIBUTES, COORDINATES, PATH_COLUMN, WAVE_COLUMN
from lidarframe.sources.points import PointRanges

FOLDERS_PER_TASK = 64
_LEVEL = T.StructType([*FILE_SCHEMA, T.StructField("base", T.StringType()), T.StructField("folder", T.BooleanType())])


@dataclass(frozen=True)
class Listing:
    """Files below some paths as they were when listed; ``fields`` are the columns of k=v folders."""

    files: DataFrame
    fields: list[T.StructField]

    def where(self, *conditions: str) -> Listing:
        """The files whose folder columns meet the conditions."""
        typed = self.files.select("*", *self.keys())
        for text in conditions:
            typed = typed.where(text)
        return replace(self, files=typed.select(*FILE_SCHEMA.fieldNames()))

    def keys(self) -> list[Column]:
        return [F.col("keys")[f.name].cast(f.dataType).alias(f.name) for f in self.fields]


def list_las(spark: SparkSession, path: Paths, scratch: str, **options) -> Listing:
    """Lists the data files below ``path``; each level's table is written below ``scratch``, a new folder.

    Options: ``pathGlobFilter``, ``basePath``. Names that begin with _ or . are skipped.
    """
    register(spark)
    options = path_options(path, options)
    rows = []
    for root in given_paths(options):
        fs, inner = filesystem(root)
        tops = expand(fs, inner)
        if not tops or tops[0].type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"path does not exist: {root}")
        for top in tops:
            base = base_folder(options, top)
            if top.type == pafs.FileType.Directory and pending(fs, top.path):
                # a write is being published: the plain listing knows which files count
                found = list_files({**options, "path": root, "paths": ""})
                rows += [(f.name, f.size, f.mtime_ns, root, f.path, dict(f.keys), base, False) for f in found if f.path.startswith(top.path)]
            else:
                whole = top.type == pafs.FileType.Directory
                entry = FileEntry(root, top.path, top.size or 0, top.mtime_ns or 0, ())
                keys = {} if whole else dict(folder_keys(top.path[len(base) :].split("/")[:-1]))
                rows.append((entry.name, entry.size, entry.mtime_ns, root, top.path, keys, base, whole))
    level, number, tables = spark.createDataFrame(rows, _LEVEL), 0, []
    name_filter = options.get("pathGlobFilter")
    while True:
        target = f"{scratch.rstrip('/')}/level-{number:03d}"
        level.write.parquet(target)
        written = spark.read.schema(_LEVEL).parquet(target)
        tables.append(written.where("not folder").select(*FILE_SCHEMA.fieldNames()))
        folders = written.where("folder")
        n = folders.count()
        if not n:
            break
        spread = folders.repartition(max(1, min(MAX_SPLITS, -(-n // FOLDERS_PER_TASK))), "root", "inner")
        level, number = spread.mapInArrow(_lister(name_filter), _LEVEL), number + 1
    files = tables[0]
    for table in tables[1:]:
        files = files.unionByName(table)
    return Listing(files, _fields(files))


def _lister(name_filter: str | None):
    """Children of the folders given."""
    schema = to_arrow_schema(_LEVEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, _ = filesystem(row["root"])
                found = []
                for info in fs.get_file_info(pafs.FileSelector(row["inner"], allow_not_found=True)):
                    folder = info.type == pafs.FileType.Directory
                    if hidden(info.base_name) or not (folder or info.type == pafs.FileType.File):
                        continue
                    if name_filter and not folder and not fnmatch.fnmatchcase(info.base_name, name_filter):
                        continue
                    entry = FileEntry(row["root"], info.path, info.size or 0, info.mtime_ns or 0, ())
                    keys = folder_keys(info.path[len(row["base"]) :].split("/")[:-1])
                    known = {"path": entry.name, "file_length": entry.size, "modified_ns": entry.mtime_ns, "root": entry.root}
                    found.append({**known, "inner": info.path, "keys": keys, "base": row["base"], "folder": folder})
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)

    return run


def _fields(files: DataFrame) -> list[T.StructField]:
    """Columns of k=v folders, typed by all their values like those of a plain read, outer folders first."""
    pairs = files.select("path", F.explode("keys").alias("k", "v"))
    whole, real = r"^-?(0|[1-9]\d{0,17})$", r"^(-?\d+\.\d+([eE]-?\d+)?|-?(0|[1-9]\d*))$"
    some = F.col("v").isNotNull()
    found = pairs.groupBy("k").agg(
        F.count("v").alias("n"),
        F.every(F.when(some, F.col("v").rlike(whole))).alias("whole"),
        F.every(F.when(some, F.coalesce(F.col("v").try_cast("bigint").between(-(2**31), 2**31 - 1), F.lit(False)))).alias("small"),
        F.every(F.when(some, F.col("v").rlike(real))).alias("real"),
        F.min(F.expr("instr(path, concat('/', k, '='))")).alias("place"),
    )
    out = []
    for r in found.orderBy("place", "k").collect():  # a row for each column
        kind: T.DataType = T.StringType()
        if r.n and r.whole:
            kind = T.IntegerType() if r.small else T.LongType()
        elif r.n and r.real:
            kind = T.DoubleType()
        out.append(T.StructField(r.k, kind))
    return out


def read_listed(
    spark: SparkSession,
    listing: Listing,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    split_bytes: int = DEFAULT_SPLIT_BYTES,
    **options,
) -> DataFrame:
    """What ``read_las`` gives for the files of a listing; folders that ``where`` rules out are not opened.

    Files are cut into ranges and dealt to tasks by Spark, so the driver plans nothing by file.
    """
    names = [f.name for f in listing.fields]
    wanted = [*COORDINATES, *names] if columns is None else list(columns)
    own, _ = split_by_columns(spark, where, listing.fields) if where else ([], [])
    listing = listing.where(*own) if own else listing
    words = sql_words([where]) if where else set()
    used = [n for n in (*ATTRIBUTES, PATH_COLUMN, *names) if n.lower() in words]
    if where and flag(options, "trustBounds"):
        options["box"] = json.dumps(box_tree(spark, where, listing.fields, **kinds(options)))
    schema = _schema(listing, list(dict.fromkeys([*wanted, *used])), options)
    size = F.greatest("file_length", F.lit(1))
    pieces = F.sequence(F.lit(0).cast("long"), size - 1, F.lit(split_bytes).cast("long"))
    ranges = listing.files.select("root", "inner", "file_length", "keys", F.explode(pieces).alias("start"))
    weight = listing.files.agg(F.sum(F.col("file_length") + OPEN_COST)).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, min(MAX_SPLITS, -(-weight // max(split_bytes, OPEN_COST))))
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = PointRanges(options, schema)
        for batch in batches:
            rows = batch.to_pylist()
            files = [FileEntry(r["root"], r["inner"], r["file_length"], 0, tuple(r["keys"])) for r in rows]
            points.check_keys(files)
            yield from points.batches([ByteRange(f, r["start"], r["start"] + split_bytes) for f, r in zip(files, rows)])

    points = ranges.repartition(tasks, "inner", "start").mapInArrow(run, schema)
    if where:
        points = points.where(where)
    return points.select(*[F.col(f"`{n}`") for n in wanted])


def _schema(listing: Listing, columns: Sequence[str], options: dict) -> T.StructType:
    known = {f.name: f for f in listing.fields}
    nullable = str(options.get("missingColumns", "")).lower() == "null"
    fields = []
    for name in columns:
        if name in ATTRIBUTES:
            fields.append(point_schema(name, **kinds(options), nullable=nullable)[0])
        elif name == PATH_COLUMN:
            fields.append(T.StructField(PATH_COLUMN, T.StringType(), False))
        elif name == WAVE_COLUMN:
            fields.append(T.StructField(WAVE_COLUMN, T.BinaryType()))
        elif name in known:
            fields.append(known[name])
        else:
            raise ValueError(f"column {name!r} is neither a point attribute nor a k=v folder")
    return T.StructType(fields)
