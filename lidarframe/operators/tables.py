"""Reading and writing LAS tables."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarframe.functions.curves import hilbert_key
from lidarframe.functions.fields import point_schema
from lidarframe.operators.predicates import box_tree, split_by_columns
from lidarframe.operators.session import register
from lidarframe.sources.files import filesystem, flag, list_files, one_listing, partition_fields
from lidarframe.sources.headers import HEADER_SCHEMA
from lidarframe.sources.journal import make_folders, pending
from lidarframe.sources.layouts import ATTRIBUTES, COORDINATES, PATH_COLUMN, POINT_COLUMN, WAVE_COLUMN
from lidarframe.sources.writer import finish

Paths = str | Sequence[str]
LITERAL = r"'(?:[^'\\]|\\.|'')*'" + r'|"(?:[^"\\]|\\.|"")*"'


def source_options(spark: SparkSession, options: dict) -> dict:
    """Options as text, with the cluster's parallelism as the least number of splits."""
    given = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    return {"minSplits": spark.sparkContext.defaultParallelism, **given}


def path_options(path: Paths, options: dict) -> dict:
    base = {"path": path} if isinstance(path, str) else {"paths": json.dumps(list(path))}
    return {**options, **base}


def kinds(options: dict) -> dict:
    """The options that decide the types of point attributes."""
    exact = options.get("exact")
    found = {name: flag(options, name) for name in ("unsigned", "strict")}
    return {**found, "exact": None if exact in (None, "") else int(exact)}


def load(reader, path: Paths) -> DataFrame:
    return reader.load(path if isinstance(path, str) else list(path))


def declared_schema(path: Paths, columns: Sequence[str], options: dict) -> T.StructType:
    """Schema of point attributes, k=v folder columns and ``_path``, in the given order."""
    nullable = str(options.get("missingColumns", "")).lower() == "null"
    folders: dict[str, T.StructField] | None = None
    schema = T.StructType()
    for name in columns:
        if name in ATTRIBUTES:
            schema = schema.add(point_schema(name, **kinds(options), nullable=nullable)[0])
        elif name == PATH_COLUMN:
            schema = schema.add(PATH_COLUMN, T.StringType(), False)
        elif name == WAVE_COLUMN:
            schema = schema.add(WAVE_COLUMN, T.BinaryType())
        else:
            if folders is None:
                folders = {f.name: f for f in partition_fields(path_options(path, options))}
            if name not in folders:
                raise ValueError(f"column {name!r} is neither a point attribute nor a k=v folder")
            schema = schema.add(folders[name])
    return schema


def sql_words(texts: Iterable[str]) -> set[str]:
    """Names used in SQL texts, in lower case; quoted strings do not count."""
    return {w.lower() for t in texts for w in re.findall(r"[A-Za-z_]\w*", re.sub(LITERAL, " ", t))}


def passing_folders(
    spark: SparkSession, path: Paths, where: str, fields: Sequence[T.StructField], options: dict
) -> list | None:
    """Combinations of k=v folders for which ``where`` can hold; None if it says nothing about them.

    Spark decides which conditions use nothing but folder columns and evaluates these on one row for
    each combination that the listing shows.
    """
    conditions, _ = split_by_columns(spark, where, fields)
    if not conditions:
        return None
    found = list(dict.fromkeys(f.keys for f in list_files(path_options(path, options))))
    texts = T.StructType([T.StructField(f"v{n}", T.StringType()) for n in range(len(fields))]).add("number", T.IntegerType())
    rows = [(*[dict(keys).get(f.name) for f in fields], k) for k, keys in enumerate(found)]
    table = spark.createDataFrame(rows, texts)
    typed = [F.col(f"v{n}").cast(f.dataType).alias(f.name) for n, f in enumerate(fields)]
    passed = table.select(F.struct(*typed).alias("__keys"), "number").select("__keys.*", F.col("number").alias("__number"))
    kept = passed.where(" AND ".join(conditions)).select("__number").collect()  # one row per kept folder
    return [found[r[0]] for r in kept]


@one_listing()
def read_las(
    spark: SparkSession,
    path: Paths,
    columns: Sequence[str] | None = None,
    filters: Sequence[tuple[str, str, object]] = (),
    where: str | None = None,
    index: str | None = None,
    **options,
) -> DataFrame:
    """Points of LAS files; only the named columns are decoded.

    Without ``columns`` the result has x, y, z and the k=v folder columns. With an empty list it
    has no columns and one row per point. ``filters`` such as ``[("x", ">", 500.0),
    ("day", "in", [1, 2])]`` must all hold; they skip k=v folders and drop points before these
    enter Spark. ``where`` is an SQL predicate, which may use attributes that are not among ``columns``;
    folders whose k=v columns rule it out are not opened, nor, with ``trustBounds``, the points of files whose
    bounds do. ``index`` names a header index (see ``refresh_header_index``): with ``trustBounds`` such files are not
    even opened. Options are those of ``format("las")``.
    """
    register(spark)
    if index:
        from lidarframe.operators.header_index import index_option

        options = {**options, **index_option(index)}
    if where is not None:
        fields = partition_fields(path_options(path, options))
        folders = passing_folders(spark, path, where, fields, options) if fields else None
        if folders is not None:
            options["folders"] = json.dumps(folders)
        wanted = [*COORDINATES, *[f.name for f in fields]] if columns is None else list(columns)
        words = sql_words([where])
        used = [n for n in (*ATTRIBUTES, PATH_COLUMN, *[f.name for f in fields]) if n.lower() in words]
        read = list(dict.fromkeys([*wanted, *used]))
        if flag(options, "trustBounds") and "box" not in options:
            options["box"] = json.dumps(box_tree(spark, where, fields, **kinds(options)))
        points = read_las(spark, path, read, filters, **options).where(where)
        return points.select(*[F.col(f"`{n}`") for n in wanted])
    options = source_options(spark, options)
    if filters:
        options["filters"] = json.dumps([list(f) for f in filters])
    reader = spark.read.format("las").options(**options)
    if columns is None and options.get("exact") is not None:
        columns = [*COORDINATES, *(f.name for f in partition_fields(path_options(path, options)))]
    if columns is None:
        return load(reader, path)
    if not columns:
        # one constant byte per point moves faster into Spark than batches without columns
        return load(reader.schema(T.StructType().add(POINT_COLUMN, T.ByteType())), path).select()
    return load(reader.schema(declared_schema(path, columns, options)), path)


def las_view(
    spark: SparkSession, name: str, path: Paths, columns: Sequence[str], where: str | None = None, **options
) -> None:
    """A temporary view for SQL that decodes ``columns`` alone and opens only folders that ``where`` admits."""
    read_las(spark, path, columns, where=where, **options).createOrReplaceTempView(name)


def read_headers(
    spark: SparkSession, path: Paths, columns: Sequence[str] | None = None, **options
) -> DataFrame:
    """One row per LAS file with the values of its header and its k=v folder columns."""
    register(spark)
    reader = spark.read.format("las_headers").options(**source_options(spark, options))
    if columns is not None:
        reader = reader.schema(T.StructType([HEADER_SCHEMA[c] for c in columns]))
    return load(reader, path)


def write_las(
    df: DataFrame,
    path: str,
    mode: str = "error",
    *,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    curve_by: Sequence[str] = (),
    num_partitions: int | None = None,
    **options,
) -> None:
    """Write points as LAS files.

    ``partition_by`` puts rows into k=v folders; rows are sorted by it inside each task, never
    shuffled by it, so one frequent value cannot overload a task. ``cluster_by`` (say x, y)
    range-partitions first, which keeps the bounds in the file headers tight; a hash of the whole
    row breaks ties, so points that share one place still spread. ``curve_by`` (one to four columns) does so
    along a Hilbert curve over them: files get compact boxes that hardly overlap, where ``cluster_by`` gives strips
    across all of the second column. It reads ``df`` twice more: for the columns' ends and for Spark's sample of keys.
    """
    register(df.sparkSession)
    if mode not in ("error", "errorifexists", "ignore", "append", "overwrite"):
        raise ValueError(f"unknown save mode {mode!r}")
    if mode in ("error", "errorifexists", "ignore"):
        try:
            present = bool(list_files({"path": path}))
        except FileNotFoundError:
            present = False
        if present and mode == "ignore":
            return
        if present:
            raise FileExistsError(f"{path} already holds files; use mode append or overwrite")
        mode = "append"
    if cluster_by and curve_by:
        raise ValueError("give cluster_by or curve_by")
    if curve_by:
        keyed = df.withColumn("__key", hilbert_key(df, curve_by))
        order = [F.col("__key"), F.xxhash64(*df.columns)]
        df = keyed.repartitionByRange(*([num_partitions] if num_partitions else []), *order).drop("__key")
    elif cluster_by:
        order = [F.col(c) for c in cluster_by] + [F.xxhash64(*df.columns)]
        df = df.repartitionByRange(*([num_partitions] if num_partitions else []), *order)
    elif num_partitions:
        df = df.repartition(num_partitions)
    if partition_by:
        df = df.sortWithinPartitions(*partition_by)
        options["partitionColumns"] = ",".join(partition_by)
    text = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    publish_las(df.sparkSession, path)  # of a write before that did not get that far
    df.write.format("las").mode(mode).options(**{**text, "publishLater": "true"}).save(path)
    publish_las(df.sparkSession, path)


def publish_las(spark: SparkSession, path: str) -> int:
    """Moves committed files to their places and deletes replaced ones, in Spark jobs; returns how many were left to do.

    ``write_las`` ends with it. Readers see the result of a write as soon as its journal is there, and a
    write that failed on the way goes on here.
    """
    register(spark)
    fs, inner = filesystem(path)
    done = 0
    for journal in pending(fs, inner.rstrip("/")):
        make_folders(fs, journal.base, journal.moves)
        for work in ("move", "delete"):
            job = spark.read.format("las_publish").options(**source_options(spark, {"job": journal.name, "work": work}))
            done += job.load(path).agg(F.sum("files")).first()[0] or 0
        finish(fs, journal)
    return done
