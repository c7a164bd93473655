"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe.operators.session import register

WORD_CHARS = r"[^\x20\x09-\x0D]+"  # a word is a run of anything but ASCII white space

_local: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark)  # ships this package to the Python workers
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: below ``spark.checkpoint.dir``.

    Only a session in local mode may leave the setting unset; it gets a temporary folder.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        key = context.applicationId
        if key not in _local:
            _local[key] = tempfile.mkdtemp(prefix="lidarframe-llm-")
        shared = _local[key]
    return f"{shared.rstrip('/')}/llm-{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes a table to the shared folder and reads it: cuts lineage, survives lost executors.

    What is non-deterministic in ``df`` (row ids of a shuffled input, say) is fixed from here on.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hidden(columns: list[str]) -> list[Column]:
    """All columns under names of their own (c0, c1, ...), so that no helper column can clash with one."""
    return [named(c).alias(f"c{k}") for k, c in enumerate(columns)]


def shown(columns: list[str]) -> list[Column]:
    """The columns that :func:`hidden` renamed, by their old names."""
    return [F.col(f"c{k}").alias(c) for k, c in enumerate(columns)]


def named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def with_row_keys(rows: DataFrame, *more: Column) -> DataFrame:
    """``rows`` with hidden columns, ``more``, and longs row_file and row_at that name a row for good.

    Rows of a table of files are named by a hash of the file and the place in it, however Spark splits
    files in a later job. Any other table is written once and read from there.
    """
    columns = [*hidden(rows.columns), *more]
    if _rows_of_files(rows):
        return rows.select(
            *columns,
            F.xxhash64("_metadata.file_path").alias("row_file"),
            F.col("_metadata.row_index").alias("row_at"),
        )
    row = F.monotonically_increasing_id()  # number of the partition in the upper bits, place in it in 33 lower ones
    keys = F.shiftright(row, 33).alias("row_file"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("row_at")
    return materialise(rows.select(*columns, *keys), "numbered", "zstd")


def _rows_of_files(rows: DataFrame) -> bool:
    """Whether each row is one row of a file: a scan, filtered and projected by nothing random."""
    if "_metadata" in (c.lower() for c in rows.columns):
        return False
    plan = rows._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias") and plan.deterministic():
        plan = plan.child()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    try:
        rows.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 1 << 20
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of Arrow batches with about ``size`` bytes of text, and their texts as UTF-8."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary())
        lengths = pc.binary_length(texts).fill_null(0).to_pylist()
        total, begin = 0, 0
        for k, n in enumerate(lengths):
            total += n
            if total >= size or k + 1 == batch.num_rows:
                part = batch.slice(begin, k + 1 - begin)
                yield part, texts.slice(begin, k + 1 - begin).to_pylist()
                total, begin = 0, k + 1


def crc_text(column: str):
    """CRC-32 of a number written as text, as the contracts split training and held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
