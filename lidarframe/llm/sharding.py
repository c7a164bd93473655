"""Two-pass external shuffle into shards, in DataFrame functions only.

Pass one scatters rows uniformly into buckets of a bounded size by a seeded hash of their row number;
content plays no part, so copies and frequent keys scatter as well. The row numbers are fixed by a
written table, so both passes and repeated tasks see the same ones. Pass two numbers each bucket's
rows, draws one Fisher-Yates permutation of these numbers per bucket (Spark's ``shuffle``) and
deals the buckets' permuted rows out to the shards in turn. Buckets are sorted outside memory;
only permutations, eight bytes a row of one bucket, are held as arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lidarframe.llm.common import hidden, materialise, new_path, shown, table

SHARDS = 40
SEED = 20240501
BUCKET_BYTES = 32 << 20
BUCKET_GROUP = 4096  # buckets whose rows are summed up together


def shard(
    rows: DataFrame,
    num_shards: int = SHARDS,
    size: str | None = None,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The rows with columns shard (int, from 0) and slot (long, gapless from 0 in each shard).

    The counts of rows of two shards differ by one at most, and the order over all shards is a random
    permutation. ``size`` is a SQL expression for a row's bytes (16 if not given), it only sets the
    number of buckets. Nulls, empty and repeated rows are rows like any other; an empty table
    gives an empty table. Columns named shard or slot are replaced;
    any other name is free.
    """
    columns = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    marked = rows.select(
        *hidden(columns),
        F.expr(f"cast({size or 16} as long)").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    scattered = materialise(marked, "scattered", "zstd")
    total = scattered.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(buckets)).alias("bucket")

    permutations = (
        _numbered_buckets(scattered.groupBy(bucket).agg(F.count("*").alias("n")))
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .withColumn("to", F.shuffle(F.expr("sequence(0L, n - 1L)"), seed))
        .drop("n")
    )
    inside = Window.partitionBy("bucket").orderBy(F.xxhash64(F.lit(seed + 1), "row"), "row")
    numbered = scattered.select("*", bucket).withColumn("k", F.row_number().over(inside))
    place = F.col("before") + F.element_at("to", F.col("k"))
    return numbered.join(permutations, "bucket").select(
        *shown(columns),
        F.pmod(place, F.lit(num_shards)).cast("int").alias("shard"),
        F.floor(place / num_shards).alias("slot"),
    )


def _numbered_buckets(counts: DataFrame) -> DataFrame:
    """(bucket, n, before): rows of the buckets before each. Sums run inside groups of buckets and over groups,
    so no task sees all buckets of a large table."""
    group = F.floor(F.col("bucket") / BUCKET_GROUP)
    counts = counts.withColumn("group", group)
    earlier = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("group").agg(F.sum("n").alias("all"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    return counts.join(groups, "group").select(
        "bucket", "n", (F.col("base") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("before")
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Writes the result of :func:`shard` as Parquet: a folder per shard, each file in slot order.

    The rows lie by buckets, and a bucket fills one range of slots of every shard, so each task writes its
    buckets' ranges and texts are not shuffled once more.
    """
    (
        sharded.sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "zstd")
        .parquet(path)
    )


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """Whole documents are dealt and written; size and text_crc32 are taken from the files."""
    size = "cast(coalesce(octet_length(text), 0) + 16 as long)"
    sharded = shard(table(spark, sf_dir, "documents"), SHARDS, size=size)
    path = new_path(spark, "shards")
    write_shards(sharded, path)
    return spark.read.schema(sharded.schema).parquet(path).select(
        "doc_id",
        F.expr(size).alias("size"),
        F.expr("coalesce(crc32(cast(text as binary)), 0L)").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
