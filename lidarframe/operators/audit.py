"""Comparison of file headers with the files they describe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe.operators.session import register
from lidarframe.operators.tables import Paths, load, source_options
from lidarframe.sources.layouts import COORDINATES, POINT_FORMATS, format_length


def las_audit(spark: SparkSession, path: Paths, tolerance: float = 0.5, **options) -> DataFrame:
    """One row per file: header count and bounds against the points, lengths against the layout.

    Bounds may differ by ``tolerance`` scale steps, since some writers round them. Points are
    reduced to one row per byte range where they are read, and to one per file and task before
    the only shuffle.
    """
    register(spark)
    ranges = load(
        spark.read.format("las_range_stats").options(**source_options(spark, options)), path
    )
    # header values and the error are the same in all ranges of a file
    numbers = ["file_length", "point_format", "point_offset", "record_length", "point_count"]
    numbers += [f"{n}_{c}" for n in ("scale", "min", "max") for c in COORDINATES]
    files = ranges.groupBy("path", "error").agg(
        *[F.max(n).alias(n) for n in numbers],
        F.coalesce(F.sum("scanned_points"), F.lit(0)).alias("scanned_points"),
        *[F.min(f"scanned_min_{c}").alias(f"scanned_min_{c}") for c in COORDINATES],
        *[F.max(f"scanned_max_{c}").alias(f"scanned_max_{c}") for c in COORDINATES],
    )
    bounds_match = F.lit(True)
    for c in COORDINATES:
        step = F.abs(F.col(f"scale_{c}")) * tolerance
        for end in ("min", "max"):
            bounds_match &= F.abs(F.col(f"{end}_{c}") - F.col(f"scanned_{end}_{c}")) <= step
    least_length = F.create_map(*[F.lit(v) for f in POINT_FORMATS for v in (f, format_length(f))])
    points_end = F.col("point_offset") + F.col("record_length") * F.col("point_count")
    checks = {
        "count_ok": F.col("point_count") == F.col("scanned_points"),
        "bounds_ok": (F.col("scanned_points") == 0) | bounds_match,
        "length_ok": F.col("file_length") >= points_end,
        "record_ok": F.col("record_length") >= least_length[F.col("point_format")],
    }
    checked = files.select(
        "path",
        "point_format",
        "file_length",
        F.col("point_count").alias("header_points"),
        "scanned_points",
        *[
            (F.col("error").isNull() & F.coalesce(check, F.lit(False))).alias(name)
            for name, check in checks.items()
        ],
        "error",
    )
    return checked.withColumn("ok", F.expr(" AND ".join(checks)))
