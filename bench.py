"""Headline timings; prints one JSON line. Inputs are written before the clock starts."""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe import las_agg, las_audit, read_las, refresh_header_index, write_las
from lidarframe.plans import catalog, fixtures
from lidarframe.sources.layouts import POINT_FORMATS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "32"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    points = fixtures.lineitem_points(spark, SF_DIR, 1)
    total = points.count()
    folders = {}
    for files in (1, 16, 256):
        path = f"{fixtures.scratch(spark)}/files-{files}"
        write_las(points.coalesce(1), path, pointFormat=1, maxPointsPerFile=-(-total // files))
        folders[files] = path
    one = folders[1]
    size = sum(f.stat().st_size for f in Path(one).glob("*.las"))
    seven = {**catalog.BOUNDS, "points": "count(x)"}

    # a cloud large enough for scans to cost something: lineitem, COPIES times, a little apart
    large = f"{fixtures.scratch(spark)}/large"
    apart = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    copies = points.withColumn("copy", apart).withColumn("x", F.col("x") + 0.01 * F.col("copy")).drop("copy")
    start = time.perf_counter()
    write_las(copies, large, curve_by=["x", "y"], num_partitions=64, pointFormat=1)
    large_write = round(time.perf_counter() - start, 4)
    index = f"{fixtures.scratch(spark)}/large-index"
    refresh_header_index(spark, large, index)
    box = "x > 20000 AND x < 60000 AND y > 10 AND y < 40"
    outputs = iter(range(10**6))

    cases = {
        "las_scan_all_columns": lambda: drain(read_las(spark, one, POINT_FORMATS[1])),
        "las_scan_two_columns": lambda: drain(read_las(spark, one, ["x", "gps_time"])),
        "las_filter": lambda: drain(catalog.las_filter(spark, SF_DIR)),
        "las_mixed_formats": lambda: drain(catalog.las_mixed_formats(spark, SF_DIR)),
        "las_write": lambda: write_las(
            points, f"{fixtures.scratch(spark)}/written-{next(outputs)}", pointFormat=1
        ),
        "las_header_audit": lambda: las_audit(spark, one).collect(),
        "records_encode": lambda: drain(catalog.records_encode(spark, SF_DIR)),
        "records_decode": lambda: drain(catalog.records_decode(spark, SF_DIR)),
        "hdr_fallback_group": lambda: catalog.queries()["hdr_fallback_group"](spark, SF_DIR).collect(),
    }
    cases |= {
        "large_scan_all_columns": lambda: drain(read_las(spark, large, POINT_FORMATS[1])),
        "large_scan_two_columns": lambda: drain(read_las(spark, large, ["x", "gps_time"])),
        "large_scan_exact": lambda: drain(read_las(spark, large, ["x"], exact=2)),
        "large_bounds_headers": lambda: las_agg(spark, large, seven).collect(),
        "large_bounds_index": lambda: las_agg(spark, large, seven, index=index).collect(),
        "large_bounds_scan": lambda: las_agg(spark, large, seven, verify=True).collect(),
        "large_box_headers": lambda: las_agg(spark, large, seven, where=box).collect(),
        "large_box_scan": lambda: las_agg(spark, large, seven, where=box, verify=True).collect(),
    }
    for splits in (1, 4, 16):
        cases[f"las_split_scan_{splits}"] = lambda splits=splits: (
            read_las(spark, one, ["x"], splitBytes=-(-size // splits)).agg(F.sum("x")).collect()
        )
    for files, path in folders.items():
        cases[f"hdr_bounds_all_{files}_files"] = lambda path=path: las_agg(spark, path, seven).collect()
        cases[f"scan_bounds_all_{files}_files"] = lambda path=path: (
            las_agg(spark, path, seven, verify=True).collect()
        )

    timings = {"large_write_curve": large_write}
    for name, run in cases.items():
        run()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name,
                "points": total,
                "large_points": total * COPIES,
            }
        )
    )


if __name__ == "__main__":
    main()
