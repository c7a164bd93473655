"""Queries over LAS copies of the driver tables, and the same results as SQL on the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe.functions.fields import format_schema, point_schema
from lidarframe.functions.records import decode_points, encode_points
from lidarframe.operators.aggregate import las_agg
from lidarframe.operators.audit import las_audit
from lidarframe.operators.header_index import refresh_header_index
from lidarframe.operators.listing import list_las, read_listed
from lidarframe.operators.session import register
from lidarframe.operators.tables import las_view, read_headers, read_las, write_las
from lidarframe.operators.vlrs import read_vlrs
from lidarframe.operators.waveforms import amplitudes, read_waveforms
from lidarframe.plans import fixtures
from lidarframe.sources.layouts import COORDINATES, POINT_FORMATS
from lidarframe.streaming.files import stream_las

Query = Callable[[SparkSession, str], DataFrame]

# Fixtures below are written with scale 0.01 and offset 0 unless a query says otherwise.
BOUNDS = {f"{m}_{c}": f"{m}({c})" for m in ("min", "max") for c in COORDINATES}
DOUBLES = {"x", "y", "z", "gps_time"}


def widened(points: DataFrame) -> DataFrame:
    """Integer columns as bigint, so that results compare with SQL engines by value."""
    return points.select(
        *[F.col(c) if c in DOUBLES or t == "string" else F.col(c).cast("bigint").alias(c) for c, t in points.dtypes]
    )


def las_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    return spark.read.format("las").load(fixtures.lineitem_las(spark, sf_dir))


def las_read_shortcut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_las(spark, fixtures.lineitem_las(spark, sf_dir), ["x", "y", "z"])


def las_default_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_las(spark, fixtures.lineitem_las(spark, sf_dir, 7))


def las_declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.lineitem_las(spark, sf_dir)
    declared = point_schema("z", "intensity", "classification", "x")
    return widened(spark.read.format("las").schema(declared).load(path))


def las_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read_las(
        spark, fixtures.lineitem_las(spark, sf_dir), ["x"], splitBytes=333_333
    )
    cents = F.round(F.col("x") / 0.01).cast("bigint")
    return points.agg(F.count("*").alias("points"), F.sum(cents).alias("sum_x_cents"))


def las_format(point_format: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fixtures.lineitem_las(spark, sf_dir, point_format)
        points = spark.read.format("las").schema(format_schema(point_format)).load(path)
        return widened(points)

    return query


def las_scale_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.lineitem_las(
        spark, sf_dir, 0, scaleX=0.01, scaleY=0.5, scaleZ=0.001, offsetX=50000, offsetY=10, offsetZ=-1
    )
    return read_las(spark, path)


def las_mixed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.mixed_las(spark, sf_dir)
    return widened(read_las(spark, path, ["x", "y", "z", "classification"]))


def las_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.mixed_las(spark, sf_dir)
    return read_las(spark, path, ["x", "gps_time"], missingColumns="null")


def las_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read_las(spark, fixtures.events_las(spark, sf_dir))
    cents = F.round(F.col("x") / 0.01).cast("bigint")
    return points.groupBy("event_type").agg(
        F.count("*").alias("points"), F.sum(cents).alias("sum_x_cents")
    )


def las_partition_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.events_las(spark, sf_dir)
    return widened(read_las(spark, path, ["x", "classification"], filters=[("event_type", "=", "purchase")]))


def las_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.lineitem_las(spark, sf_dir)
    las_view(spark, "las_points", path, ["x"])
    return spark.sql("SELECT count(*) AS points, max(x) AS max_x FROM las_points")


def ingest(spark: SparkSession, path: str, columns, target: str = "parquet", **how) -> None:
    """Takes what has arrived in ``inbox`` into ``table``, file by file."""
    options = {"max_files_per_trigger": 1, "pathGlobFilter": "*.las", **how}
    stream = (
        stream_las(spark, f"{path}/inbox", columns, **options)
        .writeStream.format(target)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/table")
    )
    stream.awaitTermination()


def two_drops(spark: SparkSession, sf_dir: str, name: str, **how) -> str:
    """Lineitem arrives, is ingested, then events arrive; the second run resumes from its checkpoint."""

    def run(path: str) -> None:
        inbox = f"{path}/inbox"
        write_las(fixtures.lineitem_points(spark, sf_dir, 1), inbox, pointFormat=1)
        ingest(spark, path, COORDINATES, **how)
        write_las(fixtures.event_points(spark, sf_dir), inbox, mode="append")
        ingest(spark, path, COORDINATES, **how)

    return f"{fixtures.once(spark, sf_dir, name, run)}/table"


def summed(points: DataFrame) -> DataFrame:
    sums = [F.sum(F.round(F.col(c) / 0.01).cast("bigint")).alias(f"sum_{c}_cents") for c in COORDINATES]
    return points.agg(F.count("*").alias("points"), *sums)


def las_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summed(spark.read.parquet(two_drops(spark, sf_dir, "stream")))


def las_stream_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LAS files in, LAS files out, with a restart in between."""
    return summed(read_las(spark, two_drops(spark, sf_dir, "stream-las", target="las"), COORDINATES))


def las_stream_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files dated back, or that arrive after files of the future, are ingested like others."""
    path = fixtures.dated_drops(spark, sf_dir, lambda p: ingest(spark, p, COORDINATES))
    return summed(spark.read.parquet(f"{path}/table"))


def las_stream_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder columns and paths of a stream."""

    def run(path: str) -> None:
        points = fixtures.event_points(spark, sf_dir, "event_type", "cast(event_id % 3 as int) as third")
        write_las(points, f"{path}/inbox", partition_by=["event_type", "third"])
        ingest(spark, path, ["third", "x", "_path", "event_type"], max_files_per_trigger=7)

    table = spark.read.parquet(f"{fixtures.once(spark, sf_dir, 'stream-folders', run)}/table")
    folder = F.regexp_extract("_path", "event_type=([^/]*)/third=([0-9])/", 2).cast("bigint")
    return table.groupBy("event_type", F.col("third").cast("bigint").alias("third")).agg(
        F.count("*").alias("points"), F.max("x").alias("max_x"), F.min(folder).alias("path_third")
    )


def las_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = fixtures.lineitem_points(spark, sf_dir, 1)
    path = fixtures.once(
        spark,
        sf_dir,
        "roundtrip",
        lambda p: write_las(points, p, cluster_by=["x", "y"], pointFormat=1),
    )
    return widened(read_las(spark, path, POINT_FORMATS[1]))


def las_write_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened(read_las(spark, fixtures.curve_las(spark, sf_dir), POINT_FORMATS[1]))


BOX = "x > 20000 AND NOT (x > 60000 OR y <= 10) AND z < 0.2"


def hdr_box_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and count in a box: headers of files inside, points of files astride."""
    aggs = {**BOUNDS, "points": "count(*)", "timed": "count(gps_time)", "width": "max(x) - min(x)"}
    return las_agg(spark, fixtures.curve_las(spark, sf_dir), aggs, where=BOX)


def hdr_index_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A kept index after two drops and a replacement of files answers like the headers that are there."""
    path, index = fixtures.index_drops(spark, sf_dir, lambda tiles, index: refresh_header_index(spark, tiles, index))
    return las_agg(spark, path, {**BOUNDS, "points": "count(*)"}, index=index)


FOLDERS = "event_type LIKE 'p%' OR event_type IN ('view', 'click')"


def hdr_where_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate on folders alone: no points are read."""
    aggs = {"points": "count(*)", "min_y": "min(y)", "max_x": "max(x)"}
    return las_agg(spark, fixtures.events_las(spark, sf_dir), aggs, where=FOLDERS, group_by=["event_type"])


def hdr_box_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate on folders and coordinates, by folder."""
    aggs = {"points": "count(x)", "min_x": "min(x)", "max_z": "max(z)"}
    path = fixtures.events_las(spark, sf_dir)
    return las_agg(spark, path, aggs, where=f"({FOLDERS}) AND x >= 10 AND z BETWEEN -5 AND 2000", group_by=["event_type"])


EXACT = "x > 1000.05 AND y <= 40"


def las_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of coordinates without rounding, as text."""
    points = read_las(spark, fixtures.lineitem_las(spark, sf_dir), ["x", "y", "z", "classification"], where=EXACT, exact=2)
    sums = [F.sum(c).cast("string").alias(f"sum_{c}") for c in COORDINATES]
    return points.groupBy(F.col("classification").cast("bigint").alias("classification")).agg(
        *sums, F.max("x").cast("string").alias("max_x")
    )


def hdr_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds as decimals, from headers."""
    texts = {f"{m}_{c}": f"CAST({m}({c}) AS STRING)" for m in ("min", "max") for c in COORDINATES}
    return las_agg(spark, fixtures.tiles_las(spark, sf_dir), texts, exact=2)


def las_vlr_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of part as variable-length records of files, and back."""
    found = read_vlrs(spark, fixtures.recorded_las(spark, sf_dir))
    return found.select(
        "user_id",
        F.col("record_id").cast("bigint").alias("record_id"),
        "description",
        "length",
        F.md5("data").alias("digest"),
        F.col("extended").cast("bigint").alias("extended"),
    )


def las_vlr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of files that were given records."""
    return summed(read_las(spark, fixtures.recorded_las(spark, sf_dir), COORDINATES))


def las_waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waveforms of points, found by descriptor, place and size, and sums of their amplitudes."""
    found = read_waveforms(spark, fixtures.waveform_las(spark, sf_dir), ["x", "gps_time"])
    total = F.aggregate(amplitudes("_waveform"), F.lit(0.0), lambda a, b: a + b)
    return found.select(
        "x",
        "gps_time",
        F.md5("_waveform").alias("digest"),
        F.length("_waveform").cast("bigint").alias("size"),
        F.col("wave_packet_descriptor_index").cast("bigint").alias("descriptor"),
        "picoseconds",
        total.alias("amplitude"),
    )


def las_unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        points = fixtures.lineitem_points(spark, sf_dir, 2)
        high = points.withColumn("intensity", F.col("intensity").cast("int") + 32768)
        high = high.withColumn("classification", F.col("classification").cast("short") + 200)
        write_las(high, path, pointFormat=2, unsigned=True)

    path = fixtures.once(spark, sf_dir, "unsigned", write)
    return widened(read_las(spark, path, ["x", "intensity", "classification", "r"], unsigned=True))


def las_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        points = fixtures.lineitem_points(spark, sf_dir, 4)
        wave = points.withColumn("parametric_dx", (F.col("parametric_dx") / 4).cast("float"))
        write_las(wave, path, pointFormat=4, strict=True)

    path = fixtures.once(spark, sf_dir, "strict", write)
    points = read_las(spark, path, ["x", "parametric_dx"], strict=True)
    return points.select("x", F.col("parametric_dx").cast("double").alias("parametric_dx"))


def las_column_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_las(spark, fixtures.lineitem_las(spark, sf_dir), ["x", "gps_time"])


def las_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read_las(spark, fixtures.lineitem_las(spark, sf_dir), ["x", "y", "classification"])
    return widened(points.where("x > 50000 AND classification = 2"))


def las_source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.lineitem_las(spark, sf_dir)
    wanted = [("x", ">", 50000), ("classification", "=", 2)]
    return read_las(spark, path, ["x", "y"], filters=wanted)


def las_count_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read_las(spark, fixtures.lineitem_las(spark, sf_dir), [])
    return points.agg(F.count("*").alias("points"))


def hdr(aggs: dict[str, str], **how) -> Query:
    return lambda spark, sf_dir: las_agg(spark, fixtures.tiles_las(spark, sf_dir), aggs, **how)


def hdr_after_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers answer while the points are held in memory, and agree with these."""
    path = fixtures.tiles_las(spark, sf_dir)
    points = read_las(spark, path, ["x"]).cache()
    try:
        held = points.count()  # fills the cache
        answer = las_agg(spark, path, {**BOUNDS, "points": "count(x)"})
        if answer.first().points != held:
            raise ValueError(f"headers count {answer.first().points} points, the cache holds {held}")
    finally:
        points.unpersist()
    return answer


def hdr_group_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"points": "count(*)", "min_x": "min(x)", "max_x": "max(x)"}
    return las_agg(spark, fixtures.events_las(spark, sf_dir), aggs, group_by=["event_type"])


def las_where_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate on a folder column and on points; folders it rules out are not opened."""
    path = fixtures.events_las(spark, sf_dir)
    return widened(read_las(spark, path, ["x", "classification"], where="event_type LIKE 'p%' AND x > 10 AND y >= 1"))


LISTED = "third >= 1 AND event_type <> 'error' AND x > 10"


def las_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of folders listed by Spark jobs; one listing serves types, pruning and scan."""

    def write(path: str) -> None:
        points = fixtures.event_points(spark, sf_dir, "event_type", "cast(event_id % 3 as int) as third")
        write_las(points, path, partition_by=["event_type", "third"])

    path = fixtures.once(spark, sf_dir, "tree", write)
    listing = list_las(spark, path, fixtures.fresh(spark, "listing"), pathGlobFilter="*.las")
    points = read_listed(spark, listing, ["event_type", "third", "x", "y", "classification"], where=LISTED)
    return widened(points)


def las_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = read_headers(spark, fixtures.flagged_las(spark, sf_dir))
    return headers.groupBy("flag").agg(
        F.max("version").alias("version"),
        F.max(F.col("header_size").cast("bigint")).alias("header_size"),
        F.max(F.col("record_length").cast("bigint")).alias("record_length"),
        F.sum("point_count").alias("points"),
        F.sum(F.col("file_length") - F.col("point_offset")).alias("point_bytes"),
        *[F.max(F.col(n).cast("bigint")).alias(n) for n in ("point_offset", "n_vlr", "point_format")],
        *[F.max(f"{kind}_{c}").alias(f"{kind}_{c}") for kind in ("scale", "offset") for c in COORDINATES],
        *[getattr(F, m)(f"{m}_{c}").alias(f"{m}_{c}") for m in ("min", "max") for c in COORDINATES],
    )


def las_header_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = las_audit(spark, fixtures.mixed_las(spark, sf_dir))
    return audit.groupBy(F.col("point_format").cast("bigint").alias("point_format")).agg(
        F.sum("header_points").alias("header_points"),
        F.sum("scanned_points").alias("scanned_points"),
        F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("bad_files"),
    )


def las_audit_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit finds in headers with wrong counts and bounds, by folder."""
    audit = las_audit(spark, fixtures.faulty_las(spark, sf_dir))
    part = F.regexp_extract("path", "part=([0-9]+)/", 1).cast("bigint").alias("part")
    files = F.count("*")
    return audit.groupBy(part).agg(
        F.sum("scanned_points").alias("scanned_points"),
        ((F.sum("header_points") - F.sum("scanned_points")) / files).cast("bigint").alias("off_by"),
        *[F.when(F.every(c), 1).when(~F.some(c), 0).cast("bigint").alias(c) for c in ("count_ok", "bounds_ok", "length_ok", "ok")],
    )


def records_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = fixtures.lineitem_points(spark, sf_dir, 0, "l_orderkey", "cast(l_linenumber as bigint) as l_linenumber")
    packed = encode_points(points, 0, keep=["l_orderkey", "l_linenumber"])
    return packed.select("l_orderkey", "l_linenumber", F.lower(F.hex("record")).alias("record"))


def records_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = spark.read.parquet(fixtures.packed_lineitem(spark, sf_dir))
    return widened(decode_points(packed, "record", 1))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "las_scan": las_scan,
        "las_read_shortcut": las_read_shortcut,
        "las_default_schema": las_default_schema,
        "las_declared_schema": las_declared_schema,
        "las_split_scan": las_split_scan,
    }
    found.update({f"las_format_{f}": las_format(f) for f in POINT_FORMATS})
    found.update(
        {
            "las_scale_offset": las_scale_offset,
            "las_mixed_formats": las_mixed_formats,
            "las_missing_columns": las_missing_columns,
            "las_partition_columns": las_partition_columns,
            "las_partition_pruning": las_partition_pruning,
            "las_sql_view": las_sql_view,
            "las_stream_ingest": las_stream_ingest,
            "las_stream_roundtrip": las_stream_roundtrip,
            "las_stream_dated": las_stream_dated,
            "las_stream_folders": las_stream_folders,
            "las_write_roundtrip": las_write_roundtrip,
            "las_write_curve": las_write_curve,
            "las_waveforms": las_waveforms,
            "las_exact": las_exact,
            "hdr_exact": hdr_exact,
            "las_vlr_roundtrip": las_vlr_roundtrip,
            "las_vlr_points": las_vlr_points,
            "las_unsigned": las_unsigned,
            "las_strict": las_strict,
            "las_column_pruning": las_column_pruning,
            "las_filter": las_filter,
            "las_source_filter": las_source_filter,
            "las_count_scan": las_count_scan,
        }
    )
    found.update({f"hdr_{name}": hdr({name: text}) for name, text in BOUNDS.items()})
    found.update(
        {
            "hdr_count": hdr({"points": "count(*)", "count_x": "count(x)", "count_gps": "count(gps_time)"}),
            "hdr_bounds_all": hdr({**BOUNDS, "points": "count(x)"}),
            "hdr_agg_expression": hdr(
                {
                    "dx": "max(x) - min(x)",
                    "mid_y": "(max(y) + min(y)) / 2",
                    "points_text": "cast(count(*) AS string)",
                }
            ),
            "hdr_fallback_filter": hdr(
                {**BOUNDS, "points": "count(*)"}, where="x > 50000 AND classification = 2"
            ),
            "hdr_fallback_group": hdr(
                {"points": "count(*)", "min_x": "min(x)", "max_x": "max(x)"},
                group_by=["cast(classification AS bigint) AS classification"],
            ),
            "hdr_fallback_sum": hdr(
                {
                    "mixed": "min(x) + sum(CAST(round(y) AS bigint))",
                    "distinct_y": "count(DISTINCT y)",
                    "points": "count(*)",
                }
            ),
            "hdr_group_folder": hdr_group_folder,
            "hdr_box_agg": hdr_box_agg,
            "hdr_where_folder": hdr_where_folder,
            "hdr_index_refresh": hdr_index_refresh,
            "hdr_box_folder": hdr_box_folder,
            "las_where_folder": las_where_folder,
            "hdr_after_cache": hdr_after_cache,
            "las_listed": las_listed,
            "las_headers": las_headers,
            "las_header_audit": las_header_audit,
            "las_audit_faults": las_audit_faults,
            "records_encode": records_encode,
            "records_decode": records_decode,
        }
    )
    return found


def grid(value: str, scale: str = "0.01", offset: str = "0.0") -> str:
    """SQL of a coordinate after writing and reading it: rounded to the grid, then rebuilt."""
    shift = f"({value} - {offset}::DOUBLE)" if offset != "0.0" else f"({value})"
    return f"CAST(round({shift} / {scale}::DOUBLE) AS BIGINT) * {scale}::DOUBLE + {offset}::DOUBLE"


def cents(value: str) -> str:
    return f"CAST(round(({value}) / 0.01::DOUBLE) AS BIGINT)"


# The point mappings of the fixtures as SQL on the driver tables.
LINEITEM_SQL = {
    "x": grid("l_extendedprice"),
    "y": grid("l_quantity"),
    "z": grid("l_discount"),
    "intensity": "l_partkey % 32768",
    "r_n_s_e": "l_linenumber",
    "classification": "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END",
    "scan_angle_rank_left_side": "round(l_tax * 100)",
    "user_data": "CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END",
    "point_source_id": "l_suppkey % 32768",
    "gps_time": "epoch(l_shipdate)",
    "r": "l_orderkey % 32768",
    "g": "(l_orderkey + 1) % 32768",
    "b": "(l_orderkey + 2) % 32768",
    "wave_packet_descriptor_index": "l_linenumber",
    "byte_offset_to_waveform_data": "l_orderkey",
    "waveform_packet_size_in_bytes": "l_partkey",
    "return_point_waveform_location": "l_suppkey",
    "parametric_dx": "l_suppkey + 1",
    "parametric_dy": "l_suppkey + 2",
    "parametric_dz": "l_suppkey + 3",
    "r_n_c_s_s_e": "l_linenumber",
    "scan_angle": "round(l_tax * 100)",
    "nir": "(l_orderkey + 3) % 32768",
}
LINEITEM_SQL_VALUES = {"x": "l_extendedprice", "y": "l_quantity", "z": "l_discount"}  # before they are rounded
EVENT_SQL = {
    "x": grid("value"),
    "y": grid("user_id"),
    "z": grid("event_id % 1000"),
    "classification": "CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3"
    " WHEN 'signup' THEN 4 ELSE 5 END",
}


def columns_sql(mapping: dict[str, str], names) -> str:
    kinds = {n: "DOUBLE" if n in DOUBLES else "BIGINT" for n in names}
    return ", ".join(f"CAST({mapping[n]} AS {kinds[n]}) AS {n}" for n in names)


def lineitem_sql(*names: str, where: str = "") -> str:
    return f"SELECT {columns_sql(LINEITEM_SQL, names)} FROM lineitem {where}".strip()


def events_sql(*names: str, where: str = "") -> str:
    return f"SELECT {columns_sql(EVENT_SQL, names)} FROM events {where}".strip()


def bytes_sql(value: str, width: int) -> str:
    """SQL of an integer's little-endian bytes as hex text."""
    parts = ", ".join(f"(v >> {8 * i}) & 255" for i in range(width))
    return f"(SELECT printf('{'%02x' * width}', {parts}) FROM (SELECT CAST({value} AS BIGINT) AS v))"


def oracle_sql() -> dict[str, str]:
    xyz = lineitem_sql("x", "y", "z")
    p = f"({lineitem_sql('x', 'y', 'z', 'classification', 'gps_time')}) AS p"
    bounds = ", ".join(f"{text} AS {name}" for name, text in BOUNDS.items())
    both = f"{lineitem_sql('x', 'y', 'z')} UNION ALL {events_sql('x', 'y', 'z')}"
    sums = ", ".join(f"CAST(sum({cents(c)}) AS BIGINT) AS sum_{c}_cents" for c in COORDINATES)
    decimals = "(SELECT " + ", ".join(
        f"CAST({LINEITEM_SQL_VALUES[c]} AS DECIMAL(18, 2)) AS {c}" for c in COORDINATES
    ) + f", CAST({LINEITEM_SQL['classification']} AS BIGINT) AS classification FROM lineitem) AS d"
    lineitem_sums = ", ".join(
        f"CAST(sum({cents(v)}) AS BIGINT) AS sum_{c}_cents" for c, v in LINEITEM_SQL_VALUES.items()
    )
    found = {
        "las_scan": xyz,
        "las_read_shortcut": xyz,
        "las_default_schema": xyz,
        "las_declared_schema": lineitem_sql("z", "intensity", "classification", "x"),
        "las_split_scan": f"SELECT count(*) AS points, CAST(sum({cents('l_extendedprice')}) AS BIGINT)"
        " AS sum_x_cents FROM lineitem",
    }
    found.update({f"las_format_{f}": lineitem_sql(*names) for f, names in POINT_FORMATS.items()})
    found.update(
        {
            "las_scale_offset": f"SELECT {grid('l_extendedprice', '0.01', '50000.0')} AS x, "
            f"{grid('l_quantity', '0.5', '10.0')} AS y, {grid('l_discount', '0.001', '-1.0')} AS z FROM lineitem",
            "las_mixed_formats": lineitem_sql("x", "y", "z", "classification")
            + " UNION ALL "
            + events_sql("x", "y", "z", "classification"),
            "las_missing_columns": lineitem_sql("x", "gps_time")
            + f" UNION ALL SELECT {EVENT_SQL['x']} AS x, CAST(NULL AS DOUBLE) AS gps_time FROM events",
            "las_partition_columns": f"SELECT event_type, count(*) AS points, CAST(sum({cents('value')})"
            " AS BIGINT) AS sum_x_cents FROM events GROUP BY event_type",
            "las_partition_pruning": events_sql("x", "classification", where="WHERE event_type = 'purchase'"),
            "las_sql_view": f"SELECT count(*) AS points, max(x) AS max_x FROM {p}",
            "las_stream_ingest": f"SELECT count(*) AS points, {sums} FROM ({both}) AS b",
            "las_stream_roundtrip": f"SELECT count(*) AS points, {sums} FROM ({both}) AS b",
            "las_stream_dated": f"SELECT count(*) AS points, {sums} FROM ({both}) AS b",
            "las_stream_folders": f"SELECT event_type, event_id % 3 AS third, count(*) AS points, max({EVENT_SQL['x']}) AS max_x, "
            "event_id % 3 AS path_third FROM events GROUP BY event_type, event_id % 3",
            "las_write_roundtrip": lineitem_sql(*POINT_FORMATS[1]),
            "las_write_curve": lineitem_sql(*POINT_FORMATS[1]),
            "las_waveforms": f"SELECT {columns_sql(LINEITEM_SQL, ['x', 'gps_time'])}, md5(w) AS digest, strlen(w) AS size, "
            "CASE WHEN w IS NULL THEN 0 ELSE l_linenumber END::BIGINT AS descriptor, "
            "CASE WHEN w IS NOT NULL THEN 1000 * l_linenumber END::BIGINT AS picoseconds, "
            "list_sum(list_transform(string_split(w, ''), lambda c: 0.5::DOUBLE * ascii(c) - 1))::DOUBLE AS amplitude FROM (SELECT *, "
            "CASE WHEN l_linenumber <> 7 THEN l_orderkey || '-' || l_partkey || '-' || l_linenumber || '-' || "
            "repeat('w', l_suppkey % 40) END AS w FROM lineitem) AS l",
            "las_exact": f"SELECT classification, {', '.join(f'CAST(sum({c}) AS VARCHAR) AS sum_{c}' for c in COORDINATES)}, "
            f"CAST(max(x) AS VARCHAR) AS max_x FROM {decimals} WHERE {EXACT} GROUP BY classification",
            "hdr_exact": "SELECT "
            + ", ".join(f"CAST({m}({c}) AS VARCHAR) AS {m}_{c}" for m in ("min", "max") for c in COORDINATES)
            + f" FROM {decimals}",
            "las_vlr_roundtrip": "SELECT p_brand AS user_id, p_partkey % 65536 AS record_id, substr(p_type, 1, 32) AS description, "
            "strlen(d) AS length, md5(d) AS digest, CAST(strlen(d) > 65535 AS BIGINT) AS extended FROM (SELECT *, "
            "p_name || ' ' || p_partkey || CASE WHEN p_partkey % 10 = 0 THEN repeat('.', 70000) ELSE '' END AS d FROM part) AS q",
            "las_vlr_points": f"SELECT count(*) AS points, {lineitem_sums} FROM lineitem",
            "las_unsigned": f"SELECT {LINEITEM_SQL['x']} AS x, CAST(l_partkey % 32768 + 32768 AS BIGINT) AS "
            f"intensity, CAST({LINEITEM_SQL['classification']} + 200 AS BIGINT) AS classification, "
            "CAST(l_orderkey % 32768 AS BIGINT) AS r FROM lineitem",
            "las_strict": f"SELECT {LINEITEM_SQL['x']} AS x, CAST(l_suppkey + 1 AS DOUBLE) / 4 AS parametric_dx"
            " FROM lineitem",
            "las_column_pruning": lineitem_sql("x", "gps_time"),
            "las_filter": f"SELECT x, y, classification FROM {p} WHERE x > 50000 AND classification = 2",
            "las_source_filter": f"SELECT x, y FROM {p} WHERE x > 50000 AND classification = 2",
            "las_count_scan": "SELECT count(*) AS points FROM lineitem",
        }
    )
    found.update({f"hdr_{n}": f"SELECT {text} AS {n} FROM {p}" for n, text in BOUNDS.items()})
    found.update(
        {
            "hdr_count": "SELECT count(*) AS points, count(*) AS count_x, count(*) AS count_gps FROM lineitem",
            "hdr_bounds_all": f"SELECT {bounds}, count(x) AS points FROM {p}",
            "hdr_agg_expression": "SELECT max(x) - min(x) AS dx, (max(y) + min(y)) / 2 AS mid_y, "
            f"CAST(count(*) AS VARCHAR) AS points_text FROM {p}",
            "hdr_fallback_filter": f"SELECT {bounds}, count(*) AS points FROM {p} "
            "WHERE x > 50000 AND classification = 2",
            "hdr_fallback_group": "SELECT classification, count(*) AS points, min(x) AS min_x, "
            f"max(x) AS max_x FROM {p} GROUP BY classification",
            "hdr_fallback_sum": "SELECT min(x) + CAST(sum(CAST(round(y) AS BIGINT)) AS BIGINT) AS mixed, "
            f"count(DISTINCT y) AS distinct_y, count(*) AS points FROM {p}",
            "hdr_group_folder": f"SELECT event_type, count(*) AS points, min({EVENT_SQL['x']}) AS min_x, "
            f"max({EVENT_SQL['x']}) AS max_x FROM events GROUP BY event_type",
            "hdr_box_agg": f"SELECT {bounds}, count(*) AS points, count(*) AS timed, max(x) - min(x) AS width FROM {p} WHERE {BOX}",
            "hdr_index_refresh": f"SELECT {bounds}, count(*) AS points FROM (SELECT l_returnflag, "
            f"{columns_sql(LINEITEM_SQL, COORDINATES)} FROM lineitem) AS f WHERE l_returnflag <> 'N'",
            "hdr_where_folder": f"SELECT event_type, count(*) AS points, min({EVENT_SQL['y']}) AS min_y, "
            f"max({EVENT_SQL['x']}) AS max_x FROM events WHERE {FOLDERS} GROUP BY event_type",
            "hdr_box_folder": f"SELECT event_type, count(*) AS points, min(x) AS min_x, max(z) AS max_z FROM (SELECT event_type, "
            f"{columns_sql(EVENT_SQL, COORDINATES)} FROM events) AS e WHERE ({FOLDERS}) AND x >= 10 AND z BETWEEN -5 AND 2000 "
            "GROUP BY event_type",
            "las_where_folder": f"SELECT x, CAST(classification AS BIGINT) AS classification FROM (SELECT event_type, "
            f"{columns_sql(EVENT_SQL, ['x', 'y', 'classification'])} FROM events) AS e "
            "WHERE event_type LIKE 'p%' AND x > 10 AND y >= 1",
            "las_listed": "SELECT * FROM (SELECT event_type, event_id % 3 AS third, "
            f"{columns_sql(EVENT_SQL, ['x', 'y', 'classification'])} FROM events) AS e WHERE {LISTED}",
            "hdr_after_cache": f"SELECT {bounds}, count(x) AS points FROM {p}",
            "las_headers": "SELECT flag, '1.2' AS version, CAST(227 AS BIGINT) AS header_size, "
            f"CAST(28 AS BIGINT) AS record_length, count(*) AS points, 28 * count(*) AS point_bytes, "
            "CAST(227 AS BIGINT) AS point_offset, CAST(0 AS BIGINT) AS n_vlr, CAST(1 AS BIGINT) AS point_format, "
            + "".join(f"0.01::DOUBLE AS scale_{c}, 0.0::DOUBLE AS offset_{c}, " for c in COORDINATES)
            + f"{bounds} "
            f"FROM (SELECT {columns_sql(LINEITEM_SQL, COORDINATES)}, l_returnflag AS flag FROM lineitem)"
            " AS f GROUP BY flag",
            "las_header_audit": "SELECT CAST(6 AS BIGINT) AS point_format, count(*) AS header_points, count(*) AS "
            "scanned_points, CAST(0 AS BIGINT) AS bad_files FROM lineitem UNION ALL SELECT CAST(0 AS BIGINT), "
            "count(*), count(*), CAST(0 AS BIGINT) FROM events",
            "las_audit_faults": "SELECT part, count(*) AS scanned_points, CAST(off AS BIGINT) AS off_by, "
            "CAST(off = 0 AS BIGINT) AS count_ok, CAST(shift = 0 AS BIGINT) AS bounds_ok, CAST(off <= 0 AS BIGINT) AS length_ok, "
            f"CAST(off = 0 AND shift = 0 AS BIGINT) AS ok FROM (SELECT l_orderkey % {len(fixtures.FAULTS)} AS part FROM lineitem) AS l "
            "JOIN (VALUES " + ", ".join(f"({k}, {n}, {shift}::DOUBLE)" for k, (n, _, shift) in fixtures.FAULTS.items())
            + ") AS f(k, off, shift) ON k = part GROUP BY part, off, shift",
            "records_encode": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
            + " || ".join(
                [bytes_sql(cents(v), 4) for v in ("l_extendedprice", "l_quantity", "l_discount")]
                + [
                    bytes_sql(LINEITEM_SQL[n], w)
                    for n, w in zip(POINT_FORMATS[0][3:], (2, 1, 1, 1, 1, 2), strict=True)
                ]
            )
            + " AS record FROM lineitem",
            "records_decode": f"SELECT l_orderkey, {columns_sql(LINEITEM_SQL, POINT_FORMATS[1])} FROM lineitem",
        }
    )
    return found
