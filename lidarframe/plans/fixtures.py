"""LAS copies of the driver tables, written once per session and table folder."""

from __future__ import annotations

import json
import os
import struct
import tempfile
import time
import uuid
from collections.abc import Callable

import numpy as np
from pyarrow.fs import LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe.functions.records import encode_points
from lidarframe.operators.tables import write_las
from lidarframe.operators.vlrs import write_vlrs
from lidarframe.sources.files import filesystem, list_files
from lidarframe.sources.layouts import POINT_FORMATS, pack_header
from lidarframe.sources.writer import codec_from_options

# Points of `lineitem`: attribute -> Spark SQL.
LINEITEM_POINTS = {
    "x": "l_extendedprice",
    "y": "l_quantity",
    "z": "l_discount",
    "intensity": "cast(l_partkey % 32768 as short)",
    "r_n_s_e": "cast(l_linenumber as byte)",
    "classification": "cast(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as byte)",
    "scan_angle_rank_left_side": "cast(round(l_tax * 100) as byte)",
    "user_data": "cast(case l_linestatus when 'O' then 1 else 0 end as byte)",
    "point_source_id": "cast(l_suppkey % 32768 as short)",
    # by parts, since l_shipdate has no time zone and the session may have any
    "gps_time": "cast(datediff(l_shipdate, date'1970-01-01') * 86400L + hour(l_shipdate) * 3600"
    " + minute(l_shipdate) * 60 + second(l_shipdate) as double)",
    "r": "cast(l_orderkey % 32768 as short)",
    "g": "cast((l_orderkey + 1) % 32768 as short)",
    "b": "cast((l_orderkey + 2) % 32768 as short)",
    "wave_packet_descriptor_index": "cast(l_linenumber as byte)",
    "byte_offset_to_waveform_data": "l_orderkey",
    "waveform_packet_size_in_bytes": "cast(l_partkey as int)",
    "return_point_waveform_location": "cast(l_suppkey as int)",
    "parametric_dx": "cast(l_suppkey + 1 as int)",
    "parametric_dy": "cast(l_suppkey + 2 as int)",
    "parametric_dz": "cast(l_suppkey + 3 as int)",
    "r_n_c_s_s_e": "cast(l_linenumber as short)",
    "scan_angle": "cast(round(l_tax * 100) as short)",
    "nir": "cast((l_orderkey + 3) % 32768 as short)",
}

# Points of `events`: attribute -> Spark SQL.
EVENT_POINTS = {
    "x": "value",
    "y": "cast(user_id as double)",
    "z": "cast(event_id % 1000 as double)",
    "classification": "cast(case event_type when 'click' then 1 when 'error' then 2"
    " when 'purchase' then 3 when 'signup' then 4 else 5 end as byte)",
}

POINTS_PER_FILE = 1_000_000
TILES = 12
CURVE_FILES = 48
_written: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """Folder for written tables: below the cluster's shared checkpoint folder.

    Only a session in local mode may leave that unset; it gets a temporary folder.
    """
    key = (spark.sparkContext.applicationId,)
    if key not in _written:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared:
            _written[key] = f"{shared.rstrip('/')}/lidarframe-{spark.sparkContext.applicationId}"
        else:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            _written[key] = tempfile.mkdtemp(prefix="lidarframe-")
    return _written[key]


def fresh(spark: SparkSession, name: str) -> str:
    """A path that nothing has been written to."""
    return f"{scratch(spark)}/{uuid.uuid4().hex[:12]}-{name}"


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Path of a fixture; ``write`` fills it at the first request."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = fresh(spark, name)  # a retry gets a new one
        write(path)
        _written[key] = path
    return _written[key]


def lineitem_points(spark: SparkSession, sf_dir: str, point_format: int, *extra: str) -> DataFrame:
    columns = [f"{LINEITEM_POINTS[n]} as {n}" for n in POINT_FORMATS[point_format]]
    return table(spark, sf_dir, "lineitem").selectExpr(*columns, *extra)


def spread(points: DataFrame, least: int) -> int:
    """Number of tasks that write a table: ``least``, and more where a task would get over POINTS_PER_FILE points."""
    return max(least, -(-points.count() // POINTS_PER_FILE))


def event_points(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    columns = [f"{sql} as {name}" for name, sql in EVENT_POINTS.items()]
    return table(spark, sf_dir, "events").selectExpr(*columns, *extra)


def lineitem_las(spark: SparkSession, sf_dir: str, point_format: int = 1, **options) -> str:
    options = {"maxPointsPerFile": POINTS_PER_FILE, "pointFormat": point_format, **options}
    name = "lineitem-" + "-".join(f"{k}={options[k]}" for k in sorted(options))
    points = lineitem_points(spark, sf_dir, point_format)
    return once(
        spark, sf_dir, name.replace("=", "_"), lambda path: write_las(points, path, **options)
    )


def tiles_las(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem in twelve files or more, and a file without points."""
    points = lineitem_points(spark, sf_dir, 1)

    def write(path: str) -> None:
        write_las(points, path, num_partitions=spread(points, TILES), pointFormat=1, maxPointsPerFile=POINTS_PER_FILE)
        nothing = pack_header(2, codec_from_options({"pointFormat": 1}), 0, np.zeros(16, np.int64), [0.0] * 3, [0.0] * 3, (2000, 1))
        fs, inner = filesystem(path)
        with fs.open_output_stream(f"{inner.rstrip('/')}/nothing.las") as out:
            out.write(nothing)

    return once(spark, sf_dir, "tiles", write)


def curve_las(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem in 48 files or more along a Hilbert curve over x and y."""
    points = lineitem_points(spark, sf_dir, 1)
    return once(
        spark,
        sf_dir,
        "curve",
        lambda path: write_las(
            points, path, curve_by=["x", "y"], num_partitions=spread(points, CURVE_FILES), pointFormat=1, maxPointsPerFile=POINTS_PER_FILE
        ),
    )


def events_las(spark: SparkSession, sf_dir: str) -> str:
    """Events in one folder per event type."""
    points = event_points(spark, sf_dir, "event_type")
    return once(
        spark,
        sf_dir,
        "events",
        lambda path: write_las(
            points, path, partition_by=["event_type"], maxPointsPerFile=POINTS_PER_FILE
        ),
    )


def mixed_las(spark: SparkSession, sf_dir: str) -> str:
    """Events as point format 0 and lineitem as point format 6 in one folder."""

    def write(path: str) -> None:
        write_las(event_points(spark, sf_dir), path, pointFormat=0)
        write_las(lineitem_points(spark, sf_dir, 6), path, mode="append", pointFormat=6)

    return once(spark, sf_dir, "mixed", write)


def flagged_las(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem with one folder per return flag."""
    points = lineitem_points(spark, sf_dir, 1, "l_returnflag as flag")
    return once(
        spark,
        sf_dir,
        "flagged",
        lambda path: write_las(points, path, partition_by=["flag"], pointFormat=1),
    )


def index_drops(spark: SparkSession, sf_dir: str, refresh: Callable[[str, str], object]) -> tuple[str, str]:
    """Folder and header index: lineitem's flag A, later N, then R in place of one of N's files; refreshed after each."""

    def write(path: str) -> None:
        tasks = spread(table(spark, sf_dir, "lineitem"), 3)  # as many files of each flag

        def drop(flag: str, folder: str) -> None:
            points = lineitem_points(spark, sf_dir, 1, "l_returnflag as flag").where(f"flag = '{flag}'").drop("flag")
            write_las(points, folder, "append", num_partitions=tasks, pointFormat=1)
            refresh(f"{path}/tiles", f"{path}/index")

        fs, inner = filesystem(path)
        drop("A", f"{path}/tiles/a")
        drop("N", f"{path}/tiles/n")
        drop("R", f"{path}/r")
        # the files of N are replaced by those of R, under the names of N's
        old, new = (sorted(f.path for f in list_files({"path": f"{path}/{p}"})) for p in ("tiles/n", "r"))
        for a, b in zip(old, new, strict=True):
            fs.move(b, a)
        refresh(f"{path}/tiles", f"{path}/index")

    path = once(spark, sf_dir, "index", write)
    return f"{path}/tiles", f"{path}/index"


# Folder of `faulty_las` -> what its headers say: change of the count, place of a bound (max x, min x, max y, ...), its change.
FAULTS = {
    0: (0, 0, 0.0),
    1: (-1, 0, 0.0),
    2: (5, 0, 0.0),
    3: (0, 0, 1000.0),
    4: (0, 5, -50.0),
    5: (0, 2, -10.0),
    6: (-1, 4, 3.0),
    7: (0, 3, 0.25),
}


def faulty_las(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem in folders by order key, with wrong counts and bounds in the headers (``FAULTS``)."""

    def spoil(batches):
        for batch in batches:
            for row in batch.to_pylist():
                count, place, change = FAULTS[int(dict(row["keys"])["part"])]
                fs, _ = filesystem(row["root"])
                with fs.open_input_file(row["inner"]) as stream:
                    data = bytearray(stream.read())
                (points,) = struct.unpack_from("<I", data, 107)
                struct.pack_into("<I", data, 107, points + count)
                (bound,) = struct.unpack_from("<d", data, 179 + 8 * place)
                struct.pack_into("<d", data, 179 + 8 * place, bound + change)
                with fs.open_output_stream(row["inner"]) as out:
                    out.write(data)
            yield batch.select(["path"])

    def write(path: str) -> None:
        points = lineitem_points(spark, sf_dir, 1, f"l_orderkey % {len(FAULTS)} as part")
        # by ranges of (part, hash of the row): files mostly hold one part, a task only a piece of it
        tasks = spread(points, len(FAULTS))
        write_las(points, path, partition_by=["part"], cluster_by=["part"], num_partitions=tasks, pointFormat=1, maxPointsPerFile=POINTS_PER_FILE)
        spark.read.format("las_files").load(path).mapInArrow(spoil, "path string").count()

    return once(spark, sf_dir, "faulty", write)


def dated_drops(spark: SparkSession, sf_dir: str, ingest: Callable[[str], object]) -> str:
    """Flags of lineitem arrive one by one and are ingested: A, N with times of years ago, events with times of
    tomorrow, then R with plain times. Only local files can be dated."""

    def write(path: str) -> None:
        inbox, seen = f"{path}/inbox", set()
        lineitem = lineitem_points(spark, sf_dir, 1, "l_returnflag as flag")
        drops = [(lineitem.where("flag = 'A'").drop("flag"), 0), (lineitem.where("flag = 'N'").drop("flag"), -3000)]
        drops += [(event_points(spark, sf_dir), 1), (lineitem.where("flag = 'R'").drop("flag"), 0)]
        for points, days in drops:
            write_las(points, inbox, "append", num_partitions=2, pointFormat=1 if "gps_time" in points.columns else 0)
            for file in list_files({"path": inbox}):
                if file.path not in seen and isinstance(filesystem(file.root)[0], LocalFileSystem):
                    then = time.time() + 86400 * days
                    os.utime(file.path, (then, then))
                seen.add(file.path)
            ingest(path)

    return once(spark, sf_dir, "dated", write)


WAVEFORM = "concat_ws('-', l_orderkey, l_partkey, l_linenumber, repeat('w', cast(l_suppkey % 40 as int)))"


def waveform_las(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem with a waveform of ASCII samples for each point but every seventh line."""
    left_out = {"byte_offset_to_waveform_data", "waveform_packet_size_in_bytes"}
    packet = f"if(l_linenumber = 7, null, encode({WAVEFORM}, 'UTF-8')) as _waveform"
    points = lineitem_points(spark, sf_dir, 9, packet).drop(*left_out)
    wave = json.dumps({k: [8, 0, 1000 * k, 0.5, -1.0] for k in range(1, 7)})
    how = {"pointFormat": 9, "waveDescriptors": wave, "maxPointsPerFile": POINTS_PER_FILE}
    return once(spark, sf_dir, "waveforms", lambda path: write_las(points, path, num_partitions=spread(points, 6), **how))


# Records of `part`; every tenth is longer than a plain record may be.
PART_RECORDS = {
    "user_id": "p_brand",
    "record_id": "p_partkey % 65536",
    "description": "substr(p_type, 1, 32)",
    "data": "encode(concat(p_name, ' ', p_partkey, if(p_partkey % 10 = 0, repeat('.', 70000), '')), 'UTF-8')",
}


def recorded_las(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem in eight LAS 1.4 files or more that carry the rows of `part` as variable-length records."""

    def write(path: str) -> None:
        points = lineitem_points(spark, sf_dir, 6)
        write_las(points, path, num_partitions=spread(points, 8), pointFormat=6, maxPointsPerFile=POINTS_PER_FILE)
        ring = [r.path for r in spark.read.format("las_files").load(path).orderBy("path").collect()]
        names = F.array(*map(F.lit, ring))
        # rows are dealt out before they become records, which are many times as long
        parts = table(spark, sf_dir, "part").repartition(max(1, len(ring)))
        parts = parts.selectExpr(*[f"{v} as {k}" for k, v in PART_RECORDS.items()], "p_partkey")
        write_vlrs(parts.withColumn("path", F.element_at(names, (F.pmod("p_partkey", F.lit(len(ring))) + 1).cast("int"))))

    return once(spark, sf_dir, "recorded", write)


def packed_lineitem(spark: SparkSession, sf_dir: str) -> str:
    """A parquet table with one packed point record per lineitem row."""
    points = lineitem_points(spark, sf_dir, 1, "l_orderkey")
    packed = encode_points(points, 1, keep=["l_orderkey"])
    return once(spark, sf_dir, "packed", lambda path: packed.write.parquet(path))
