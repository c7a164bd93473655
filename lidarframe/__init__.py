"""Lidar point clouds in LAS files as Spark tables."""

from lidarframe.functions.fields import format_schema, point_schema
from lidarframe.functions.records import decode_points, encode_points
from lidarframe.operators.aggregate import las_agg
from lidarframe.operators.audit import las_audit
from lidarframe.operators.header_index import header_index, refresh_header_index
from lidarframe.operators.listing import list_las, read_listed
from lidarframe.operators.session import register
from lidarframe.operators.tables import las_view, publish_las, read_headers, read_las, write_las
from lidarframe.operators.vlrs import read_vlrs, write_vlrs
from lidarframe.operators.waveforms import amplitudes, read_descriptors, read_waveforms
from lidarframe.streaming.files import stream_las

__all__ = [
    "amplitudes",
    "decode_points",
    "encode_points",
    "format_schema",
    "header_index",
    "las_agg",
    "las_audit",
    "las_view",
    "point_schema",
    "list_las",
    "publish_las",
    "read_descriptors",
    "read_headers",
    "read_las",
    "read_listed",
    "read_vlrs",
    "read_waveforms",
    "refresh_header_index",
    "register",
    "stream_las",
    "write_las",
    "write_vlrs",
]
