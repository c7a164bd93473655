"""LAS files packed with struct, field by field, independent of the library's layouts."""

import struct

# struct codes of the records by point format, and a record of distinct values for each
CORE = "<iiiHBBbBH"
EXTENDED = "<iiiHHBBhHd"
RGB, NIR, WAVE = "HHH", "H", "BQIffff"
CODES = {
    0: CORE,
    1: CORE + "d",
    2: CORE + RGB,
    3: CORE + "d" + RGB,
    4: CORE + "d" + WAVE,
    5: CORE + "d" + RGB + WAVE,
    6: EXTENDED,
    7: EXTENDED + RGB,
    8: EXTENDED + RGB + NIR,
    9: EXTENDED + WAVE,
    10: EXTENDED + RGB + NIR + WAVE,
}
LENGTHS = {0: 20, 1: 28, 2: 26, 3: 34, 4: 57, 5: 63, 6: 30, 7: 36, 8: 38, 9: 59, 10: 67}
CORE_VALUES = {
    "x": 101, "y": -202, "z": 303, "intensity": 404, "r_n_s_e": 17, "classification": 6,
    "scan_angle_rank_left_side": -7, "user_data": 8, "point_source_id": 909,
}
EXTENDED_VALUES = {
    "x": 101, "y": -202, "z": 303, "intensity": 404, "r_n_c_s_s_e": 1717, "classification": 6,
    "user_data": 8, "scan_angle": -700, "point_source_id": 909, "gps_time": 1234.5,
}
GPS_VALUES = {"gps_time": 1234.5}
RGB_VALUES = {"r": 11, "g": 12, "b": 13}
NIR_VALUES = {"nir": 14}
WAVE_VALUES = {
    "wave_packet_descriptor_index": 21, "byte_offset_to_waveform_data": 2**40 + 3,
    "waveform_packet_size_in_bytes": 2222, "return_point_waveform_location": 1.5,
    "parametric_dx": 2.5, "parametric_dy": -3.5, "parametric_dz": 4.5,
}
VALUES = {
    0: CORE_VALUES,
    1: CORE_VALUES | GPS_VALUES,
    2: CORE_VALUES | RGB_VALUES,
    3: CORE_VALUES | GPS_VALUES | RGB_VALUES,
    4: CORE_VALUES | GPS_VALUES | WAVE_VALUES,
    5: CORE_VALUES | GPS_VALUES | RGB_VALUES | WAVE_VALUES,
    6: EXTENDED_VALUES,
    7: EXTENDED_VALUES | RGB_VALUES,
    8: EXTENDED_VALUES | RGB_VALUES | NIR_VALUES,
    9: EXTENDED_VALUES | WAVE_VALUES,
    10: EXTENDED_VALUES | RGB_VALUES | NIR_VALUES | WAVE_VALUES,
}


def record(fmt: int, **changed) -> bytes:
    return struct.pack(CODES[fmt], *(VALUES[fmt] | changed).values())


def header(
    minor=2, fmt=0, length=None, count=1, legacy=None, gap=0, scale=(0.01, 0.02, 0.5),
    offset=(0.0, 10.0, -1.0), bounds=(0.0,) * 6, magic=b"LASF", size=None,
) -> bytes:
    """bounds = max x, min x, max y, min y, max z, min z"""
    size = size or {3: 235, 4: 375}.get(minor, 227)
    legacy = count if legacy is None else legacy
    out = magic + bytes(20) + bytes([1, minor]) + bytes(64) + struct.pack("<HH", 1, 2020)
    out += struct.pack("<H", size) + struct.pack("<II", size + gap, 1 if gap else 0)
    out += struct.pack("<BH", fmt, length or LENGTHS.get(fmt & 63, 20))
    out += struct.pack("<I", legacy) + struct.pack("<5I", 1, 2, 3, 4, 5)
    out += struct.pack("<3d", *scale) + struct.pack("<3d", *offset) + struct.pack("<6d", *bounds)
    assert len(out) == 227
    if minor >= 3:
        out += struct.pack("<Q", 77)
    if minor >= 4:
        out += struct.pack("<QI", 88, 99) + struct.pack("<Q", count) + struct.pack("<15Q", *range(15))
    return out + bytes(size - len(out)) + b"\xaa" * gap


def points(n: int, fmt: int = 0, extra: int = 0, first: int = 0) -> bytes:
    return b"".join(record(fmt, x=first + i) + b"\xee" * extra for i in range(n))


def write(path, data: bytes) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return str(path)


def cloud(path, n, fmt=0, extra=0, gap=0, trailing=0, first=0, minor=None, lie=None, **head) -> str:
    """A valid file of n points with x = first, first + 1, ...; header bounds are right unless lied."""
    minor = minor if minor is not None else 4 if fmt >= 6 else 2
    scale, offset = head.get("scale", (0.01, 0.02, 0.5)), head.get("offset", (0.0, 10.0, -1.0))
    ends = [(first, first + n - 1), (-202, -202), (303, 303)] if n else [(0, 0)] * 3
    bounds = [e * s + o for (lo, hi), s, o in zip(ends, scale, offset) for e in (hi, lo)]
    head = header(
        minor, fmt, LENGTHS[fmt] + extra, n, 0 if fmt >= 6 else None, gap, bounds=lie or bounds, **head
    )
    return write(path, head + points(n, fmt, extra, first) + b"\xdd" * trailing)
