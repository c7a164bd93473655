"""The ``las_vlrs`` source: variable-length records of files, and their way into files.

Plain records lie between header and points, extended ones (LAS 1.4, more than 64 KiB each) behind the points. Each
begins with a small head that gives its length, so they are walked one by one.
"""

from __future__ import annotations

import hashlib
import shutil
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from tempfile import SpooledTemporaryFile

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.pandas.types import to_arrow_schema

from lidarframe.sources.files import DEFAULT_SPLIT_BYTES, FileEntry, FilePartition, chunk_files, filesystem, flag, list_files
from lidarframe.sources.layouts import HEADER_DTYPES, MAX_HEADER_BYTES, LasFormatError, parse_header

VLR_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("extended", T.BooleanType(), False),
        T.StructField("place", T.IntegerType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("record_id", T.IntegerType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("data", T.BinaryType()),
    ]
)
# Fixed values (ASPRS LAS 1.4): reserved, user id, record id, length, description.
PLAIN, EXTENDED = struct.Struct("<H16sHH32s"), struct.Struct("<H16sHQ32s")
MOST_PLAIN = 0xFFFF
BATCH_BYTES = 4 << 20
COPY_BYTES = 8 << 20


@dataclass(frozen=True)
class Vlr:
    extended: bool
    user_id: bytes
    record_id: int
    description: bytes
    length: int
    data: bytes | None

    def packed(self) -> bytes:
        head = EXTENDED if self.extended else PLAIN
        return head.pack(0, self.user_id, self.record_id, len(self.data), self.description) + self.data

    def key(self, data: Iterable[bytes]) -> bytes:
        """The same for records that are equal in all parts; ``data`` come in blocks."""
        found = hashlib.sha256(EXTENDED.pack(self.extended, self.user_id, self.record_id, self.length, self.description))
        for block in data:
            found.update(block)
        return found.digest()


def _text(raw: bytes) -> str:
    return raw.split(b"\0")[0].decode("utf-8", "replace")


def _fixed(header: bytes, minor: int, name: str) -> int:
    kind = HEADER_DTYPES[minor]
    return int(np.frombuffer(header, kind, 1)[0][name]) if name in kind.names else 0


def places(stream, name: str, size: int) -> Iterator[tuple[Vlr, int]]:
    """The records of an open file in file order, without their data, and where these begin."""
    stream.seek(0)
    head = stream.read(min(MAX_HEADER_BYTES, size))
    header = parse_header(head, name)
    minor = int(header.version[2:])
    chains = [(False, PLAIN, header.header_size, header.n_vlr, header.point_offset)]
    if minor >= 4 and header.header_size >= MAX_HEADER_BYTES:
        chains.append((True, EXTENDED, _fixed(head, 4, "evlr_offset"), _fixed(head, 4, "n_evlr"), size))
    for extended, kind, at, count, end in chains:
        for place in range(count):
            stream.seek(at)
            raw = stream.read(kind.size) if at + kind.size <= end else b""
            if len(raw) < kind.size:
                raise LasFormatError(f"{name}: record {place} of {count} begins behind byte {end}")
            _, user, record, length, text = kind.unpack(raw)
            if at + kind.size + length > end:
                raise LasFormatError(f"{name}: record {place} of {count} ends behind byte {end}")
            yield Vlr(extended, user, record, text, length, None), at + kind.size
            at += kind.size + length


def blocks(stream, name: str, at: int, length: int) -> Iterator[bytes]:
    """``length`` bytes of an open file in blocks of bounded size."""
    stream.seek(at)
    while length:
        block = stream.read(min(COPY_BYTES, length))
        if not block:
            raise LasFormatError(f"{name}: file ends {length} bytes early")
        yield block
        length -= len(block)


class VlrSource(DataSource):
    """One row per record; without ``data`` in the schema contents are passed over."""

    @classmethod
    def name(cls) -> str:
        return "las_vlrs"

    def schema(self) -> T.StructType:
        return VLR_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return VlrReader(self.options, schema)


class VlrReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.options = options
        self.schema = to_arrow_schema(schema)
        self.with_data = "data" in self.schema.names
        self.extended_data = flag(options, "extendedData", True)

    def partitions(self) -> list[FilePartition]:
        return chunk_files(list_files(self.options), self.options, DEFAULT_SPLIT_BYTES if self.with_data else None)

    def read(self, partition: FilePartition | None) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for file in partition.files if partition else []:
            for row in self._rows(file):
                rows.append(row)
                size += len(row.get("data") or b"") + 100
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=self.schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=self.schema)

    def _rows(self, file: FileEntry) -> Iterator[dict]:
        fs, _ = filesystem(file.root)
        with fs.open_input_file(file.path) as stream:
            place = {False: 0, True: 0}
            for vlr, at in places(stream, file.name, file.size):
                data = None
                if self.with_data and (self.extended_data or not vlr.extended):
                    stream.seek(at)
                    data = stream.read(vlr.length)
                row = {"path": file.name, "extended": vlr.extended, "place": place[vlr.extended], "data": data}
                place[vlr.extended] += 1
                yield {**row, "user_id": _text(vlr.user_id), "record_id": vlr.record_id, "description": _text(vlr.description), "length": vlr.length}


def put_records(path: str, records: Iterable[Vlr], replace: bool) -> int:
    """Writes a file anew with more records, and moves it over the old one; returns how many were new.

    Records that the file has already, equal in all parts, are not added again, so this may be repeated. They are
    taken one by one: the header counts them all but comes first, so new ones wait in temporary files beyond
    COPY_BYTES; a digest of each record is all that is held.
    """
    fs, inner = filesystem(path)
    size = fs.get_file_info(inner).size
    with (
        fs.open_input_file(inner) as source,
        SpooledTemporaryFile(COPY_BYTES) as new_plain,
        SpooledTemporaryFile(COPY_BYTES) as new_extended,
    ):
        head = bytearray(source.read(min(MAX_HEADER_BYTES, size)))
        header = parse_header(bytes(head), path)
        minor = int(header.version[2:])
        head = head[: header.header_size]
        seen: set[bytes] = set()
        old, kept, kept_bytes = 0, {False: 0, True: 0}, {False: 0, True: 0}
        for vlr, at in places(source, path, size):
            old += 1
            if not replace:
                seen.add(vlr.key(blocks(source, path, at, vlr.length)))
                kept[vlr.extended] += 1
                kept_bytes[vlr.extended] += (EXTENDED if vlr.extended else PLAIN).size + vlr.length
        new = {False: 0, True: 0}
        for vlr in records:
            key = vlr.key([vlr.data])
            if key not in seen:
                seen.add(key)
                (new_extended if vlr.extended else new_plain).write(vlr.packed())
                new[vlr.extended] += 1
        if not any(new.values()) and not (replace and old):
            return 0
        n_plain, n_extended = (kept[k] + new[k] for k in (False, True))
        if n_extended and (minor < 4 or header.header_size < MAX_HEADER_BYTES):
            raise LasFormatError(f"{path}: records of more than {MOST_PLAIN} bytes need LAS 1.4")
        # what lies behind the points and is no extended record (waveforms, say) stays behind them
        behind = _fixed(bytes(head), 4, "evlr_offset") if minor >= 4 and _fixed(bytes(head), 4, "n_evlr") else size
        offset = header.header_size + kept_bytes[False] + new_plain.tell()
        moved = offset - header.point_offset
        fields = np.frombuffer(head, HEADER_DTYPES[minor], 1)
        fields["point_offset"], fields["n_vlr"] = offset, n_plain
        if minor >= 3 and fields["waveform_offset"][0]:
            fields["waveform_offset"] += moved
        if minor >= 4:
            fields["n_evlr"] = n_extended
            fields["evlr_offset"] = behind + moved if n_extended else 0
        folder, _, name = inner.rpartition("/")
        draft = f"{folder}/_{name}.{uuid.uuid4().hex}"

        def copy(at: int, length: int, more=None) -> None:
            for block in blocks(source, path, at, length):
                out.write(block)
            if more is not None:
                more.seek(0)
                shutil.copyfileobj(more, out, COPY_BYTES)

        with fs.open_output_stream(draft) as out:
            out.write(bytes(head))
            copy(header.header_size, kept_bytes[False], new_plain)
            copy(header.point_offset, behind - header.point_offset)
            copy(behind, kept_bytes[True], new_extended)
    fs.move(draft, inner)
    return sum(new.values())
