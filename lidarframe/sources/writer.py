"""The LAS sinks, for tables and streams: each task writes whole files, a journal commits them."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from lidarframe.sources.files import MIB, NULL_PARTITION, filesystem, flag, list_files
from lidarframe.sources.journal import Journal, make_folders, move, pending, read_journal, remove, side_by_side
from lidarframe.sources.layouts import (
    ATTRIBUTES,
    COORDINATES,
    HEADER_DTYPES,
    LEGACY_COUNT_LIMIT,
    POINT_FORMATS,
    WAVE_COLUMN,
    PointCodec,
    format_length,
    pack_header,
)
from lidarframe.sources.waveforms import HEAD_BYTES, WAVE_FIELDS, descriptors, packets_head

DEFAULT_SCALE = 0.01
DEFAULT_MAX_POINTS = 16_000_000
HELD_BYTES = 128 * MIB  # records a task holds; beyond, its largest open file is finished
OPEN_FILES = 16


def codec_from_options(options) -> PointCodec:
    """Point format, scale and offset as given by pointFormat, scale[X|Y|Z] and offset[X|Y|Z]."""
    point_format = int(options.get("pointFormat") or 0)
    if point_format not in POINT_FORMATS:
        raise ValueError(f"unknown point format {point_format}")

    def triple(name: str, default: float) -> tuple[float, float, float]:
        common = options.get(name)
        values = [options.get(name + axis) or common or default for axis in "XYZ"]
        return tuple(float(v) for v in values)

    scale, offset = triple("scale", DEFAULT_SCALE), triple("offset", 0.0)
    if not all(s > 0 and np.isfinite(s) for s in scale) or not np.isfinite(offset).all():
        raise ValueError(f"scale {scale} and offset {offset} must be finite, scale above zero")
    return PointCodec(
        point_format,
        format_length(point_format),
        scale,
        offset,
        flag(options, "unsigned"),
        flag(options, "strict"),
    )


def minor_version(options, point_format: int) -> int:
    least = 4 if point_format >= 6 else 3 if point_format >= 4 else 2 if point_format >= 2 else 0
    if not options.get("version"):
        return max(least, 2)
    major, _, minor = str(options["version"]).partition(".")
    if major != "1" or not minor.isdigit() or int(minor) not in HEADER_DTYPES:
        raise ValueError(f"LAS version {options['version']} is not supported")
    if int(minor) < least:
        raise ValueError(f"point format {point_format} needs LAS 1.{least} or later")
    return int(minor)


@dataclass
class WrittenFiles(WriterCommitMessage):
    """(temporary path, path below the target) of the files of one task."""

    files: list[tuple[str, str]] = field(default_factory=list)


class LasWriter(DataSourceArrowWriter):
    def __init__(self, options, schema: T.StructType, overwrite: bool):
        self.options = options
        self.overwrite = overwrite
        self.codec = codec_from_options(options)
        self.minor = minor_version(options, self.codec.point_format)
        self.max_points = int(options.get("maxPointsPerFile") or DEFAULT_MAX_POINTS)
        if not 0 < self.max_points <= LEGACY_COUNT_LIMIT:
            raise ValueError(f"maxPointsPerFile must be between 1 and {LEGACY_COUNT_LIMIT}")
        self.target = options.get("path")
        if not self.target:
            raise ValueError("no path to write to: use save(path)")
        keys = options.get("partitionColumns") or ""
        self.keys = [k.strip() for k in keys.split(",") if k.strip()]
        names = schema.fieldNames()
        self.attributes = [n for n in names if n not in self.keys and n != WAVE_COLUMN]
        self.waves = WAVE_COLUMN in names
        self.descriptors = descriptors(options.get("waveDescriptors"))
        if self.waves and (not self.codec.has(WAVE_FIELDS[0]) or self.codec.unsigned):
            raise ValueError("waveforms need point format 4, 5, 9 or 10, without the option unsigned")
        if self.waves and {*WAVE_FIELDS[1:]} & {*names}:
            raise ValueError(f"places of waveforms follow from {WAVE_COLUMN}: leave out {WAVE_FIELDS[1]} and {WAVE_FIELDS[2]}")
        for name in self.keys:
            if name not in names or name in ATTRIBUTES:
                raise ValueError(f"partition column {name!r} must be a column that is no point attribute")
        for name in COORDINATES:
            if name not in names:
                raise ValueError(f"column {name!r} is required to write points")
        for name in self.attributes:
            if not self.codec.has(name):
                raise ValueError(
                    f"column {name!r} is not part of point format {self.codec.point_format}"
                )
        self.job = uuid.uuid4().hex
        now = datetime.now(timezone.utc)
        self.created = (now.year, now.timetuple().tm_yday)

    def _staging(self, inner: str) -> str:
        return f"{inner.rstrip('/')}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        fs, inner = filesystem(self.target)
        staging = self._staging(inner)
        fs.create_dir(staging, recursive=True)
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        written = WrittenFiles()
        open_files: dict[str, _PointFile] = {}  # folder -> file, oldest first

        def close(folder: str) -> None:
            name = f"part-{task:05d}-{uuid.uuid4().hex}.las"
            open_files.pop(folder).finish(fs, f"{staging}/{name}")
            written.files.append((f"{staging}/{name}", f"{folder}{name}"))

        for batch in iterator:
            for folder, part in self._by_folder(batch):
                columns = {n: part.column(n) for n in self.attributes}
                records = self.codec.encode(columns, part.num_rows)
                packets = part.column(WAVE_COLUMN).to_pylist() if self.waves else None
                while len(records):
                    if folder not in open_files:
                        if len(open_files) >= OPEN_FILES:
                            close(next(iter(open_files)))
                        open_files[folder] = _PointFile(self)
                    room = self.max_points - open_files[folder].count
                    open_files[folder].append(records[:room], packets and packets[:room])
                    records, packets = records[room:], packets and packets[room:]
                    if open_files[folder].count >= self.max_points:
                        close(folder)
                if sum(f.size for f in open_files.values()) >= HELD_BYTES:
                    close(max(open_files, key=lambda f: open_files[f].size))
        for folder in list(open_files):
            close(folder)
        return written

    def _by_folder(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        if not self.keys:
            yield "", batch
            return
        keyed = pa.table([batch.column(k) for k in self.keys], names=self.keys)
        keyed = keyed.append_column("=row", pa.array(np.arange(batch.num_rows)))
        groups = keyed.group_by(self.keys).aggregate([("=row", "list")]).combine_chunks()
        for group in range(groups.num_rows):
            folder = "".join(f"{k}={_folder_text(groups[k][group].as_py())}/" for k in self.keys)
            yield folder, batch.take(groups["=row_list"][group].values)

    def commit(self, messages: list) -> None:
        """One journal commits all files. With the option ``publish=later`` nothing else is done here."""
        fs, inner = filesystem(self.target)
        base = inner.rstrip("/")
        fs.create_dir(base, recursive=True)
        for journal in pending(fs, base) if self.overwrite else []:
            publish(fs, journal)  # what it would replace must be in place
        old = [f.path[len(base) + 1 :] for f in list_files({"path": self.target})] if self.overwrite else []
        files = [(source[len(base) + 1 :], name) for m in messages if m is not None for source, name in m.files]
        journal = Journal(base, self.job, files, old)
        if not flag(self.options, "publishLater"):
            make_folders(fs, base, files)
            try:  # first the moves, which can be taken back; nothing is replaced before the journal is there
                side_by_side(lambda pair: fs.move(f"{base}/{pair[0]}", f"{base}/{pair[1]}"), files)
            except BaseException:
                self._take_back(fs, [f"{base}/{name}" for _, name in files])
                raise
            files.clear()
        if files or old:
            journal.write(fs)
            if flag(self.options, "publishLater"):
                return
        publish(fs, journal)

    def abort(self, messages: list) -> None:
        fs, inner = filesystem(self.target)
        journal = Journal(inner.rstrip("/"), self.job)
        if read_journal(fs, journal.base, self.job) is None:  # else the job is committed
            journal.drop(fs)

    @staticmethod
    def _take_back(fs: pafs.FileSystem, paths: list[str]) -> None:
        """Removes those of a failed commit's files that are in place; their names are its own."""
        found = fs.get_file_info(paths)
        side_by_side(fs.delete_file, [i.path for i in found if i.type == pafs.FileType.File])


def publish(fs: pafs.FileSystem, journal: Journal) -> None:
    """Does what a journal says, or what is left of it, and marks the folder as complete."""
    make_folders(fs, journal.base, journal.moves)
    side_by_side(lambda pair: move(fs, journal.base, pair), journal.moves)
    side_by_side(lambda name: remove(fs, journal.base, name), journal.gone)
    finish(fs, journal)


def finish(fs: pafs.FileSystem, journal: Journal) -> None:
    with fs.open_output_stream(f"{journal.base}/_SUCCESS"):
        pass
    journal.drop(fs, *{source.split("/")[1] for source, _ in journal.moves})


class LasStreamWriter(LasWriter, DataSourceStreamArrowWriter):
    """``writeStream.format("las")``: each batch is committed once, however often it is run.

    The journal of a batch is named by the query and the batch. A batch that is run again finds the journal of
    the first run, or the number of the last published batch, and drops what it has written itself. The query is named by
    the option ``sinkId``, else by its checkpoint folder.
    """

    def __init__(self, options, schema: T.StructType, overwrite: bool):
        super().__init__(options, schema, False)
        if overwrite:
            raise ValueError("a stream of points can only be appended")
        name = options.get("sinkId") or options.get("checkpointLocation")
        if not name:
            raise ValueError("set checkpointLocation or sinkId, so that a repeated batch can be told")
        self.sink = hashlib.sha1(name.rstrip("/").encode()).hexdigest()[:16]

    def _last(self, fs: pafs.FileSystem, base: str) -> int:
        try:
            with fs.open_input_file(f"{base}/_batches/{self.sink}") as stream:
                return int(stream.read())
        except FileNotFoundError:
            return -1

    def commit(self, messages: list, batchId: int) -> None:
        fs, inner = filesystem(self.target)
        base = inner.rstrip("/")
        fs.create_dir(base, recursive=True)
        own = [pair for m in messages if m is not None for pair in m.files]
        name = f"{self.sink}-{batchId}"
        journal = Journal(base, name, [(source[len(base) + 1 :], to) for source, to in own])
        first = read_journal(fs, base, name)
        if batchId > self._last(fs, base):
            if first is None and own:
                journal.write(fs)
            done = first or journal
            make_folders(fs, base, done.moves)
            side_by_side(lambda pair: move(fs, base, pair), done.moves)
            fs.create_dir(f"{base}/_batches", recursive=True)
            with fs.open_output_stream(f"{base}/_batches/{self.sink}-draft") as out:
                out.write(str(batchId).encode())
            fs.move(f"{base}/_batches/{self.sink}-draft", f"{base}/_batches/{self.sink}")
            finish(fs, done)
        elif first is not None:
            finish(fs, first)
        journal.drop(fs, *{source.split("/")[1] for source, _ in journal.moves})

    def abort(self, messages: list, batchId: int) -> None:
        fs, inner = filesystem(self.target)
        for job in {s.split("/")[-2] for m in messages if m is not None for s, _ in m.files} | {self.job}:
            Journal(inner.rstrip("/"), job).drop(fs)


def _folder_text(value) -> str:
    if value is None:
        return NULL_PARTITION
    return quote(str(value).lower() if isinstance(value, bool) else str(value), safe=" ")


class _PointFile:
    """Records of one file, held in memory until it is finished.

    The header comes first in a LAS file but holds count and bounds, and object stores cannot
    patch; so the records wait here until both are known.
    """

    def __init__(self, writer: LasWriter):
        self.writer = writer
        self.chunks: list[np.ndarray] = []
        self.count = 0
        self.size = 0
        self.by_return = np.zeros(16, np.int64)
        self.packets: list[bytes] = []
        self.packet_bytes = 0
        self.low: dict[str, int] = {}
        self.high: dict[str, int] = {}

    def append(self, records: np.ndarray, packets: list[bytes | None] | None = None) -> None:
        if not len(records):
            return
        if packets:
            self._place(records, packets)
        self.chunks.append(records)
        self.count += len(records)
        self.size += records.nbytes
        for c in COORDINATES:
            self.low[c] = min(self.low.get(c, 2**31), int(records[c].min()))
            self.high[c] = max(self.high.get(c, -(2**31)), int(records[c].max()))
        extended = "r_n_c_s_s_e" in records.dtype.names
        packed = records["r_n_c_s_s_e"] & 15 if extended else records["r_n_s_e"] & 7
        self.by_return += np.bincount(packed.astype(np.int64), minlength=16)

    def _place(self, records: np.ndarray, packets: list[bytes | None]) -> None:
        """Writes down where each point's packet will lie; a point without one has descriptor 0."""
        sizes = np.array([len(p) if p is not None else 0 for p in packets], np.int64)
        some = np.array([p is not None for p in packets])
        index = records[WAVE_FIELDS[0]]
        if WAVE_FIELDS[0] not in self.writer.attributes:
            index[:] = 1
        elif (some & (index == 0)).any():
            raise ValueError("a point with a waveform needs a descriptor from 1 on")
        index[~some] = 0
        places = HEAD_BYTES + self.packet_bytes + np.cumsum(sizes) - sizes
        records[WAVE_FIELDS[1]] = np.where(some, places, 0)
        records[WAVE_FIELDS[2]] = sizes.astype(np.uint32).astype(np.int32)
        self.packets += [p for p in packets if p]
        self.packet_bytes += int(sizes.sum())
        self.size += int(sizes.sum())

    def finish(self, fs: pafs.FileSystem, path: str) -> None:
        codec = self.writer.codec
        # the same arithmetic as the scan, so header bounds equal scanned bounds bit for bit
        minimum, maximum = (
            [raw[c] * codec.scale[i] + codec.offset[i] for i, c in enumerate(COORDINATES)]
            for raw in (self.low, self.high)
        )
        vlrs = [v.packed() for v in self.writer.descriptors]
        size = sum(map(len, vlrs))
        head = pack_header(
            self.writer.minor, codec, self.count, self.by_return, minimum, maximum, self.writer.created, len(vlrs), size, self.writer.waves
        )
        with fs.open_output_stream(path) as out:
            out.write(head)
            for record in vlrs:
                out.write(record)
            for records in self.chunks:
                out.write(records.tobytes())
            if self.writer.waves:
                out.write(packets_head(self.packet_bytes))
                for packet in self.packets:
                    out.write(packet)
