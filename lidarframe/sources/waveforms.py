"""Waveform packets of points: ranged reads in the order of the file, and their record behind the points."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lidarframe.sources.files import FileEntry, filesystem
from lidarframe.sources.layouts import Header, LasFormatError
from lidarframe.sources.vlrs import EXTENDED, PLAIN, Vlr

WAVE_FIELDS = ("wave_packet_descriptor_index", "byte_offset_to_waveform_data", "waveform_packet_size_in_bytes")
GAP = 64 << 10  # bytes between packets that are read along rather than asked for anew
MOST = 8 << 20  # bytes of a read, unless one packet is larger
BATCH_BYTES = 16 << 20  # packets of a batch
# Fixed values (ASPRS LAS 1.3): bits of a sample, compression, samples, picoseconds between them, gain, offset.
DESCRIPTOR = struct.Struct("<BBIIdd")
SPEC, FIRST_DESCRIPTOR, PACKETS = b"LASF_Spec".ljust(16, b"\0"), 99, 65535


class Packets:
    """Packets of one file, opened at the first that is asked for."""

    def __init__(self, file: FileEntry, header: Header):
        self.file, self.header, self.stream, self.reads = file, header, None, 0

    def _open(self):
        fs, _ = filesystem(self.file.root)
        path, self.begin = self.file.path, self.header.waveform_offset
        if self.header.waveforms_outside:
            path, self.begin = path.rpartition(".")[0] + ".wdp", 0
        elif not self.begin:
            raise LasFormatError(f"{self.file.name}: points name waveforms, but the file has none")
        self.stream = fs.open_input_file(path)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()

    def fetch(self, offsets: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The packets at ``offsets``, read from front to back; neighbours share a read."""
        out: list[bytes] = [b""] * len(offsets)
        order = np.argsort(offsets, kind="stable")
        if order.size and self.stream is None:
            self._open()
        k = 0
        while k < len(order):
            first, start = k, int(offsets[order[k]])
            end = start + int(sizes[order[k]])
            k += 1
            while k < len(order):
                at = int(offsets[order[k]])
                stop = max(end, at + int(sizes[order[k]]))
                if at > end + GAP or stop - start > MOST:
                    break
                end, k = stop, k + 1
            self.stream.seek(self.begin + start)
            data = self.stream.read(end - start)
            self.reads += 1
            if len(data) < end - start:
                raise LasFormatError(f"{self.file.name}: waveform packets end behind the end of the file")
            for n in order[first:k]:
                at = int(offsets[n]) - start
                out[n] = data[at : at + int(sizes[n])]
        return out

    def column(self, records: np.ndarray, kind: pa.DataType) -> pa.Array:
        """Packets of points; null for points without one."""
        index, offset, size = (records[name].astype(np.int64) for name in WAVE_FIELDS)
        some = np.flatnonzero(index & 255)
        found: list[bytes | None] = [None] * len(records)
        for k, data in zip(some.tolist(), self.fetch(offset[some], size[some] & 0xFFFFFFFF)):
            found[k] = data
        return pa.array(found, pa.binary()).cast(kind)


def slices(records: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of decoded points with packets of about BATCH_BYTES."""
    sizes = np.where(records[WAVE_FIELDS[0]].astype(np.int64) & 255, records[WAVE_FIELDS[2]].astype(np.int64) & 0xFFFFFFFF, 0)
    part = np.cumsum(sizes) // BATCH_BYTES
    cuts = np.flatnonzero(np.diff(part)) + 1
    yield from np.split(records, cuts)


def descriptors(text: str | None) -> list[Vlr]:
    """Records of the write option ``waveDescriptors``: JSON {index: [bits, samples, picoseconds, gain, offset]}."""
    found = []
    for index, (bits, samples, spacing, gain, offset) in sorted(json.loads(text or "{}").items(), key=lambda p: int(p[0])):
        if not 1 <= int(index) <= 255:
            raise ValueError(f"waveform descriptor {index} is not between 1 and 255")
        data = DESCRIPTOR.pack(bits, 0, samples, spacing, gain, offset)
        found.append(Vlr(False, SPEC, FIRST_DESCRIPTOR + int(index), b"Waveform descriptor".ljust(32, b"\0"), len(data), data))
    return found


def packets_head(length: int) -> bytes:
    """Head of the record that holds the packets of a file."""
    return EXTENDED.pack(0, SPEC, PACKETS, length, b"Waveform packets".ljust(32, b"\0"))


HEAD_BYTES = EXTENDED.size
PLAIN_BYTES = PLAIN.size
