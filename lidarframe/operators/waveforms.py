"""Points with their waveforms."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe.operators.tables import Paths, read_las
from lidarframe.operators.vlrs import read_vlrs
from lidarframe.sources.layouts import PATH_COLUMN, WAVE_COLUMN
from lidarframe.sources.waveforms import DESCRIPTOR, FIRST_DESCRIPTOR, WAVE_FIELDS

_INDEX = WAVE_FIELDS[0]


def read_descriptors(spark: SparkSession, path: Paths, **options) -> DataFrame:
    """(_path, wave_packet_descriptor_index, bits, compression, samples, picoseconds, gain, offset) of each file's descriptors."""

    layout = DESCRIPTOR.format

    def unpack(data: pd.Series) -> pd.DataFrame:
        names = ["bits", "compression", "samples", "picoseconds", "gain", "offset"]
        return pd.DataFrame([struct.unpack_from(layout, bytes(d)) for d in data], columns=names)

    fields = F.pandas_udf(unpack, "bits int, compression int, samples long, picoseconds long, gain double, offset double")
    number = F.col("record_id") - FIRST_DESCRIPTOR
    # packets are an extended record of their own: as large as all of a file's waveforms
    found = read_vlrs(spark, path, extendedData=False, **options).where("not extended and user_id = 'LASF_Spec'").where(number.between(1, 255))
    found = found.where(F.length("data") >= DESCRIPTOR.size)
    return found.select(F.col("path").alias(PATH_COLUMN), number.alias(_INDEX), fields("data").alias("d")).select(
        PATH_COLUMN, _INDEX, "d.*"
    )


def read_waveforms(
    spark: SparkSession, path: Paths, columns: Sequence[str] = ("x", "y", "z"), where: str | None = None, **options
) -> DataFrame:
    """``columns`` of the points, their waveform packets (``_waveform``, null for points without) and what their
    descriptors say; null where a file does not describe a packet. A task reads the packets of its points in
    file order, neighbours in one read; points that ``filters`` drop cost none.
    """
    needed = list(dict.fromkeys([*columns, _INDEX, PATH_COLUMN, WAVE_COLUMN]))
    points = read_las(spark, path, needed, where=where, **options)
    keys = [PATH_COLUMN, _INDEX]
    # at most 255 small rows a file; Spark broadcasts them if they are few
    found = points.withColumn(_INDEX, F.col(_INDEX).cast("int").bitwiseAND(F.lit(255))).join(read_descriptors(spark, path), keys, "left")
    return found if PATH_COLUMN in columns else found.drop(PATH_COLUMN)


def amplitudes(waveform: str, bits: str = "bits", gain: str = "gain", offset: str = "offset") -> Column:
    """Samples of uncompressed packets as array<double>: gain * raw + offset, for 8, 16 or 32 bits."""

    def decode(data: pd.Series, width: pd.Series, factor: pd.Series, shift: pd.Series) -> pd.Series:
        out = []
        for d, w, f, s in zip(data, width, factor, shift):
            if d is None or w not in (8, 16, 32):
                out.append(None)
                continue
            size = int(w) // 8
            raw = np.frombuffer(bytes(d)[: len(d) // size * size], f"<u{size}")
            out.append((raw * f + s).tolist())
        return pd.Series(out)

    return F.pandas_udf(decode, "array<double>")(waveform, bits, gain, offset)
