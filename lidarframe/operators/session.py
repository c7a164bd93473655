"""Registration of the LAS sources with a Spark session."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import zipfile
from pathlib import Path
from weakref import WeakSet

from pyspark import SparkContext
from pyspark.sql import SparkSession

from lidarframe.sources.headers import LasFileSource, LasHeaderSource, LasRangeStatsSource
from lidarframe.sources.points import LasDataSource
from lidarframe.sources.publication import LasPublishSource
from lidarframe.sources.vlrs import VlrSource

_registered: WeakSet[SparkSession] = WeakSet()


def register(spark: SparkSession) -> None:
    """Make ``las`` and the other sources (``las_files``, ``las_headers``, ...) known; safe to call again.

    Ships this package to the Python workers, which run the sources.
    """
    if spark in _registered:
        return
    _ship_package(spark)
    for source in (LasDataSource, LasFileSource, LasHeaderSource, LasRangeStatsSource, LasPublishSource, VlrSource):
        spark.dataSource.register(source)
    _registered.add(spark)


def _ship_package(spark: SparkSession) -> None:
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if not root.is_dir():  # imported from an archive, which executors were given already
        _add_to_worker_path(context, str(root.parent))
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            info = zipfile.ZipInfo(str(path.relative_to(root.parent)))
            archive.writestr(info, path.read_bytes())
    name = f"{root.name}-{hashlib.sha1(data.getvalue()).hexdigest()[:12]}.zip"
    if any(os.path.basename(f) == name for f in context.listFiles):
        return
    file = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / name
    file.write_bytes(data.getvalue())
    context.addPyFile(str(file))
    _add_to_worker_path(context, str(file))


def _add_to_worker_path(context: SparkContext, location: str) -> None:
    """For the worker that plans stream sources beside the driver; it does not see added files."""
    known = context.environment.get("PYTHONPATH", "")
    context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, location]))
