import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # workers inherit this folder; they must not find the package by chance
    os.chdir(tmp_path_factory.mktemp("cwd"))
    session = (
        SparkSession.builder.master("local[8,2]")  # a task may fail once
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")

    from lidarframe import register

    register(session)
    yield session
    session.stop()
