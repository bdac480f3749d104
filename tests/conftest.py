from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

TOP = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (TOP, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    builder = SparkSession.builder.master("local[4]")
    for k, v in conf.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
