"""Toy records of one row group are made by many tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from decisionframe import catalog


def test_toy_sources_are_spread(spark):
    rows = catalog.QUERIES["toy_sources"](spark, "/root/testdata/sf0.001")
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 8
