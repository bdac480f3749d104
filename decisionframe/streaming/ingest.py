"""A stream of outcome rows: deduplicated by job, appended, counted, and closed by shard."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, key: str = "jid", retry: str | None = None, files: int = 100, watermark: tuple[str, str] | None = None) -> StreamingQuery:
    """Append the files that arrive in source to sink, each key once over all runs; rows whose status is 'error' go to retry and
    stay unseen, so they may come again; rows without a status are good. With a watermark (column, delay) the keys that are kept are bounded by it."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(source)
    good = rows.where("not (status <=> 'error')")
    if watermark:
        good = good.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    else:
        good = good.dropDuplicates([key])
    if retry:
        bad = rows.where("status = 'error'").writeStream.format("json").option("path", retry).option("checkpointLocation", os.path.join(checkpoint, "retry")).trigger(availableNow=True).start()
        bad.awaitTermination()
    return good.writeStream.format("parquet").option("path", sink).option("checkpointLocation", os.path.join(checkpoint, "main")).trigger(availableNow=True).start()


def counters(outcomes: DataFrame) -> DataFrame:
    """By type and reason: rows; what a running job shows."""
    return outcomes.groupBy("type", "status", "reason").agg(F.count("*").alias("n"))


def enough(accepted: int, tried: int, in_flight: int, target: int, first_rate: float = 0.5, least: int = 20) -> bool:
    """Would what is under way suffice? The acceptance rate is assumed until enough has been tried."""
    rate = accepted / tried if tried >= least else first_rate
    return accepted + rate * in_flight >= target


def missing_jobs(jobs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The jobs of open shards that have no outcome yet."""
    return jobs.join(outcomes.select("jid"), "jid", "left_anti")


def closable_shards(jobs: DataFrame, outcomes: DataFrame, missing: float = 0.03) -> DataFrame:
    """Shards with at most a share `missing` of their jobs without an outcome."""
    done = jobs.join(outcomes.select("jid", F.lit(1).alias("_done")), "jid", "left")
    return done.groupBy("shard").agg(F.count("*").alias("jobs"), F.count("_done").alias("done")).where(F.col("jobs") - F.col("done") <= F.col("jobs") * missing)


def windowed(events: DataFrame, ts: str, size: str, by: str, delay: str | None = None) -> DataFrame:
    """An extension: counts and sums of value by tumbling window and a column, with a watermark on streams."""
    rows = events.withWatermark(ts, delay) if delay else events
    return rows.groupBy(F.window(ts, size).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")
