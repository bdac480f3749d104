"""A stream of jobs that is fed no more than its target needs.

The feeder releases shards of jobs to the folder that a running query reads. The query works on them in micro-batches and counts on
the way, by observe(); a StreamingQueryListener takes the counts as each batch ends. Shards are released until what was accepted, and
what is expected of the jobs that are under way, suffices (`enough`); then the feeder waits for news and looks again. So the query
stops being fed while its last jobs are still under way, and ends within the jobs that the estimate asked for. Each batch leaves a row
of progress, in a table that can be read while the query runs.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from .ingest import enough

PROGRESS = "batch long, at double, accepted long, tried long, in_flight long, rate double"


class _Counts(StreamingQueryListener):
    """What a query's batches have counted so far."""

    def __init__(self, name: str) -> None:
        self.name, self.rows, self.news = name, {}, threading.Condition()
        self.failed: str | None = None

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.name != self.name or (seen := p.observedMetrics.get("outcomes")) is None:
            return
        with self.news:
            self.rows[p.batchId] = (time.time(), seen["accepted"] or 0, seen["tried"] or 0)
            self.news.notify_all()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def totals(self) -> tuple[int, int]:
        return sum(a for _, a, _ in self.rows.values()), sum(t for _, _, t in self.rows.values())


class Feeder:
    """jobs (shard and others) are worked on by `work`, which adds status; 'accepted' counts towards the target. Shards go in order.
    With lockstep what is under way is waited for before more is released; without, news of any batch will do."""

    def __init__(self, jobs: DataFrame, work: Callable[[DataFrame], DataFrame], target: int, folder: str, first_rate: float = 0.5, least: int = 20, lockstep: bool = False) -> None:
        self.jobs, self.work, self.target, self.folder = jobs, work, target, folder.rstrip("/")
        self.first_rate, self.least, self.lockstep = first_rate, least, lockstep

    def run(self, patience: float = 600) -> list[int]:
        """The shards that were released. Outcomes are in out/, progress in progress/."""
        spark = self.jobs.sparkSession
        sizes = {r["shard"]: r["count"] for r in self.jobs.groupBy("shard").count().orderBy("shard").collect()}
        left, released, fed = list(sizes), [], 0
        self.jobs.limit(0).write.mode("overwrite").parquet(f"{self.folder}/fed")
        counts = _Counts(f"feeder-{self.folder}")
        spark.streams.addListener(counts)
        query = self._start(spark, counts.name)
        try:
            while True:
                accepted, tried = counts.totals()
                while left and not enough(accepted, tried, fed - tried, self.target, self.first_rate, self.least):
                    shard = left.pop(0)
                    self.jobs.where(F.col("shard") == shard).coalesce(1).write.mode("append").parquet(f"{self.folder}/fed")
                    released.append(shard)
                    fed += sizes[shard]
                if tried >= fed:
                    return released
                self._wait(query, counts, fed if self.lockstep else tried + 1, patience)
        finally:
            query.stop()
            spark.streams.removeListener(counts)
            self._report(spark, counts, fed)

    def _start(self, spark: SparkSession, name: str):
        rows = spark.readStream.schema(self.jobs.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/fed")
        done = self.work(rows).observe("outcomes", F.count_if(F.col("status") == "accepted").alias("accepted"), F.count(F.lit(1)).alias("tried"))
        out = self.folder
        writer = done.writeStream.queryName(name).foreachBatch(lambda df, k: df.write.mode("overwrite").parquet(f"{out}/out/batch={k}"))
        return writer.option("checkpointLocation", f"{self.folder}/state").trigger(processingTime="0 seconds").start()

    def _wait(self, query, counts: _Counts, tried: int, patience: float) -> None:
        """Until so many jobs have been tried."""
        until = time.time() + patience
        with counts.news:
            while counts.totals()[1] < tried:
                if query.exception() is not None:
                    raise query.exception()
                if time.time() > until:
                    raise TimeoutError(f"{counts.totals()[1]} of {tried} jobs were tried in {patience} s")
                counts.news.wait(1)

    def _report(self, spark: SparkSession, counts: _Counts, fed: int) -> None:
        """One row a batch: sums up to it, what was still under way of all that was ever fed, and accepted jobs a second."""
        rows, accepted, tried, began = [], 0, 0, None
        for k, (at, a, t) in sorted(counts.rows.items()):
            began, accepted, tried = began or at, accepted + a, tried + t
            rows.append((k, at, accepted, tried, fed - tried, accepted / max(at - began, 1e-6)))
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/progress")
