"""A bounded scan of a stream: the same rows that bounded_scan takes of a table, whatever the order in which they come.

The rows with the smallest hashes of their keys are a bottom-k sketch: of the sketches of two sets of rows the k smallest are the sketch of
both. So state is one table of k rows: each batch joins it and the k smallest stay. A batch writes its sketch under its id and takes
the one of the id before, so running a batch again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.sampling import bounded_scan


class ScanSketch:
    """commit() is made for foreachBatch; rows() are the sketch of all batches so far."""

    def __init__(self, folder: str, key: str, n: int, seed: int = 1234) -> None:
        self.folder, self.key, self.n, self.seed = folder.rstrip("/"), key, n, seed

    def _last(self, spark: SparkSession, before: int) -> str | None:
        """The newest sketch before a batch."""
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(where):
            return None
        ids = [int(s.getPath().getName().split("=")[1]) for s in system.listStatus(where) if s.getPath().getName().startswith("batch=")]
        there = [k for k in ids if k < before and system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch={k}/_SUCCESS"))]
        return f"{self.folder}/batch={max(there)}" if there else None

    def commit(self, batch: DataFrame, batch_id: int) -> None:
        spark, last = batch.sparkSession, self._last(batch.sparkSession, batch_id)
        rows = batch if last is None else batch.unionByName(spark.read.schema(batch.schema).parquet(last))
        bounded_scan(rows, self.key, self.n, self.seed).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def rows(self, spark: SparkSession) -> DataFrame:
        last = self._last(spark, 2**62)
        if last is None:
            raise ValueError(f"{self.folder} has no batch")
        return spark.read.parquet(last)


def scan_stream(rows: DataFrame, folder: str, key: str, n: int, seed: int = 1234) -> StreamingQuery:
    """Starts the scan of a stream (all that is there now); folder has the sketch and the checkpoint."""
    sketch = ScanSketch(f"{folder}/sketch", key, n, seed)
    return rows.writeStream.foreachBatch(sketch.commit).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
