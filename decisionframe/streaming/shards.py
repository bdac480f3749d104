"""Shards of jobs that close once enough of their outcomes are in.

ShardLog.commit is made for foreachBatch. A batch is committed under its id: its outcomes go to log/batch=<id>, finished shards to
closed/shard=<s>, requests for another try to retry/batch=<id> and, last of all, the shards' markers to done/batch=<id>. All of these
are replaced as wholes, and only what earlier ids have logged and marked is looked at, so a batch that is run again after it was
broken off, or twice, leaves what one run leaves. Readers trust markers only: a shard without one is open, whatever lies in closed/.

A job is attempted once it has an outcome, good or an error; errors count as attempts and are not outcomes. When all jobs of a shard
have been attempted it closes if at most a share `missing` of them has no outcome. Else its missing jobs are asked for once more; when
these have all been attempted again the shard closes or, where too many still miss, is left open for a later run. Of several
outcomes of a job the first batch's counts (in a batch the least by its columns). A batch looks at the shards that it has rows of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import shared_table

MARK = "shard long, state string, jobs long, missing long"


class ShardLog:
    """jobs has jid and shard; outcomes have jid, shard, status ('error', or anything else, null too) and other columns."""

    def __init__(self, jobs: DataFrame, folder: str, missing: float = 0.03) -> None:
        self.jobs, self.folder, self.missing = jobs.select("jid", F.col("shard").cast("long").alias("shard")), folder.rstrip("/"), missing

    def _before(self, spark: SparkSession, name: str, schema: str, batch_id: int) -> DataFrame:
        """The rows of earlier batches, with `batch`."""
        path = f"{self.folder}/{name}"
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return spark.createDataFrame([], f"{schema}, batch long")
        return spark.read.schema(f"{schema}, batch long").parquet(path).where(F.col("batch") < batch_id)

    def commit(self, outcomes: DataFrame, batch_id: int) -> None:
        spark = outcomes.sparkSession
        log = outcomes.withColumn("shard", F.col("shard").cast("long"))
        log.write.mode("overwrite").partitionBy("shard").parquet(f"{self.folder}/log/batch={batch_id}")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log.schema)
        marked = self._before(spark, "done", MARK, batch_id)
        settled = marked.where("state <> 'retry'").select("shard").distinct()
        asked_again = marked.where("state = 'retry'").select("shard").distinct()
        touched = log.select("shard").distinct().join(settled, "shard", "left_anti")
        seen = self._before(spark, "log", schema, batch_id + 1).join(F.broadcast(shared_table(touched, "touched")), "shard", "left_semi")
        good = ~F.col("status").eqNullSafe("error")
        kept = [c for c in log.columns if c not in ("jid", "shard")]
        tried = seen.groupBy("shard", "jid").agg(F.min(F.when(good, F.struct("batch", *kept))).alias("outcome"), F.count_if(~good).alias("errors"))
        jobs = shared_table(self.jobs.join(touched, "shard", "left_semi").join(tried, ["shard", "jid"], "left"), "attempts")
        has = F.col("outcome").isNotNull()
        state = jobs.groupBy("shard").agg(F.count("*").alias("jobs"), F.count_if(has).alias("have"), F.count_if(has | (F.col("errors") >= 1)).alias("once"), F.count_if(has | (F.col("errors") >= 2)).alias("twice"))
        state = state.withColumn("missing", F.col("jobs") - F.col("have")).join(asked_again.withColumn("again", F.lit(True)), "shard", "left")
        round_over = F.when(F.col("again"), F.col("twice") == F.col("jobs")).otherwise(F.col("once") == F.col("jobs"))
        fine = F.col("missing") <= F.col("jobs") * self.missing
        state = state.where(round_over).withColumn("state", F.when(fine, "closed").when(F.col("again"), "open").otherwise("retry"))
        marks = shared_table(state.select("shard", "state", "jobs", "missing"), "marks")
        closing = jobs.join(marks.where("state = 'closed'").select("shard"), "shard", "left_semi").where(has)
        closing = closing.select("jid", *(F.col("outcome")[c].alias(c) for c in kept), "shard")
        closing.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(f"{self.folder}/closed")
        again = jobs.join(marks.where("state = 'retry'").select("shard"), "shard", "left_semi").where(~has).select("jid", "shard")
        again.write.mode("overwrite").parquet(f"{self.folder}/retry/batch={batch_id}")
        marks.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/done/batch={batch_id}")

    def marks(self, spark: SparkSession) -> DataFrame:
        """shard, state, jobs, missing, rounds of the shards that are closed, or left open for good."""
        rows = self._before(spark, "done", MARK, 2**62)
        last = rows.groupBy("shard").agg(F.max_by(F.struct("state", "jobs", "missing"), "batch").alias("m"), F.count("*").alias("rounds"))
        return last.select("shard", "m.*", "rounds")

    def closed(self, spark: SparkSession, schema: str) -> DataFrame:
        """The outcomes (schema without shard) of the closed shards."""
        done = self.marks(spark).where("state = 'closed'").select("shard")
        return spark.read.schema(f"{schema}, shard long").parquet(f"{self.folder}/closed").join(done, "shard", "left_semi")

    def retries(self, spark: SparkSession) -> DataFrame:
        """jid, shard: the jobs that have been asked for again and have still no second attempt of their shard marked."""
        open_ = self.marks(spark).where("state = 'retry'").select("shard")
        return self._before(spark, "retry", "jid string, shard long", 2**62).drop("batch").join(open_, "shard", "left_semi")
