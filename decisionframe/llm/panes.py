"""Window panes with revisions: totals by kind and event hour that are published once they are due and revised until they close.

`cut` deals the clicks out into batches and writes them as one table below spark.checkpoint.dir; `panes` feeds the batches in
order to a streaming query, started anew for each of them on one checkpoint. The query keeps its state by pane with
transformWithStateInPandas: a ValueState holds a pane's current and its published totals, one event-time timer (grace) emits the
pane when the watermark reaches its hour's end and the grace, a second one (close) forgets it. Rows of closed panes are put out
as they are. In the last batch a sentinel row for each pane finalises those that were not emitted.

Spark's watermark is the largest event time of the earlier batches, as wanted, but begins at 1970 and never falls; so event times
are moved by SHIFT, beyond any time that a timestamp can name, and the first batch's watermark lies before all of them. Batches
without rows, and the runs that Spark adds when a watermark has moved, would shift batches against each other: every batch has a
tick row, and added runs are off while the query is started.

Scale: each task sums up its rows by pane before the shuffle, so a pane that a third of the rows belongs to gets a row a task.
Rows of closed panes are dealt out by their ids, not by their panes, as they need no state. State grows with the open panes only.
The driver learns one row a batch, its largest event time. Every file of a batch is below the shared folder, so a lost executor's
tasks run again from them, and a batch's output is replaced as a whole when it is written again.

Defined cases: a row without ts is dropped; a click_id counts once, and null is one id; of rows that share an id but differ, the
first by (day, arrived_at, ts, kind, cents) counts, nulls first. A row without arrived_at is of day 0. A null kind is `none`, the same as
a kind of that name. A null value or one that is no finite number counts 0 cents. Other columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import TimestampNTZType

from .common import parts_of, prepare, stage_dir

HOUR, DAY = 3_600_000, 86_400_000
#: Microseconds by which event times are moved: more than from year 1 to 1970.
SHIFT = 1 << 58
#: Batches; hours from a pane's end to its emission, and to its end of revisions.
BATCHES, GRACE, CLOSE = 10, 12, 48
#: What a row of the feed is: a click, a batch's tick, a pane's sentinel.
CLICK, TICK, SENTINEL = 0, 1, 2
OUT = "hour long, click_id long, n_rows long, cents long, record string, kind string"
FED = "pane string, slot long, salt int, role int, kind string, hour long, click_id long, n_rows long, cents long"
#: Settings of the query. State stores of a start that has ended go soon, and small ones take no more disk than they hold.
STATE = "spark.sql.streaming.stateStore"
CONF = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    f"{STATE}.maintenanceInterval": "2s", f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true", f"{STATE}.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}


def micros(c: Column, zoned: bool) -> Column:
    """Microseconds since 1970 of a timestamp, as it reads on the clock."""
    local = c.cast("timestamp_ntz") if zoned else c
    seconds = F.hour(local) * 3600 + F.minute(local) * 60
    return F.unix_date(local.cast("date")).cast("long") * F.lit(DAY * 1000) + seconds.cast("long") * F.lit(1_000_000) + (F.extract(F.lit("SECOND"), local) * 1_000_000).cast("long")


def batched(clicks: DataFrame, batches: int = BATCHES) -> DataFrame:
    """batch, kind, hour, click_id, t (microseconds of event time), cents: every click once."""
    zoned = not isinstance(clicks.schema["ts"].dataType, TimestampNTZType), not isinstance(clicks.schema["arrived_at"].dataType, TimestampNTZType)
    value = F.col("value").cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(9e16))
    rows = clicks.where("ts is not null").select(
        F.col("click_id").cast("long").alias("click_id"),
        F.struct(
            F.coalesce(F.unix_date(F.col("arrived_at").cast("date")), F.lit(0)).alias("day"),
            (micros(F.col("arrived_at"), zoned[1])).alias("arrived"),
            micros(F.col("ts"), zoned[0]).alias("ts"),
            F.coalesce("kind", F.lit("none")).alias("kind"),
            F.when(finite, F.floor(value * 100 + 0.5)).otherwise(F.lit(0)).cast("long").alias("cents"),
        ).alias("r"),
    )
    once = rows.groupBy("click_id").agg(F.min("r").alias("r")).select("click_id", "r.*")
    q = F.pmod("day", F.lit(batches))
    late = F.greatest(F.lit(0), F.coalesce(F.crc32(F.col("click_id").cast("string").cast("binary")), F.lit(0)) % 30 - 23)
    t = F.col("ts") - (F.col("day") - q).cast("long") * F.lit(DAY * 1000)
    dealt = once.select(F.least(F.lit(batches - 1), q + late).cast("int").alias("batch"), "kind", "click_id", t.alias("t"), "cents")
    return dealt.withColumn("hour", F.expr(f"(t - pmod(t, {HOUR * 1000}L)) div {HOUR * 1000}L"))


def cut(clicks: DataFrame, folder: str, batches: int = BATCHES) -> list[int | None]:
    """Writes the batches, with their ticks and the last one's sentinels, as folder/batch=k; the largest event time of each."""
    spark, names = clicks.sparkSession, ("batch", "kind", "click_id", "t", "cents", "hour")
    rows = batched(clicks, batches).select(*names, F.lit(CLICK).alias("role"))
    rows.hint("rebalance", "batch").write.partitionBy("batch").parquet(folder)
    written = spark.read.schema(rows.schema).option("basePath", folder).parquet(folder)
    last = dict(written.groupBy("batch").agg(F.max("t")).collect())
    none = F.lit(0).cast("long")
    ticks = spark.range(batches).select(F.col("id").cast("int").alias("batch"), F.lit("").alias("kind"), none.alias("click_id"), F.lit(-SHIFT).cast("long").alias("t"), none.alias("cents"), none.alias("hour"), F.lit(TICK).alias("role"))
    marks = written.groupBy("kind", "hour").agg(F.lit(batches - 1).alias("batch")).select("batch", "kind", none.alias("click_id"), F.lit(-SHIFT).cast("long").alias("t"), none.alias("cents"), "hour", F.lit(SENTINEL).alias("role"))
    ticks.unionByName(marks).coalesce(1 if not last else 8).write.mode("append").partitionBy("batch").parquet(folder)
    return [last.get(k) for k in range(batches)]


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task with the same pane become one; rows of closed panes, ticks and sentinels pass."""
    names, held = ["pane", "slot", "salt", "role", "kind", "hour", "click_id", "n_rows", "cents"], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        alone = pc.or_(pc.greater(table["salt"], 0), pc.not_equal(table["role"], CLICK))
        through = table.filter(alone).combine_chunks()
        if through.num_rows:
            yield pa.record_batch([through[n].chunk(0) for n in names], names=names)
        rest = table.filter(pc.invert(alone)).select(["pane", "slot", "n_rows", "cents"])
        held = (pa.concat_tables([held, rest.cast(held.schema)]) if held is not None else rest).group_by(["pane", "slot"]).aggregate([("n_rows", "sum"), ("cents", "sum")]).rename_columns(["pane", "slot", "n_rows", "cents"])
    if held is not None and (n := held.num_rows):
        pane, slot, n_rows, cents = (held[c].combine_chunks() for c in ("pane", "slot", "n_rows", "cents"))
        yield pa.record_batch([pane, slot, pa.array([0] * n, pa.int32()), pa.array([CLICK] * n, pa.int32()), pane, slot, pa.array([-1] * n, pa.int64()), n_rows, cents], names=names)


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["hour", "click_id", "n_rows", "cents", "record", "kind"])


class Panes(StatefulProcessor):
    """By (kind, hour): current totals, published totals (n is -1 before), and the timers of emission and end."""

    def __init__(self, grace: int, close: int) -> None:
        self.grace, self.close_after = grace, close

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "n long, cents long, published_n long, published_cents long")

    def ends(self, hour: int) -> tuple[int, int]:
        """Watermarks, in moved milliseconds, at which the pane is due and closed."""
        end = (hour + 1) * HOUR + SHIFT // 1000
        return end + self.grace * HOUR, end + self.close_after * HOUR

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kind, hour, salt = key
        if salt:  # rows of closed panes
            for part in rows:
                clicks = part[part["role"] == CLICK]
                if len(clicks):
                    yield pd.DataFrame({"hour": clicks["hour"], "click_id": clicks["click_id"], "n_rows": clicks["n_rows"], "cents": clicks["cents"], "record": "late", "kind": clicks["kind"]})
            return
        n = cents = 0
        final = False
        for part in rows:
            clicks = part[part["role"] == CLICK]
            n, cents = n + int(clicks["n_rows"].sum()), cents + int(clicks["cents"].sum())
            final = final or bool((part["role"] == SENTINEL).any())
        due, closed = self.ends(hour)
        now, old = timerValues.getCurrentWatermarkInMs(), self.totals.get()
        if old is None and not n:
            return  # the sentinel of a pane that is gone
        had_n, had_cents, told_n, told_cents = old or (0, 0, -1, 0)
        total = (had_n + n, had_cents + cents)
        out = []
        if told_n >= 0:
            if n:
                out = [(hour, -1, told_n, told_cents, "retract", kind), (hour, -1, *total, "replace", kind)]
                told_n, told_cents = total
        elif final and now < due:
            out = [(hour, -1, *total, "final", kind)]
        if n:
            self.totals.update((*total, told_n, told_cents))
        if old is None:
            self.handle.registerTimer(due)
            self.handle.registerTimer(closed)
        if out:
            yield _rows(out)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kind, hour, _ = key
        old, now = self.totals.get(), timerValues.getCurrentWatermarkInMs()
        due, closed = self.ends(hour)
        at = expiredTimerInfo.getExpiryTimeInMs()
        if old is None:
            return
        n, cents, told_n, _ = old
        if told_n < 0:
            if now < due:
                raise ValueError(f"timer {at} of a pane that is due at {due} has expired at {now}")
            self.totals.update((n, cents, n, cents))
            yield _rows([(hour, -1, n, cents, "emit", kind)])
        if at >= closed:
            self.totals.clear()

    def close(self) -> None:
        pass


def _feed(stream: DataFrame, watermark: int | None, close: int, salts: int) -> DataFrame:
    """The stream's rows by pane; those of panes that are closed at this watermark are dealt out by their ids."""
    closed = F.lit(False) if watermark is None else (F.col("hour") + 1 + close) * F.lit(HOUR) <= F.lit(watermark // 1000)
    salt = F.when(F.col("role") == TICK, 1).when((F.col("role") == CLICK) & closed, 1 + F.pmod(F.xxhash64("click_id"), F.lit(salts))).otherwise(0).cast("int")
    rows = stream.withColumn("event", F.timestamp_micros(F.col("t") + F.lit(SHIFT))).withWatermark("event", "0 seconds")
    open_ = F.col("salt") == 0
    rows = rows.withColumn("salt", salt).select(F.when(open_, F.col("kind")).otherwise("").alias("pane"), F.when(open_, F.col("hour")).otherwise(F.lit(0)).cast("long").alias("slot"), "salt", F.col("role").cast("int").alias("role"), "kind", "hour", "click_id", F.lit(1).cast("long").alias("n_rows"), "cents")
    return rows.mapInArrow(_partials, FED)


def panes(clicks: DataFrame, batches: int = BATCHES, grace: int = GRACE, close: int = CLOSE) -> DataFrame:
    """batch, hour, click_id, n_rows, cents, record, kind."""
    spark = clicks.sparkSession
    prepare(spark)
    base = f"{stage_dir(spark)}/decisionframe/panes-{uuid.uuid4().hex}"
    cuts, state, out = f"{base}/cut", f"{base}/state", f"{base}/out"
    largest = cut(clicks, cuts, batches)
    schema = spark.read.option("basePath", cuts).parquet(f"{cuts}/batch=0").schema
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        for k in range(batches):
            seen = [t for t in largest[:k] if t is not None]
            _run(spark, f"{cuts}/batch={{{','.join(map(str, range(k + 1)))}}}", cuts, schema, state, f"{out}/batch={k}", max(seen, default=None), grace, close)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    rows = spark.read.schema(f"{OUT}, batch long").option("basePath", out).parquet(out)
    return rows.select("batch", "hour", "click_id", "n_rows", "cents", "record", "kind")


def _run(spark: SparkSession, path: str, base: str, schema, state: str, out: str, watermark: int | None, grace: int, close: int) -> None:
    """One start of the query: the batch that path has more than the start before."""
    stream = spark.readStream.schema(schema).option("basePath", base).parquet(path)
    keyed = _feed(stream, watermark, close, 2 * parts_of(spark)).groupBy("pane", "slot", "salt")
    kept = keyed.transformWithStateInPandas(statefulProcessor=Panes(grace, close), outputStructType=OUT, outputMode="Append", timeMode="EventTime")

    def write(df: DataFrame, _: int) -> None:
        df.write.mode("overwrite").parquet(out)

    query = kept.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
