"""The near-duplicate filter over a stream: what near_kept keeps of a table, kept of its rows as they come in batches.

Rows of a batch are candidates, in key order; a candidate falls if a row that was kept before, of an earlier batch or of its own,
has a signature within three bits. Signatures meet by table and block (see dedup.tabled). State is keyed by table and bucket, a hash
of the block: a ListState of packed signatures of the rows that were kept, so whatever may be near a candidate is in the state of one
of its keys, and a batch has BUCKETS groups a table at most, however many blocks it has, as a group costs some calls of its own.
Within a bucket only signatures of equal blocks are compared. A batch's start of the query takes two sources, the batch's signatures
and what the batch before has kept, which goes into the state; so state holds kept rows alone. The groups tell candidates that state
rules out and pairs of candidates that are near; foreachBatch settles these pairs in key order and writes the batch's kept rows,
replacing them when a batch is run again.

Of equal signatures each task sends the first only, as the others fall whatever becomes of it: with it, or by what it falls by. With a
horizon, a processing-time timer forgets blocks that no batch has touched for so long; without one the state grows with what is kept.
Batches must come in key order for the result of one run over all rows; in any other order the earlier batch goes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..operators.dedup import FEW, MOST_BITS, TABLES, fallen, shared_table, tabled

CANDIDATE, ACCEPTED = 0, 1
#: What a group tells: a candidate, one that falls, a pair of candidates.
THERE, FALLS, NEAR = 0, 1, 2
OUT = "what int, key long, other long, hi long, lo long"
#: Buckets of a table's blocks. A folder's state is bound to their number.
BUCKETS = 256
#: Pairs that are compared at once, and chunks of a bucket's state beyond which they become one.
STEP, CHUNKS = 1 << 22, 16
STATE = "spark.sql.streaming.stateStore"
CONF = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    f"{STATE}.maintenanceInterval": "2s", f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true", f"{STATE}.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}


def _first_of_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's candidates with one signature, the first."""
    best: dict[tuple[int, int], int] = {}
    for batch in batches:
        for key, hi, lo in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (seen := best.get((hi, lo))) is None or key < seen:
                best[hi, lo] = key
    if best:
        yield pa.record_batch([pa.array(list(best.values()), pa.int64()), pa.array([h for h, _ in best], pa.int64()), pa.array([x for _, x in best], pa.int64())], names=["key", "hi", "lo"])


def _joined(hi, lo) -> np.ndarray:
    return (np.asarray(hi, np.int64).astype(np.uint64) << np.uint64(32)) | np.asarray(lo, np.int64).astype(np.uint64)


def _blocks(prints: np.ndarray, table: int) -> np.ndarray:
    """The blocks of joined signatures in a table, as dedup.tabled has them."""
    half = prints >> np.uint64(32) if table < len(TABLES) else prints & np.uint64(0xFFFFFFFF)
    return half & np.uint64(TABLES[table % len(TABLES)])


def _near(a: np.ndarray, b: np.ndarray, table: int, most_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i in a and j in b of signatures with one block that are near, piece by piece."""
    theirs = _blocks(b, table)
    order = np.argsort(theirs, kind="stable")
    theirs, mine = theirs[order], _blocks(a, table)
    first = np.searchsorted(theirs, mine, "left")
    n = np.searchsorted(theirs, mine, "right") - first
    upto = np.cumsum(n)
    at = 0
    while at < len(a):
        done = int(upto[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + STEP, "right")))
        m = n[at:end]
        i = np.repeat(np.arange(at, end), m)
        j = order[np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[at:end], m)]
        close = np.bitwise_count(a[i] ^ b[j]) <= most_bits
        yield i[close], j[close]
        at = end


class KeptSignatures(StatefulProcessor):
    def __init__(self, most_bits: int, horizon_ms: int | None) -> None:
        self.most_bits, self.horizon = most_bits, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("kept", "packed binary")
        self.touched = handle.getValueState("touched", "blocks binary, at binary") if self.horizon else None

    def _held(self, new: np.ndarray) -> np.ndarray:
        """The kept signatures of the bucket, new ones included, which go into the state."""
        chunks = [np.frombuffer(r[0], np.uint64) for r in self.kept.get()]
        held = np.concatenate([np.zeros(0, np.uint64), *chunks, new])
        if len(chunks) >= CHUNKS:
            self.kept.put([(held.tobytes(),)])
        elif len(new):
            self.kept.appendValue((new.tobytes(),))
        return held

    def _times(self) -> tuple[np.ndarray, np.ndarray]:
        """The bucket's blocks, and when each was touched last."""
        row = self.touched.get()
        return (np.frombuffer(row[0], np.uint64), np.frombuffer(row[1], np.int64)) if row is not None else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        table = int(key[0])
        frame = pd.concat(list(rows))
        new = frame[frame["role"] == ACCEPTED]
        held = self._held(np.unique(_joined(new["hi"], new["lo"])))
        if self.horizon:
            now = timerValues.getCurrentProcessingTimeInMs()
            blocks, at = self._times()
            here = np.unique(_blocks(_joined(frame["hi"], frame["lo"]), table))
            rest = ~np.isin(blocks, here)
            self.touched.update((np.concatenate([blocks[rest], here]).tobytes(), np.concatenate([at[rest], np.full(len(here), now, np.int64)]).tobytes()))
            self.handle.registerTimer(now + self.horizon)
        asked = frame[frame["role"] == CANDIDATE].sort_values("key").drop_duplicates(["hi", "lo"])
        if not len(asked):
            return
        names, prints = asked["key"].to_numpy(), _joined(asked["hi"], asked["lo"])
        if table == 0:
            yield pd.DataFrame({"what": THERE, "key": names, "other": -1, "hi": asked["hi"], "lo": asked["lo"]})
        falls = np.zeros(len(names), bool)
        for i, _ in _near(prints, held, table, self.most_bits):
            falls[i] = True
        if falls.any():
            yield pd.DataFrame({"what": FALLS, "key": names[falls], "other": -1, "hi": 0, "lo": 0})
        names, prints = names[~falls], prints[~falls]
        for i, j in _near(prints, prints, table, self.most_bits):
            i, j = i[i < j], j[i < j]
            if len(i):
                yield pd.DataFrame({"what": NEAR, "key": names[i], "other": names[j], "hi": 0, "lo": 0})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        blocks, at = self._times()
        stay = at + self.horizon > timerValues.getCurrentProcessingTimeInMs()
        if not stay.all():
            held = self._held(np.zeros(0, np.uint64))
            held = held[np.isin(_blocks(held, int(key[0])), blocks[stay])]
            self.kept.clear()
            if len(held):
                self.kept.appendValue((held.tobytes(),))
            if stay.any():
                self.touched.update((blocks[stay].tobytes(), at[stay].tobytes()))
            else:
                self.touched.clear()
        return iter(())

    def close(self) -> None:
        pass


class NearStream:
    """A filter that lives in a shared folder: feed() takes the next batch of signatures (key, hi, lo), kept() is what stands."""

    def __init__(self, spark: SparkSession, folder: str, key: str, most_bits: int = MOST_BITS, horizon_ms: int | None = None, few: int = FEW) -> None:
        self.spark, self.folder, self.key, self.few = spark, folder.rstrip("/"), key, few
        self.most_bits, self.horizon = most_bits, horizon_ms
        if not self._there("kept/batch=-1"):
            spark.createDataFrame([], "key long, hi long, lo long").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/kept/batch=-1")

    def _there(self, name: str) -> bool:
        """Whether a table has been written to its end."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def batches(self) -> int:
        """Batches that have been decided."""
        k = 0
        while self._there(f"kept/batch={k}"):
            k += 1
        return k

    def feed(self, signatures: DataFrame) -> DataFrame:
        """The keys that are kept of the next batch. A batch that was written but not decided, as its run broke off, goes first."""
        k = self.batches()
        if self._there(f"in/batch={k}"):
            self._run(k)
            k += 1
        signatures.select(F.col(self.key).cast("long").alias("key"), "hi", "lo").write.mode("overwrite").parquet(f"{self.folder}/in/batch={k}")
        self._run(k)
        return self._read(f"kept/batch={k}")

    def kept(self) -> DataFrame:
        return self._read("kept")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema("key long, hi long, lo long").parquet(f"{self.folder}/{name}").select(F.col("key").alias(self.key))

    def _run(self, k: int) -> None:
        schema = "key long, hi long, lo long"
        upto = lambda first, last: "{" + ",".join(map(str, range(first, last + 1))) + "}"
        stream = lambda name, first, last: self.spark.readStream.schema(schema).option("basePath", f"{self.folder}/{name}").parquet(f"{self.folder}/{name}/batch={upto(first, last)}").select("key", "hi", "lo")
        candidates = stream("in", 0, k).mapInArrow(_first_of_equal, schema).withColumn("role", F.lit(CANDIDATE))
        rows = tabled(candidates.unionByName(stream("kept", -1, k - 1).withColumn("role", F.lit(ACCEPTED))))
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(BUCKETS)).cast("int")).drop("block")
        told = rows.groupBy("table", "bucket").transformWithStateInPandas(statefulProcessor=KeptSignatures(self.most_bits, self.horizon), outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime" if self.horizon else "None")
        before = {c: self.spark.conf.get(c, None) for c in CONF}
        for c, v in CONF.items():
            self.spark.conf.set(c, v)
        try:
            told.writeStream.foreachBatch(lambda df, _: self._settle(df, k)).outputMode("append").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start().awaitTermination()
        finally:
            for c, v in before.items():
                self.spark.conf.set(c, v) if v is not None else self.spark.conf.unset(c)

    def _settle(self, df: DataFrame, k: int) -> None:
        told = shared_table(df, "told")
        gone = told.where(F.col("what") == FALLS).select("key").distinct()
        pairs = told.where(F.col("what") == NEAR).select(F.col("key").alias("a"), F.col("other").alias("b")).distinct()
        for side in ("a", "b"):
            pairs = pairs.join(gone.withColumnRenamed("key", side), side, "left_anti")
        falls = fallen(shared_table(pairs.select("a", "b"), "pairs"), "key", self.few)
        there = told.where(F.col("what") == THERE).select("key", "hi", "lo")
        there.join(gone, "key", "left_anti").join(falls, "key", "left_anti").write.mode("overwrite").parquet(f"{self.folder}/kept/batch={k}")
