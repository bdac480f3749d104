"""Streams against what the same rows give at once, replays included."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from decisionframe.operators import dedup, sampling
from decisionframe.streaming.feeder import Feeder
from decisionframe.streaming.near import NearStream
from decisionframe.streaming.scan import ScanSketch, scan_stream
from decisionframe.streaming.shards import ShardLog


def near_table(n: int) -> list[tuple[int, int, int]]:
    """Keys with signatures of which many are copies, neighbours or links of chains."""
    rng, out, prints = random.Random(4), [], []
    for key in range(n):
        p = rng.getrandbits(64)
        if prints and rng.random() < 0.7:
            p = rng.choice(prints[-40:])
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << bit
        prints.append(p)
        out.append((key, p >> 32, p & 0xFFFFFFFF))
    return out


def greedy(rows) -> list[int]:
    kept: list[tuple[int, int]] = []
    for key, hi, lo in sorted(rows):
        p = hi << 32 | lo
        if all((p ^ q).bit_count() > 3 for _, q in kept):
            kept.append((key, p))
    return [k for k, _ in kept]


def test_near_stream_keeps_what_one_run_keeps(spark, tmp_path):
    rows = near_table(600)
    want = greedy(rows)
    assert 100 < len(want) < 400
    df = spark.createDataFrame([(*r, r[1] * 7 + r[2]) for r in rows], "id long, hi long, lo long, ex long")
    assert sorted(r["id"] for r in dedup.near_kept(df, "id").collect()) == want
    stream = NearStream(spark, str(tmp_path / "near"), "id", few=20)
    parts = [df.where("id < 250"), df.where("id between 250 and 259"), df.limit(0), df.where("id >= 260")]
    for part in parts[:2]:
        stream.feed(part)
    # a new session goes on where the last one stopped, a batch that was not decided included
    stream = NearStream(spark, str(tmp_path / "near"), "id")
    assert stream.batches() == 2
    parts[2].select(F.col("id").alias("key"), "hi", "lo").write.parquet(str(tmp_path / "near" / "in" / "batch=2"))
    stream.feed(parts[3])
    assert stream.batches() == 4 and sorted(r["id"] for r in stream.kept().collect()) == want


def test_near_stream_forgets_after_its_horizon(spark, tmp_path):
    stream = NearStream(spark, str(tmp_path / "near"), "id", horizon_ms=1)
    one = lambda k, hi=0x12345678, lo=0x9ABCDEF0: spark.createDataFrame([(k, hi, lo)], "id long, hi long, lo long")
    # kept; then in the state; then two batches that share no key with it, the first of which ends its time
    assert [stream.feed(one(*x)).count() for x in ((1,), (2, 0xEDCBA987, 0x6543210F), (3, 0x0F0F0F0F, 0xF00FF00F), (4,))] == [1, 1, 1, 1]
    assert stream.feed(one(5)).count() == 0


def test_near_pairs_of_hot_keys(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)}
    rows = [(i, p >> 32, p & 0xFFFFFFFF) for i, p in enumerate(sorted(prints, key=lambda x: x * 2654435761 % 2**64))]
    df = spark.createDataFrame(rows, "id long, hi long, lo long")
    whole = sorted((r["a"], r["b"], r["bits"]) for r in dedup.near_pairs(df, "id").collect())
    full = [h << 32 | x for _, h, x in rows]
    assert whole == [(i, j, b) for i in range(len(rows)) for j in range(i + 1, len(rows)) if (b := (full[i] ^ full[j]).bit_count()) <= 3]
    assert sorted((r["a"], r["b"], r["bits"]) for r in dedup.near_pairs(df, "id", hot=7).collect()) == whole
    with pytest.raises(ValueError, match="bits"):
        dedup.near_pairs(df, "id", 4)


def outcome(jid, shard, status, note="n"):
    return (jid, shard, status, note)


def test_shards_close_once(spark, tmp_path):
    jobs = spark.createDataFrame([(f"{s}-{i}", s) for s in range(4) for i in range(40)], "jid string, shard long")
    schema, log = "jid string, shard long, status string, note string", ShardLog(jobs, str(tmp_path / "log"))
    first = [outcome(f"{s}-{i}", s, "error" if s == 1 and i < 9 or s == 2 and i < 9 or s == 0 and i == 3 else None if i == 5 else "accepted") for s in range(3) for i in range(40)]
    batches = [
        first[:100],  # shard 2 is not through
        first[100:] + [outcome("0-3", 0, "accepted", "late"), outcome("3-1", 3, "accepted")],
        [outcome(f"{s}-{i}", s, "error" if s == 2 and i < 4 else "accepted", "again") for s in (1, 2) for i in range(9)] + [outcome("1-20", 1, "accepted", "twice")],
        [],
    ]
    state = []
    for k, rows in enumerate(batches):
        for _ in range(2):  # a batch that is run again changes nothing
            log.commit(spark.createDataFrame(rows, schema), k)
            state.append(sorted((r["shard"], r["state"], r["missing"], r["rounds"]) for r in log.marks(spark).collect()))
        if k == 1:
            assert sorted(r["jid"] for r in log.retries(spark).collect()) == sorted(f"{s}-{i}" for s in (1, 2) for i in range(9))
    assert state[0] == state[1] == [(0, "closed", 1, 1), (1, "retry", 9, 1)]
    assert state[2] == state[3] == [(0, "closed", 1, 1), (1, "retry", 9, 1), (2, "retry", 9, 1)]
    assert state[4] == state[5] == state[6] == state[7] == [(0, "closed", 1, 1), (1, "closed", 0, 2), (2, "open", 4, 2)]
    got = {r["jid"]: (r["shard"], r["note"]) for r in log.closed(spark, "jid string, batch long, status string, note string").collect()}
    assert len(got) == 79 and got["1-3"] == (1, "again") and got["1-20"] == (1, "n") and "0-3" not in got and got["0-5"] == (0, "n")
    assert log.retries(spark).collect() == [] and not (tmp_path / "log" / "closed" / "shard=2").exists()
    # an earlier batch that is run again leaves later ones as they are
    log.commit(spark.createDataFrame(batches[1], schema), 1)
    assert sorted((r["shard"], r["state"], r["missing"], r["rounds"]) for r in log.marks(spark).collect()) == state[-1]


def test_feeder_stops_within_a_shard_of_its_target(spark, tmp_path):
    jobs = spark.range(1000).select(F.col("id"), (F.col("id") / 50).cast("int").alias("shard"))
    work = lambda df: df.withColumn("status", F.when(F.col("id") % 5 < 2, "accepted").otherwise("rejected"))
    feeder = Feeder(jobs, work, 130, str(tmp_path / "feed"), lockstep=True)
    released = feeder.run()
    # 260 jobs at the assumed half, then 70 more at the rate of two in five that was seen
    assert released == list(range(7))
    rows = spark.read.parquet(str(tmp_path / "feed" / "progress")).orderBy("batch").collect()
    assert rows[-1]["tried"] == 350 and rows[-1]["accepted"] == 140 and rows[-1]["in_flight"] == 0 and all(a["tried"] < b["tried"] for a, b in zip(rows, rows[1:], strict=False))
    out = spark.read.parquet(str(tmp_path / "feed" / "out"))
    assert out.count() == 350 and out.where("status = 'accepted'").count() == 140
    free = Feeder(jobs, work, 130, str(tmp_path / "free"))
    assert 7 <= len(free.run()) <= 8
    assert Feeder(jobs, work, 10_000, str(tmp_path / "all")).run() == list(range(20))


def test_scan_of_a_stream(spark, tmp_path):
    rows = spark.range(2000).select("id", F.concat(F.lit("t"), "id").alias("text"))
    rows.repartition(7).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    scan_stream(stream, str(tmp_path / "scan"), "id", 150).awaitTermination()
    sketch = ScanSketch(str(tmp_path / "scan" / "sketch"), "id", 150)
    want = sorted(map(tuple, sampling.bounded_scan(rows, "id", 150).collect()))
    assert sorted(map(tuple, sketch.rows(spark).collect())) == want
    last = max(int(p.name.split("=")[1]) for p in Path(tmp_path / "scan" / "sketch").iterdir())
    sketch.commit(rows.limit(0), last + 1)
    assert sorted(map(tuple, sketch.rows(spark).collect())) == want
    with pytest.raises(ValueError, match="no batch"):
        ScanSketch(str(tmp_path / "none"), "id", 5).rows(spark)
