"""Groups and state of the near-duplicate stream are bounded by buckets, however many blocks there are."""

from __future__ import annotations

import random

import numpy as np

from decisionframe.operators import dedup
from decisionframe.streaming import near


def test_state_has_a_group_per_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(near, "BUCKETS", 3, raising=False)
    rng = random.Random(5)
    rows = [(i, rng.getrandbits(32), rng.getrandbits(32)) for i in range(60)]
    rows += [(i + 60, h ^ 5, x) for i, (_, h, x) in enumerate(rows[:30])]
    df = spark.createDataFrame(rows, "id long, hi long, lo long")
    stream = near.NearStream(spark, str(tmp_path / "near"), "id")
    for part in ("id < 60", "id >= 60"):
        stream.feed(df.where(part))
    assert sorted(r["id"] for r in stream.kept().collect()) == list(range(60))
    state = spark.read.format("statestore").option("stateVarName", "kept").load(str(tmp_path / "near" / "state"))
    assert 0 < state.select("key").distinct().count() <= 6 * 3


def test_one_bucket_forgets_only_old_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(near, "BUCKETS", 1, raising=False)
    stream = near.NearStream(spark, str(tmp_path / "near"), "id", horizon_ms=1)
    one = lambda k, hi=0x12345678, lo=0x9ABCDEF0: spark.createDataFrame([(k, hi, lo)], "id long, hi long, lo long")
    assert [stream.feed(one(*x)).count() for x in ((1,), (2, 0xEDCBA987, 0x6543210F), (3, 0x0F0F0F0F, 0xF00FF00F), (4,), (5,))] == [1, 1, 1, 1, 0]


def test_near_places_are_those_of_all_pairs(monkeypatch):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = np.array([b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(20)], np.uint64)
    a, b = prints[::2], prints[1::2]
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if int(x ^ y).bit_count() <= dedup.MOST_BITS}
    for step in (1, 7, 1 << 22):
        monkeypatch.setattr(near, "STEP", step)
        got = {(int(i), int(j)) for t in range(6) for p, q in near._near(a, b, t, dedup.MOST_BITS) for i, j in zip(p, q, strict=True)}
        assert got == want and want
    assert not list(near._near(a[:0], b, 0, 3))
