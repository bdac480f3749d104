"""The near-duplicate filter on long chains of drifting copies."""

from __future__ import annotations

import random

from decisionframe.operators import dedup


def chain(n: int) -> list[tuple[int, int, int, int]]:
    """Row i is within three bits of rows i - 1 and i + 1 only."""
    rng, path = random.Random(1), [0]
    while len(path) < n:
        x = path[-1]
        for b in rng.sample(range(64), 3):
            x ^= 1 << b
        if all((x ^ p).bit_count() > dedup.MOST_BITS for p in path[:-1]):
            path.append(x)
    return [(i, x >> 32, x & 0xFFFFFFFF, i) for i, x in enumerate(path)]


def kept(spark, rows, **options) -> list[int]:
    sig = spark.createDataFrame(rows, "id long, hi long, lo long, ex long").repartition(4)
    return sorted(r["id"] for r in dedup.near_kept(sig, "id", **options).collect())


def test_every_second_of_a_long_chain_falls(spark):
    assert kept(spark, chain(400)) == list(range(0, 400, 2))


def test_rounds_and_driver_agree(spark):
    assert kept(spark, chain(18), few=1) == kept(spark, chain(18), few=0) == list(range(0, 18, 2))
