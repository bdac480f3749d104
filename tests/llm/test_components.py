"""Connected components whatever the order of the ids."""

from __future__ import annotations

import random

from decisionframe.llm.components import components


def test_components_of_a_shuffled_chain(spark):
    rng = random.Random(4)
    ids = rng.sample(range(10**6), 1000)
    chain = [(min(p), max(p)) for p in zip(ids, ids[1:])]
    star = [(2 * 10**6 + 50, 2 * 10**6 + i) for i in range(100) if i != 50]
    rows = [*chain, *star, (5 * 10**6, 5 * 10**6 + 1), (6 * 10**6, 6 * 10**6)]
    want = dict.fromkeys(ids, min(ids)) | {2 * 10**6 + i: 2 * 10**6 for i in range(100)} | {5 * 10**6: 5 * 10**6, 5 * 10**6 + 1: 5 * 10**6, 6 * 10**6: 6 * 10**6}
    got = components(spark.createDataFrame(rows, "a long, b long").repartition(4)).collect()
    assert len(got) == len(want) and {r["node"]: r["comp"] for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
