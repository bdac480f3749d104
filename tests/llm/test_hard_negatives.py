"""Mined negatives against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from decisionframe.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, id string, rank int, cell long, v string"


def brute(rows, positives=5, negatives=3):
    kept = {}
    for i, e, y in rows:
        if i is None or y is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        v = [int(np.floor(256 * np.float64(np.float32(x)))) for x in e]
        row = ((y + 1) % 10 if i % 7 == 0 else y, v)
        kept[i] = min(kept.get(i, row), row)
    size = max(map(len, (v for _, v in kept.values())), default=0)
    full = {i: (y, v + [0] * (size - len(v))) for i, (y, v) in kept.items()}
    out = []
    for a, (y, v) in full.items():
        if a % 50:
            continue
        score = {i: sum(p * q for p, q in zip(v, w, strict=True)) for i, (_, w) in full.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if full[i][0] == y][:positives]:
            good = [i for i in order if full[i][0] != y and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:negatives]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(good)]
    return sorted(out)


def table(n: int, size: int, spread: float, seed: int):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, spread) for x in c], rng.randint(0, 4)))
    same = rows[0][1]
    rows += [(n + i, same, i % 3) for i in range(150)]  # ties
    rows += [(None, same, 1), (n + 200, None, 1), (n + 201, same, None), (n + 202, [1.0, None], 1), (n + 203, [float("nan")] * size, 1), (n + 204, [float("inf")] * size, 2), (n + 205, same[:3], 1), (n + 206, [], 2), (n + 250, same, 77)]
    rows += [(n + 300, same, 1), (n + 300, same, 1), (n + 350, same, 3), (n + 350, same, 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "v") for r in rows], SCHEMA)


def found(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def test_clusters_ties_and_broken_rows(spark, monkeypatch):
    rows = table(450, 12, 0.02, 1)
    want = brute(rows)
    assert len(want) > 30
    assert found(H.mine(H.prepared(frame(spark, rows)))) == want
    # small cells, blocks and groups; labels without statistics
    for name, value in (("A_PIVOT", 30), ("BLOCK", 17), ("GROUP", 3), ("LABELS", 2)):
        monkeypatch.setattr(H, name, value)
    assert found(H.mine(H.prepared(frame(spark, rows)).repartition(5))) == want


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * 2.0**16 for _ in range(4)], i % 2) for i in range(120)]
    want = brute(rows)
    assert want and max(abs(r[4]) for r in want) * 100 > 2**53
    assert found(H.mine(H.prepared(frame(spark, rows)))) == want
    with pytest.raises(ValueError, match="don't fit"):
        H.mine(H.prepared(frame(spark, [(0, [1e12], 1), (1, [1e12], 1)])))


def test_nothing_to_mine(spark):
    for rows in ([], [(0, None, 1)], [(1, [1.0], 1), (2, [1.0], 2)], [(50, [1.0], 1), (51, [1.0], 1), (52, [0.9], 1)]):
        assert H.mine(H.prepared(frame(spark, rows))).collect() == []
