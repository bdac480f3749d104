"""Temperatures and thresholds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import sigmoid, softmax, total
from .dedup import shared_table
from .metrics import f1

THRESHOLDS = [round(0.2 + 0.05 * i, 2) for i in range(9)]
LEAST_ROWS = 30
LOW, HIGH, STEPS = 0.2, 8.0, 40


def golden(loss, steps: int = STEPS) -> float:
    """The temperature with the least loss, by golden section on its logarithm."""
    low, high, g = np.log(LOW), np.log(HIGH), (np.sqrt(5) - 1) / 2
    for _ in range(steps):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(np.exp(a)) < loss(np.exp(b)) else (a, high)
    return float(np.exp((low + high) / 2))


def losses(df: DataFrame, grid: list[float]) -> DataFrame:
    """type, t, loss: mean NLL of single answers, mean BCE over all options of multi, for each temperature of the grid. The sums
    are combined before the shuffle, so no group is gathered."""
    rows = df.withColumn("t", F.explode(F.array(*map(F.lit, grid))))
    single = rows.where("type <> 'multi'").select("type", "t", (-F.ln(F.greatest(F.get(softmax(F.col("z"), F.col("t")), F.col("a")), F.lit(1e-12)))).alias("s"), F.lit(1).alias("k"))
    edge = lambda x: F.least(F.greatest(x, F.lit(1e-12)), F.lit(1.0) - 1e-12)
    bce = total(F.zip_with(sigmoid(F.col("z"), F.col("t")), "y", lambda x, y: -(F.ln(edge(x)) * y + F.ln(1 - edge(x)) * (1 - y))))
    multi = rows.where("type = 'multi'").select("type", "t", bce.alias("s"), F.size("z").alias("k"))
    return single.unionByName(multi).groupBy("type", "t").agg((F.sum("s") / F.sum("k")).alias("loss"), F.count("*").alias("n"))


def temperature_grid(df: DataFrame, grid: list[float]) -> DataFrame:
    """type, temperature: the grid's best; 1 for types of fewer than 30 rows."""
    best = losses(df, grid).groupBy("type").agg(F.min_by("t", F.struct("loss", "t")).alias("t"), F.max("n").alias("n"))
    return best.select("type", F.when(F.col("n") < LEAST_ROWS, 1.0).otherwise(F.col("t")).alias("temperature"))


def fit_temperatures(df: DataFrame, rounds: int = 12, points: int = 9) -> DataFrame:
    """type, temperature by repeated grids around the best point so far: each round is one pass with combined sums and narrows
    the bracket of log T to two steps (the predictions are staged for that), until it is as narrow as 40 golden sections leave it or the rounds are over."""
    df, low, high, best = shared_table(df, "predictions"), {}, {}, {}
    for r in range(rounds):
        if r and not best:
            break
        grid = sorted({float(x) for t in (best or {"": 1}) for x in np.exp(np.linspace(low.get(t, np.log(LOW)), high.get(t, np.log(HIGH)), points))})
        found = {}
        for row in losses(df, grid).collect():
            own = np.exp(low.get(row["type"], np.log(LOW))) * (1 - 1e-9), np.exp(high.get(row["type"], np.log(HIGH))) * (1 + 1e-9)
            if own[0] <= row["t"] <= own[1]:
                found.setdefault(row["type"], []).append((row["loss"], row["t"], row["n"]))
        for t, rows in found.items():
            step = (high.get(t, np.log(HIGH)) - low.get(t, np.log(LOW))) / (points - 1)
            loss, at, n = min(rows)
            best[t] = (at, n)
            low[t], high[t] = max(np.log(LOW), np.log(at) - step), min(np.log(HIGH), np.log(at) + step)
    return df.sparkSession.createDataFrame(pd.DataFrame([(t, 1.0 if n < LEAST_ROWS else at) for t, (at, n) in best.items()], columns=["type", "temperature"]), "type string, temperature double")


def threshold_grid(df: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """threshold, f1 (micro) over all options of multi predictions."""
    options = df.where("type = 'multi'").select(F.explode(F.arrays_zip("p", "y")).alias("o")).select("o.*", F.explode(F.array(*map(F.lit, thresholds))).alias("threshold"))
    on, is_ = F.col("p") >= F.col("threshold"), F.col("y") == 1
    n = lambda c: F.sum(c.cast("long"))
    return options.groupBy("threshold").agg(f1(n(on & is_), n(on & ~is_), n(~on & is_)).alias("f1"))


def best_threshold(df: DataFrame) -> DataFrame:
    """The smallest threshold with the largest F1; 0.5 with fewer than 30 multi rows."""
    n = df.where("type = 'multi'").agg(F.count("*").alias("n"))
    best = threshold_grid(df).agg(F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("t"))
    return best.crossJoin(n).select(F.when(F.col("n") < LEAST_ROWS, 0.5).otherwise(F.col("t")).alias("threshold"))
