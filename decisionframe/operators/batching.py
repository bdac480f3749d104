"""Length-grouped batches under a token budget, and steps under an example count: sequential within a chunk."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import keyed

CHUNK = 8192


def cut(lengths: list[int], budget: int, most_rows: int = 256) -> list[int]:
    """Batch numbers for lengths in falling order: a batch's longest times its rows stays within the budget."""
    out, number, rows, longest = [], 0, 0, 0
    for n in lengths:
        if rows and (max(longest, n) * (rows + 1) > budget or rows >= most_rows):
            number, rows, longest = number + 1, 0, 0
        rows, longest = rows + 1, max(longest, n)
        out.append(number)
    return out


def make_batches(rows: DataFrame, key: str, length: str, budget: int, seed: int = 1234, most_rows: int = 256, chunk: int = CHUNK) -> DataFrame:
    """key, chunk, batch. Rows are dealt to chunks by hash, about `chunk` rows each, and each chunk is cut in one task."""
    n = max(1, -(-rows.count() // chunk))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "key"], ascending=[False, True], kind="stable")
        return pdf.assign(batch=cut(pdf.length.tolist(), budget, most_rows))[["key", "chunk", "length", "batch"]]

    dealt = rows.select(F.col(key).cast("string").alias("key"), F.col(length).cast("long").alias("length"), (keyed("chunk", str(seed), F.col(key)) % n).alias("chunk"))
    return dealt.groupBy("chunk").applyInPandas(run, "key string, chunk long, length long, batch long")


def steps(batches: DataFrame, examples: int) -> DataFrame:
    """batches (chunk, batch, n) in order, with `step`: batches are gathered until a step has enough examples."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, step, held, out = pdf.sort_values("batch"), 0, 0, []
        for n in pdf.n:
            out.append(step)
            held += n
            if held >= examples:
                step, held = step + 1, 0
        return pdf.assign(step=out)

    return batches.groupBy("chunk").applyInPandas(run, "chunk long, batch long, n long, step long")


def learning_rate(step: int, total: int, warm_up: int) -> float:
    """Linear warm-up, then a cosine down to nothing."""
    import math

    return (step + 1) / max(1, warm_up) if step < warm_up else 0.5 * (1 + math.cos(math.pi * min(1.0, (step - warm_up) / max(1, total - warm_up))))
