"""Panes against a plain simulation of the batches."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from contextlib import ExitStack
from datetime import datetime, timedelta

import pytest

from decisionframe.llm import panes as P

EPOCH = datetime(1970, 1, 1)
SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, salt int, batch string, role long"


def simulated(rows: list[tuple], batches: int = 10, grace: int = 12, close: int = 48) -> Counter:
    """What the contract says, row by row."""
    once = {}
    for r in rows:
        if r[1] is not None:
            once.setdefault(r[0], r)
    dealt = [[] for _ in range(batches)]
    for click, ts, arrived, kind, value in once.values():
        day = (arrived.date() - EPOCH.date()).days if arrived else 0
        q = day % batches
        t = ts - timedelta(days=day - q)
        cents = 0 if value is None or not math.isfinite(value) else math.floor(100 * value + 0.5)
        late = max(0, zlib.crc32(str(click).encode()) % 30 - 23) if click is not None else 0
        dealt[min(batches - 1, q + late)].append((click, t, kind or "none", cents))
    out, state, mark = Counter(), {}, None
    hours = lambda n: timedelta(hours=n)
    for k in range(batches):
        emitted_before, fresh = {p for p, s in state.items() if s[1]}, set()
        for click, t, kind, cents in dealt[k]:
            pane = (kind, (t - EPOCH) // timedelta(hours=1))
            if mark is not None and mark >= EPOCH + hours(pane[1] + 1 + close):
                out[k, pane[1], click, 1, cents, "late", kind] += 1
                continue
            (n, c), told = state.get(pane, ((0, 0), None))
            state[pane] = ((n + 1, c + cents), told)
            fresh.add(pane)
        for (kind, hour), (now, told) in list(state.items()):
            due = mark is not None and mark >= EPOCH + hours(hour + 1 + grace)
            if (kind, hour) in emitted_before:
                if (kind, hour) in fresh:
                    out[k, hour, -1, *told, "retract", kind] += 1
                    out[k, hour, -1, *now, "replace", kind] += 1
                    state[kind, hour] = (now, now)
            elif due:
                out[k, hour, -1, *now, "emit", kind] += 1
                state[kind, hour] = (now, now)
            elif k == batches - 1:
                out[k, hour, -1, *now, "final", kind] += 1
            if mark is not None and mark >= EPOCH + hours(hour + 1 + close):
                del state[kind, hour]
        times = [t for _, t, _, _ in dealt[k]]
        mark = max([*times, *([mark] if mark else [])], default=None)
    return out


def found(df) -> Counter:
    return Counter((r["batch"], r["hour"], r["click_id"], r["n_rows"], r["cents"], r["record"], r["kind"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r[:3], 7, *r[3:], "{}", 3, "x", 9) for r in rows], SCHEMA)


def test_panes_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/clicks.parquet").select("click_id", "ts", "arrived_at", "kind", "value").collect()]
    want = simulated(rows)
    assert {x[5] for x in want} == {"late", "emit", "retract", "replace", "final"}
    assert found(P.panes(spark.read.parquet("/root/testdata/sf0.001/clicks.parquet"))) == want


def test_panes_of_odd_rows(spark):
    day = lambda d, h=0, m=0: EPOCH + timedelta(days=d, hours=h, minutes=m)
    first = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 30 <= 23]
    last = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 30 == 29]
    rows = [
        (None, day(0, 1), day(0, 2), "view", 1.005), (None, day(0, 1), day(0, 2), "view", 1.005), (first[0], None, day(3), "view", 1.0),
        (first[1], day(-5, 3), day(0), None, None), (first[2], day(0, 3), None, "none", float("nan")), (first[3], day(0, 3), day(0), "none", float("inf")),
        # batches 1 and 2 stay empty; an hour's end that the watermark just reaches, and misses by a microsecond
        (first[4], day(3, 13), day(3, 13), "a", -0.015), (first[5], day(0, 0, 30), day(4), "a", 2.5), (first[6], day(3, 0, 59), day(4), "b", 1e10),
        (first[7], day(3, 0, 10), day(4), "b", -1e10), (last[0], day(3, 0, 20), day(0), "b", 0.3), (last[1], day(5, 1) - timedelta(microseconds=1), day(3), "c", 0.07),
        (first[8], day(5, 13), day(5, 13), "late mark", 1.0), (first[9], day(3, 0, 40), day(6), "b", 4.0), (first[10], day(9, 5), day(9, 6), "z", 5.0), (first[11], day(9, 5), day(9, 6), "z", 5.0),
    ]
    assert found(P.panes(frame(spark, rows))) == simulated(rows)
    # a session's zone changes nothing, nor do hours that the clock leaves out there
    rows += [(first[20 + i], datetime(2024, 3, 31, 0, 30) + timedelta(minutes=20 * i), datetime(2024, 3, 31, 1) + timedelta(minutes=20 * i), "gap", 1.0) for i in range(12)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    with ExitStack() as after:
        after.callback(spark.conf.set, "spark.sql.session.timeZone", zone)
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert found(P.panes(frame(spark, rows + rows).repartition(3), grace=1, close=24)) == simulated(rows, grace=1, close=24)


def test_no_clicks(spark):
    assert P.panes(frame(spark, [(1, None, EPOCH, "a", 1.0)])).collect() == []


@pytest.mark.parametrize("x", [0, 1, -1, P.HOUR * 1000, -P.HOUR * 1000, -P.HOUR * 1000 - 1, 1_704_067_199_999_999])
def test_micros(spark, x):
    ts = EPOCH + timedelta(microseconds=x)
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz").select(P.micros(__import__("pyspark").sql.functions.col("ts"), False).alias("x"))
    assert df.first()["x"] == x
