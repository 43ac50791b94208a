"""Price history: intervals and prices at instants, merged out of order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.sinks import history as H

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "source string, symbol string, price double, time timestamp, seq long, pos long"


def _rows():
    r = random.Random(8)
    rows = [(r.choice(["x", "y"]), r.choice(["A", "B"]), float(i), BASE + dt.timedelta(hours=r.randint(0, 300)), i, 0)
            for i in range(300)]
    return rows + [("x", "C", 1.0, BASE + dt.timedelta(days=9), 900, 0), ("x", "A", 5.0, None, 901, 0)]


def _merge(spark, rows, root):
    r = random.Random(1)
    rows = list(rows)
    r.shuffle(rows)
    for k in range(3):
        H.merge_history(spark.createDataFrame(rows[k::3], SCHEMA), root)
    H.merge_history(spark.createDataFrame(rows[::3], SCHEMA), root)             # merged twice


def _points(rows):
    best = {}
    for s, y, p, t, seq, _ in rows:
        if t is not None and (s, y, t) not in best or t is not None and best[s, y, t][0] < seq:
            best[s, y, t] = (seq, p)
    return best


def test_prices_at_instants_equal_a_walk(spark, tmp_dir):
    rows = _rows()
    _merge(spark, rows, tmp_dir)
    at = [BASE - dt.timedelta(days=1), BASE, BASE + dt.timedelta(hours=30), BASE + dt.timedelta(days=9),
          BASE + dt.timedelta(days=9, seconds=-1), BASE + dt.timedelta(days=40)]
    got = {(r["at"], r.source, r.symbol): (r.price, r.time) for r in H.price_at(
        spark, tmp_dir, spark.createDataFrame([(a,) for a in [*at, at[1], None]], "at timestamp")).collect()}
    want = {}
    for a in at:
        for (s, y, t), (_, p) in sorted(_points(rows).items(), key=lambda x: x[0][2]):
            if t <= a:
                want[a, s, y] = (p, t)
    assert got == want


def test_intervals_follow_each_other_and_a_late_tick_splits_one(spark, tmp_dir):
    t = [BASE + dt.timedelta(hours=h) for h in (1, 50, 51)]
    H.merge_history(spark.createDataFrame([("x", "A", 1.0, t[0], 1, 0), ("x", "A", 3.0, t[2], 2, 0)], SCHEMA), tmp_dir)
    read = lambda: sorted((r.price, r.valid_from, r.valid_to) for r in H.intervals(spark, tmp_dir).collect())
    assert read() == [(1.0, t[0], t[2]), (3.0, t[2], None)]
    H.merge_history(spark.createDataFrame([("x", "A", 2.0, t[1], 3, 0)], SCHEMA), tmp_dir)
    assert read() == [(1.0, t[0], t[1]), (2.0, t[1], t[2]), (3.0, t[2], None)]
    H.merge_history(spark.createDataFrame([("x", "A", 9.0, t[1], 2, 0), ("x", "A", 4.0, t[1], 4, 0)], SCHEMA), tmp_dir)
    assert read()[1] in [(3.0, t[2], None)] and (4.0, t[1], t[2]) in read()


def test_nothing_merged(spark, tmp_dir):
    at = spark.createDataFrame([(BASE,)], "at timestamp")
    assert H.price_at(spark, tmp_dir, at).count() == 0 and H.intervals(spark, tmp_dir).count() == 0
    many = spark.range(H.MAX_INSTANTS + 1).select(F.timestamp_millis("id").alias("at"))
    with pytest.raises(ValueError):
        H.price_at(spark, tmp_dir, many)
