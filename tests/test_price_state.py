"""Current prices in keyed state: what a trigger costs, and late ticks."""

import os

from pyspark.sql import functions as F

from tickloom.operators.latest import latest_by_key
from tickloom.streaming import price_state as PS

SCHEMA = "source string, symbol string, price double, time timestamp, seq long, pos long"


def _ticks(spark, rows):
    return spark.createDataFrame([(s, y, p, t, q) for s, y, p, t, q in rows],
                                 "source string, symbol string, price double, ms long, seq long").select(
        "source", "symbol", "price", F.timestamp_millis("ms").alias("time"), "seq", F.lit(0).cast("long").alias("pos"))


def _feed(spark, root, rows):
    _ticks(spark, rows).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
    q = PS.start_price_state(stream, f"{root}/ckpt", f"{root}/changes", trigger={"availableNow": True})
    q.awaitTermination()


def _bytes(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(f"{root}/ckpt/state") for f in files)


def _table(df):
    return sorted((str(r.source), str(r.symbol), r.price, r.seq) for r in df.collect())


def test_a_trigger_costs_its_changed_keys(spark, tmp_dir):
    first = [("kucoin", f"S{i}", float(i), 1000, i) for i in range(20_000)]
    _feed(spark, tmp_dir, first)
    whole = _bytes(tmp_dir)
    second = [("kucoin", "S3", 9.0, 2000, 20_000), ("kucoin", "S4", 8.0, 500, 20_001), ("kucoin", "new", 1.0, 10, 20_002)]
    _feed(spark, tmp_dir, second)
    assert _bytes(tmp_dir) - whole < whole / 10
    assert PS.changes(spark, f"{tmp_dir}/changes", since=0).count() == 3
    want = latest_by_key(_ticks(spark, first + second), ["source", "symbol"], ["time", "seq"], ["price", "seq"])
    assert _table(PS.read_prices(spark, f"{tmp_dir}/ckpt")) == _table(want)
    # the table as it was before
    assert _table(PS.read_prices(spark, f"{tmp_dir}/ckpt", trigger=0)) == _table(_ticks(spark, first))


def test_late_ticks_ties_and_nulls(spark, tmp_dir):
    _feed(spark, tmp_dir, [("k", "A", 1.0, 100, 1), ("k", "A", 2.0, 100, 2), (None, "A", 3.0, 5, 3), ("k", None, 4.0, None, 4)])
    _feed(spark, tmp_dir, [])
    _feed(spark, tmp_dir, [("k", "A", 7.0, 99, 9), ("k", "A", 7.0, 100, 0), (None, "A", 5.0, None, 8), ("k", None, 6.0, 0, 1)])
    assert _table(PS.read_prices(spark, f"{tmp_dir}/ckpt")) == [("None", "A", 3.0, 3), ("k", "A", 2.0, 2), ("k", "None", 6.0, 1)]


def test_changes_folded_by_trigger_give_the_table(spark, tmp_dir):
    for n in range(3):
        _feed(spark, tmp_dir, [("k", f"S{i % (5 + n)}", float(10 * n + i), 100 * n + i, 10 * n + i) for i in range(10)])
    assert PS.changes(spark, f"{tmp_dir}/none") is None
    log = PS.changes(spark, f"{tmp_dir}/changes")
    newest = latest_by_key(log, ["source", "symbol"], ["trigger"], ["price", "seq"])
    assert _table(newest) == _table(PS.read_prices(spark, f"{tmp_dir}/ckpt"))
