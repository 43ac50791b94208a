"""The hot-key streaming batcher against the bounded one."""

import random

from pyspark.sql import functions as F

from tickloom.operators import batching as B
from tickloom.streaming import hot_batcher as HB

SCHEMA = "key string, ms long, seq long, note string"


def _rows(n=900):
    r, t, rows = random.Random(9), 0, []
    for i in range(n):
        t += r.choice([0, 0, 1, 5, 40, 400])
        rows.append((r.choice(["hot"] * 6 + ["a", "b", None]), t, i, "n"))
    rows += [("late", t + i, n + i, "n") for i in range(7)]
    return rows


def _stats(df):
    return sorted((str(r.key), r.batch_id, r.n, r.first_ms, r.last_ms) for r in df.collect())


def test_triggers_give_what_one_fold_gives(spark, tmp_dir):
    rows = _rows()
    cuts = [0, 200, 201, 650, len(rows)]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = spark.createDataFrame(rows[a:b], SCHEMA).repartition(3)
        HB.fold_trigger(part, n, tmp_dir, ["key"], "ms", ["seq"], 5, 300)
        if n == 2:                          # a trigger that runs again changes nothing
            HB.fold_trigger(part, n, tmp_dir, ["key"], "ms", ["seq"], 5, 300)
    want = B.batch_stats(B.assign_batches(spark.createDataFrame(rows, SCHEMA), ["key"], "ms", ["seq"], 5, 300), ["key"], "ms")
    closed, still = HB.closed_batches(spark, tmp_dir), HB.open_batches(spark, tmp_dir, ["key"], "ms")
    assert _stats(closed.unionByName(still)) == _stats(want)
    assert still.where(F.col("n") >= 5).count() == 0 and still.groupBy("key").count().where("count > 1").count() == 0


def test_state_is_the_open_rows_and_next_ids_only(spark, tmp_dir):
    import os
    rows = _rows(300)
    for n in range(3):
        HB.fold_trigger(spark.createDataFrame(rows[100 * n:100 * n + 100], SCHEMA), n, tmp_dir, ["key"], "ms", ["seq"], 5, 300)
    assert sorted(os.listdir(f"{tmp_dir}/state")) == ["1", "2"] and os.listdir(f"{tmp_dir}/work") == []
    keys = len({r[0] for r in rows[:300]})
    assert spark.read.parquet(f"{tmp_dir}/state/2/open").count() <= 4 * keys
    assert spark.read.parquet(f"{tmp_dir}/state/2/next").count() == keys


def test_rows_without_a_time_and_empty_triggers(spark, tmp_dir):
    parts = [[("a", 1, 0, "x"), ("a", None, 1, "x")], [], [("a", 2, 2, "x"), (None, None, 3, "x")]]
    for n, part in enumerate(parts):
        HB.fold_trigger(spark.createDataFrame(part, SCHEMA), n, tmp_dir, ["key"], "ms", ["seq"], 2, 300)
    assert _stats(HB.closed_batches(spark, tmp_dir)) == [("a", 0, 2, 1, 2)]
    assert HB.open_batches(spark, tmp_dir, ["key"], "ms").count() == 0
    assert spark.read.parquet(*[f"{tmp_dir}/untimed/{n}" for n in range(3)]).count() == 2


def test_late_rows_join_the_open_batch_only(spark, tmp_dir):
    for n, part in enumerate([[("a", t, t, "x") for t in (10, 20, 30)], [("a", 5, 50, "x")], [("a", 40, 60, "x")]]):
        HB.fold_trigger(spark.createDataFrame(part, SCHEMA), n, tmp_dir, ["key"], "ms", ["seq"], 2, 1000)
    assert _stats(HB.closed_batches(spark, tmp_dir)) == [("a", 0, 2, 10, 20), ("a", 1, 2, 5, 30)]
    assert _stats(HB.open_batches(spark, tmp_dir, ["key"], "ms")) == [("a", 2, 1, 40, 40)]
