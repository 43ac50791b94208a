"""A1 (exact, hot-key safe) against a brute-force fold; A5; A3/A4."""

import random

import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions.scalar import ts_to_millis
from tickloom.operators.batching import assign_aligned, assign_batches, batch_messages, batch_stats
from tests.conftest import SF01


def brute(rows, size, timeout):
    """The reference's batcher, record by record (rows sorted by key, ms, id)."""
    out, cur = {}, {}
    for key, ms, rid in sorted(rows):
        bid, n, st_ = cur.get(key, (-1, 0, None))
        if n == 0:
            bid, st_ = bid + 1, ms
        n += 1
        out[rid] = (key, bid)
        if n >= size or ms - st_ >= timeout:
            n = 0
        cur[key] = (bid, n, st_)
    return out


def run(spark, rows, size, timeout, parts):
    df = spark.createDataFrame(rows, "k string, ms long, id long")
    tagged = assign_batches(df, ["k"], "ms", ["id"], size=size, timeout_ms=timeout, partitions=parts)
    return {r.id: (r.k, r.batch_id) for r in tagged.collect()}


@pytest.mark.parametrize("size,timeout,parts", [
    (10, 4 * 3600 * 1000, 8), (10, 4 * 3600 * 1000, 37), (3, 600_000, 211), (1, 1000, 5),
    (7, 0, 9), (50, 10**12, 16), (2, 1, 64)])
def test_events_match_brute_force(spark, size, timeout, parts):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select(
        "event_type", ts_to_millis("ts").alias("ms"), "event_id")
    rows = [tuple(r) for r in ev.collect()]
    assert run(spark, rows, size, timeout, parts) == brute(rows, size, timeout)


def test_single_hot_key_spans_all_partitions(spark):
    rnd = random.Random(7)
    rows, t = [], 0
    for i in range(3000):
        t += rnd.choice([1, 1, 2, 50, 400])
        rows.append(("HOT", t, i))
    rows += [("cold", 5 * i, 10_000 + i) for i in range(20)]
    got = run(spark, rows, 9, 300, 24)
    assert got == brute(rows, 9, 300)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 60)), min_size=1, max_size=60),
       st.integers(1, 6), st.integers(0, 25), st.integers(1, 13))
def test_property_random_inputs(spark, pairs, size, timeout, parts):
    rows = [(k, ms, i) for i, (k, ms) in enumerate(pairs)]
    assert run(spark, rows, size, timeout, parts) == brute(rows, size, timeout)


def test_batch_stats_and_messages(spark):
    rows = [("k", 0, 0), ("k", 1, 1), ("k", 2, 2), ("k", 100, 3)]
    df = spark.createDataFrame(rows, "k string, ms long, id long").withColumn("src", F.lit("kucoin"))
    tagged = assign_batches(df, ["k"], "ms", ["id"], size=2, timeout_ms=1000, partitions=2)
    stats = {r.batch_id: (r.n, r.first_ms, r.last_ms) for r in batch_stats(tagged, ["k"], "ms").collect()}
    assert stats == {0: (2, 0, 1), 1: (2, 2, 100)}
    msgs = batch_messages(tagged, ["k"], ["batch_id"], F.struct("id", "ms"), ["ms", "id"],
                          {"first_src": "src", "first_ms": "ms"}).orderBy("batch_id").collect()
    assert msgs[0].message == '[{"id":0,"ms":0},{"id":1,"ms":1}]'
    assert msgs[1].first_ms == 2 and msgs[1].first_src == "kucoin" and msgs[1].n == 2


def test_aligned_windows(spark):
    rows = [("k", "2024-01-01 00:00:59", 0), ("k", "2024-01-01 00:01:00", 1), ("k", "2024-01-01 00:01:01", 2)]
    df = (spark.createDataFrame(rows, "k string, t string, id long")
          .withColumn("ts", F.to_timestamp("t")).withColumn("ms", ts_to_millis("ts")))
    out = assign_aligned(df, ["k"], "ts", "ms", ["id"], "60 seconds", size=1).collect()
    got = sorted((r.id, str(r.window_start), r.chunk) for r in out)
    assert got == [(0, "2024-01-01 00:00:00", 0), (1, "2024-01-01 00:01:00", 0), (2, "2024-01-01 00:01:00", 1)]


def test_null_time_rows_are_kept(spark):
    rows = [("k", 1, 0), ("k", None, 1), ("k", 2, 2)]
    df = spark.createDataFrame(rows, "k string, ms long, id long")
    got = {r.id: r.batch_id for r in assign_batches(df, ["k"], "ms", ["id"], size=2, timeout_ms=10, partitions=2).collect()}
    assert got == {0: 0, 1: None, 2: 0}


@pytest.mark.parametrize("arrow_rows", [3, 7])
def test_tiny_arrow_batches_carry_state_across_chunks(spark, arrow_rows):
    """Both Arrow passes stream over batches; force batch boundaries inside
    segments so the carried fold state is exercised."""
    rnd = random.Random(arrow_rows)
    rows, t = [], 0
    for i in range(900):
        t += rnd.choice([0, 1, 3, 40])
        rows.append((rnd.choice(["HOT", "HOT", "HOT", "x", "y"]), t, i))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_rows))
    try:
        for size, timeout, parts in [(5, 60, 7), (2, 3, 13), (9, 1000, 3)]:
            assert run(spark, rows, size, timeout, parts) == brute(rows, size, timeout)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_too_many_partitions_are_refused(spark, monkeypatch):
    import tickloom.operators.batching as B
    monkeypatch.setattr(B, "MAX_BROADCAST_PARTITIONS", 10)
    with pytest.raises(ValueError):
        run(spark, [("k", 1, 1)], 4, 25, 11)


@pytest.mark.parametrize("arrow_rows", [3, 10_000])
def test_time_only_batches_of_any_size(spark, arrow_rows):
    """The reference's object batcher: a size that is never reached, 60 s."""
    rnd = random.Random(8)
    rows, t = [], 0
    for i in range(2000):
        t += rnd.choice([0, 1, 500, 9000, 70_000])
        rows.append((rnd.choice(["HOT", "HOT", "a"]), t, i))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_rows))
    try:
        for parts in (1, 7, 40):
            assert run(spark, rows, 99_999_999, 60_000, parts) == brute(rows, 99_999_999, 60_000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_transfer_table_does_not_grow_with_size():
    """Every possible offset's outcome, from few runs, chunk by chunk."""
    import numpy as np
    from tickloom.operators.batching import _Candidates, _Fold
    r = np.random.default_rng(1)
    for size, timeout in [(4, 30), (50, 30), (10**8, 30), (7, 10**9), (3, 0), (10**8, 300)]:
        t = np.cumsum(r.integers(0, 9, 400))
        table = _Candidates(size, timeout)
        for at in range(0, 400, 37):
            table.feed(t[at:at + 37])
        offsets, cnt, n, st_ = table.table()
        assert len(offsets) <= 300
        close = min(size - 1, int(np.searchsorted(t, t[0] + timeout)))
        for e in range(min(400, close + 2, size)):
            fold = _Fold(skip=e)
            fold.feed(t, size, timeout)
            k = int(np.searchsorted(offsets, e, side="right")) - 1
            assert (cnt[k], n[k], st_[k]) == (fold.cnt, fold.n, fold.st), (size, timeout, e)


def test_multi_column_keys(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice(["kucoin", "binance"]), rnd.randint(0, 3), rnd.randint(0, 300), i) for i in range(700)]
    df = spark.createDataFrame(rows, "src string, sym long, ms long, id long")
    tagged = assign_batches(df, ["src", "sym"], "ms", ["id"], size=4, timeout_ms=20, partitions=9)
    got = {r.id: ((r.src, r.sym), r.batch_id) for r in tagged.collect()}
    assert got == brute([((s, k), ms, i) for s, k, ms, i in rows], 4, 20)


@pytest.mark.parametrize("block,super_block", [(2, 2), (3, 512), (2, 3)])
def test_blocked_stitch_matches(spark, monkeypatch, block, super_block):
    """A hot key's boundary chain stitched in blocks of 2-3 partitions, the
    blocks composed in super-blocks of 2-3."""
    import tickloom.operators.batching as B
    monkeypatch.setattr(B, "STITCH_BLOCK", block)
    monkeypatch.setattr(B, "SUPER_BLOCK", super_block)
    rnd = random.Random(block)
    rows, t = [], 0
    for i in range(1500):
        t += rnd.choice([0, 1, 2, 30])
        rows.append((rnd.choice(["HOT", "HOT", "HOT", "a", "b"]), t, i))
    for size, timeout, parts in [(6, 40, 29), (3, 5, 61), (1, 1, 17), (40, 10**6, 23), (40, 10**6, 61), (30, 50, 97)]:
        assert run(spark, rows, size, timeout, parts) == brute(rows, size, timeout)


def test_exact_size_and_exact_timeout_close_inclusively(spark):
    # size 3: rows 0-2 close by count; then a record exactly `timeout` after
    # the batch start closes its batch and belongs to it; the residual is emitted.
    rows = [("k", 0, 0), ("k", 1, 1), ("k", 2, 2), ("k", 10, 3), ("k", 110, 4), ("k", 111, 5)]
    got = run(spark, rows, 3, 100, 2)
    assert got == {0: ("k", 0), 1: ("k", 0), 2: ("k", 0), 3: ("k", 1), 4: ("k", 1), 5: ("k", 2)}


def test_time_column_must_be_epoch_millis(spark):
    df = spark.createDataFrame([("k", 1)], "k string, ms long").withColumn("ts", F.current_timestamp())
    with pytest.raises(TypeError):
        assign_batches(df, ["k"], "ts", size=2, timeout_ms=10)


def test_scale_hot_key_many_chunks_and_blocks(spark, monkeypatch):
    """200k rows, one key holding ~70% of them, 64 ranges, 1,000-row Arrow
    batches and stitch blocks of 4 partitions: equal to the reference fold."""
    import tickloom.operators.batching as B
    monkeypatch.setattr(B, "STITCH_BLOCK", 4)
    monkeypatch.setattr(B, "SUPER_BLOCK", 3)
    rnd = random.Random(2024)
    rows, t = [], 0
    for i in range(200_000):
        t += rnd.choice([0, 1, 1, 2, 5, 80])
        rows.append(("HOT" if rnd.random() < 0.7 else f"k{rnd.randint(0, 40)}", t, i))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        df = spark.createDataFrame(rows, "k string, ms long, id long").repartition(16)
        tagged = assign_batches(df, ["k"], "ms", ["id"], size=25, timeout_ms=300, partitions=64)
        got = {r.id: (r.k, r.batch_id) for r in tagged.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == brute(rows, 25, 300)
