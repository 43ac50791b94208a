"""Batches closed by size, time or silence, on a clock that the records carry."""

import random

from tickloom.streaming import idle_batcher as IB

SIZE, TIMEOUT, IDLE = 4, 450, 300


def _brute(rows, size=SIZE, timeout=TIMEOUT, idle=IDLE):
    clock = max(t for _, t, _ in rows)
    out, by_key = [], {}
    for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        by_key.setdefault(k, []).append((t, i))
    for k, seen in by_key.items():
        bid, held = 0, []

        def close(why):
            nonlocal bid, held
            out.append((str(k), bid, [i for _, i in held], held[0][0], held[-1][0], why))
            bid, held = bid + 1, []

        for t, i in seen:
            if held and t - held[-1][0] > idle:
                close("idle")
            held.append((t, i))
            if len(held) >= size:
                close("size")
            elif t - held[0][0] >= timeout:
                close("time")
        if held:
            close("idle" if clock - held[-1][0] > idle else None)
    return sorted(out, key=str)


def _run(spark, root, slices, size=SIZE):
    """Each slice is one run of the query over what has arrived."""
    frame = None
    for rows in slices:
        df = spark.createDataFrame([(k, t, i, str(i)) for k, t, i in rows], "key string, ms long, seq long, record string")
        df = df.selectExpr("key", "timestamp_millis(ms) as at", "seq", "record")
        df.repartition(3).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
        frame = IB.idle_batches(stream, ["key"], "at", ["seq"], "record", size, TIMEOUT, IDLE)
        q = (frame.writeStream.option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True)
             .format("parquet").option("path", f"{root}/out").start())
        q.awaitTermination()
    closed = [(str(r.key), r.batch_id, [int(x) for x in r.message.strip("[]").split(",")], r.first_ms, r.last_ms, r.closed_by)
              for r in spark.read.schema(frame.schema).parquet(f"{root}/out").collect()]
    return closed, [(str(r.key), r.batch_id, r.n, r.first_ms, r.last_ms) for r in IB.open_batches(spark, f"{root}/ckpt", ["key"]).collect()]


def _rows(n=500):
    r, t, rows = random.Random(4), 1_000_000, []
    for i in range(n):
        t += r.choice([0, 1, 20, 90, 200])
        rows.append((r.choice(["hot"] * 6 + ["a", "b", "c", None]), t, i))
    return rows


def test_batches_do_not_depend_on_the_slices(spark, tmp_dir):
    rows = _rows()
    want = _brute(rows)
    assert {w[-1] for w in want} >= {"size", "time", "idle"}
    for name, cuts in {"one": [0, len(rows)], "four": [0, 3, 200, 420, len(rows)]}.items():
        closed, still = _run(spark, f"{tmp_dir}/{name}", [rows[a:b] for a, b in zip(cuts, cuts[1:])])
        assert sorted(closed, key=str) == [w for w in want if w[-1]]
        assert sorted(still) == sorted((k, b, len(ids), f, la) for k, b, ids, f, la, why in want if why is None)


def test_timers_close_a_key_that_never_comes_back(spark, tmp_dir):
    slices = [[("a", 1000, 0), ("b", 1000, 1)], [("b", 1300, 2)], [("b", 1301, 3)]]
    closed, still = _run(spark, tmp_dir, slices)
    # a silence of exactly IDLE is none; one more millisecond is
    assert closed == [("a", 0, [0], 1000, 1000, "idle")] and still == [("b", 0, 3, 1000, 1301)]


def test_late_rows_are_kept(spark, tmp_dir):
    """Behind the watermark: one joins its key's open batch, one has no open batch
    and its silence is over; both are in a batch."""
    slices = [[("a", 5000, 0)], [("a", 4900, 1), ("b", 1000, 2)], [("a", 5100, 3)]]
    closed, still = _run(spark, tmp_dir, slices)
    assert closed == [("b", 0, [2], 1000, 1000, "idle")] and still == [("a", 0, 3, 5000, 5100)]


def test_rows_without_a_time_and_empty_slices(spark, tmp_dir):
    closed, still = _run(spark, tmp_dir, [[], [("a", None, 0), ("a", 10, 1)], []])
    assert closed == [] and still == [("a", 0, 1, 10, 10)]
