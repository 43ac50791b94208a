"""Stream = batch, restart from checkpoint, idle flush."""

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sinks.current import read_snapshot
from tickloom.sources.streams import frames_stream, text_stream
from tickloom.streaming import jobs as J
from tickloom.streaming.batcher import open_batches, stream_batches
from tests.test_batching import brute

SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField("ingest_ts", T.TimestampType()),
                       T.StructField("seq", T.LongType())])


def _msg(subject, price, ms):
    return ('{"topic":"t","type":"message","subject":"%s","data":{"bestAsk":"1","bestAskSize":"1","bestBid":"1",'
            '"price":"%s","sequence":"1","size":"1","time":%d}}' % (subject, price, ms))


def _rows(n, keys=("A-USDT", "B-USDT", "C-BTC")):
    out = []
    for i in range(n):
        k = keys[i % len(keys)]
        out.append((k, 1_700_000_000_000 + i * 997 % 50_000 + i * 1000, i))
    return out


def _write(spark, path, rows):
    df = spark.createDataFrame([(_msg(k, 1.0 + i, ms), None, i) for k, ms, i in rows], SCHEMA)
    df.write.mode("append").parquet(path)


def test_stream_batcher_equals_batch_across_triggers_and_restart(spark, tmp_dir):
    rows = sorted(_rows(600), key=lambda r: r[1])
    chunks = [rows[i:i + 150] for i in range(0, 600, 150)]
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    spark.createDataFrame([], SCHEMA).write.parquet(src)

    recs = J.kucoin_records(frames_stream(spark, src, SCHEMA))
    b = stream_batches(recs, ["subject"], "ms", ["seq"], "record", size=7, timeout_ms=4000, idle_ms=None)
    for c in chunks:
        # each chunk lands whole, then the query runs and stops: every run
        # resumes offsets and open batches from the checkpoint
        _write(spark, src, c)
        q = J.start(b, ckpt, path=out, trigger={"availableNow": True})
        q.awaitTermination(120)
        q.stop()
    closed = {(r.subject, r.batch_id): r.n for r in spark.read.parquet(out).collect()}
    open_ = {(r.subject, r.batch_id): r.n for r in open_batches(spark, ckpt, ["subject"]).collect()}
    expected = {}
    for rid, (k, b) in brute(rows, 7, 4000).items():
        expected[(k, b)] = expected.get((k, b), 0) + 1
    assert {**closed, **open_} == expected
    assert not set(closed) & set(open_)


def test_idle_batches_flush_on_processing_time_timeout(spark, tmp_dir):
    src, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/ckpt"
    spark.createDataFrame([], SCHEMA).write.parquet(src)
    _write(spark, src, [("A-USDT", 1000, 0), ("A-USDT", 1001, 1)])
    recs = J.kucoin_records(frames_stream(spark, src, SCHEMA))
    b = stream_batches(recs, ["subject"], "ms", ["seq"], "record", size=10, timeout_ms=10**9, idle_ms=200)
    q = (b.writeStream.format("memory").queryName("idle_flush").outputMode("append")
         .option("checkpointLocation", ckpt).trigger(processingTime="200 milliseconds").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("idle_flush").count() == 0:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = spark.table("idle_flush").collect()
    assert [(r.n, r.closed_by) for r in rows] == [(2, "idle")]


def test_batch_ids_go_on_after_idle_flushes(spark, tmp_dir):
    src, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/ckpt"
    spark.createDataFrame([], SCHEMA).write.parquet(src)
    recs = J.kucoin_records(frames_stream(spark, src, SCHEMA))
    b = stream_batches(recs, ["subject"], "ms", ["seq"], "record", size=10, timeout_ms=10**9, idle_ms=200)
    q = (b.writeStream.format("memory").queryName("idle_ids").outputMode("append")
         .option("checkpointLocation", ckpt).trigger(processingTime="200 milliseconds").start())
    try:
        for i in range(2):
            _write(spark, src, [("A-USDT", 1000 + i, i)])
            deadline = time.time() + 60
            while time.time() < deadline and spark.table("idle_ids").count() <= i:
                time.sleep(0.3)
    finally:
        q.stop()
    assert sorted(r.batch_id for r in spark.table("idle_ids").collect()) == [0, 1]


def test_rejects_account_for_every_row(spark, tmp_dir):
    """Rows in = ticks + rejects + control frames + other quotes, in the normalisation job."""
    import json as _json
    import os
    os.makedirs(f"{tmp_dir}/k")
    lines = [_msg("A-USDT", 1.5, 1000), _msg("B-BTC", 2.0, 2000), "not json", '{"type":"welcome"}', _msg("C-USDC", "abc", 3000),
             _msg("D-USDT", 4.0, 1000).replace('"bestAsk":"1",', ""), '{"type":"ack"']
    with open(f"{tmp_dir}/k/m.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    qs = J.start_normalization(spark, {"kucoin": text_stream(spark, f"{tmp_dir}/k")}, f"{tmp_dir}/ckpt",
                               text_root=f"{tmp_dir}/out", rejects_root=f"{tmp_dir}/rejects", trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination(120)
    ticks = sum(len(_json.loads(r.value)) for r in spark.read.text(f"{tmp_dir}/out/kucoin").collect())
    rejects = spark.read.json(f"{tmp_dir}/rejects/kucoin").collect()
    assert sorted(r.reason for r in rejects) == ["bad:price", "malformed", "malformed", "missing:data.bestAsk"]
    assert all(r.raw in lines for r in rejects)
    assert len(lines) == ticks + len(rejects) + 1 + 1


def test_run_all_stops_the_others(spark, tmp_dir):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_dir}/in")
    frames = frames_stream(spark, f"{tmp_dir}/in", SCHEMA)
    qs = [J.start(frames, f"{tmp_dir}/c{i}", path=f"{tmp_dir}/o{i}", trigger=t)
          for i, t in enumerate(({"availableNow": True}, {"processingTime": "1 second"}))]
    J.run_all(spark, qs, timeout_s=60)
    assert not any(q.isActive for q in qs)


def test_current_price_foreach_batch_is_idempotent(spark, tmp_dir):
    from tickloom.sinks.current import upsert_batch
    rows = [("A-USDT", 1.0, 1000, 0), ("A-USDT", 2.0, 3000, 1), ("B-USDC", 5.0, 2000, 2)]
    frames = spark.createDataFrame([(_msg(k, p, ms), None, i) for k, p, ms, i in rows], SCHEMA)
    ticks = J.kucoin_ticks(frames)
    upsert_batch(ticks, 0, f"{tmp_dir}/snap")
    upsert_batch(ticks, 0, f"{tmp_dir}/snap")           # replayed batch id rewrites the same folder
    late = spark.createDataFrame([(_msg("A-USDT", 9.0, 2000), None, 3)], SCHEMA)
    upsert_batch(J.kucoin_ticks(late), 1, f"{tmp_dir}/snap")
    snap = {r.symbol: r.price for r in read_snapshot(spark, f"{tmp_dir}/snap").collect()}
    assert snap == {"AUSDT": 2.0, "BUSDC": 5.0}


def test_text_source_tee(spark, tmp_dir):
    src = f"{tmp_dir}/txt"
    import os
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write(_msg("A-USDT", 1.5, 1000) + "\n" + '{"type":"welcome"}' + "\n")
    ticks = J.kucoin_ticks(text_stream(spark, src).withColumn("seq", F.lit(0).cast("long")))
    seen = []
    q = J.start_tee(ticks.drop("created_at"), [
        lambda d, bid: d.write.mode("append").parquet(f"{tmp_dir}/a"),
        lambda d, bid: seen.append((bid, d.count()))], f"{tmp_dir}/ckpt", trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 1
    assert sum(n for _, n in seen) == 1


def test_ingestion_job_tees_batches_and_landing(spark, tmp_dir):
    """Entry 1: Kucoin batches + Binance frames to the raw 'topic' (text
    fallback) and both feeds to the landing zone, in one streaming run."""
    import json as _json
    from tickloom.sources.landing import replay_ingest
    kin, bin_ = f"{tmp_dir}/k", f"{tmp_dir}/b"
    rows = [(_msg("A-USDT", 1.0 + i, 1_700_000_000_000 + i * 100), None, i) for i in range(7)]
    spark.createDataFrame(rows, SCHEMA).withColumn("ingest_ts", F.timestamp_millis(F.lit(1_700_000_000_000))) \
        .write.parquet(kin)
    frame = _json.dumps([{"e": "24hrMiniTicker", "E": 1_700_000_000_000, "s": "AUSDT", "c": "1", "o": "1",
                          "h": "1", "l": "1", "v": "1", "q": "1"}, {"e": "x", "E": 1}])
    spark.createDataFrame([(frame, None, 0)], SCHEMA) \
        .withColumn("ingest_ts", F.timestamp_millis(F.lit(1_700_000_000_000))).write.parquet(bin_)
    qs = J.start_ingestion(spark, frames_stream(spark, kin, SCHEMA), frames_stream(spark, bin_, SCHEMA),
                           f"{tmp_dir}/landing", f"{tmp_dir}/ckpt", text_root=f"{tmp_dir}/raw",
                           size=3, timeout_ms=10**9, trigger={"availableNow": True}, idle_ms=None)
    try:
        for q in qs:
            q.awaitTermination(120)
    finally:
        for q in qs:
            q.stop()
    k_msgs = [_json.loads(r.value) for r in spark.read.text(f"{tmp_dir}/raw/kucoin").collect()]
    assert sorted(len(m) for m in k_msgs) == [3, 3]           # the residual 1 stays open in state
    b_msgs = [_json.loads(r.value) for r in spark.read.text(f"{tmp_dir}/raw/binance").collect()]
    assert b_msgs == [[{"e": "24hrMiniTicker", "E": 1_700_000_000_000, "s": "AUSDT", "c": "1", "o": "1",
                        "h": "1", "l": "1", "v": "1", "q": "1"}]]
    landed = replay_ingest(spark, f"{tmp_dir}/landing", "kucoin", "2023-11-14 22:00:00", "2023-11-14 23:00:00")
    assert landed.count() == 7


def test_normalization_job_raw_to_transformed(spark, tmp_dir):
    """Entry 2: raw messages (a Kucoin batch array, a Binance frame) -> JSON ticks."""
    import json as _json
    import os
    os.makedirs(f"{tmp_dir}/k")
    os.makedirs(f"{tmp_dir}/b")
    with open(f"{tmp_dir}/k/m.txt", "w") as f:
        f.write("[" + _msg("A-USDT", 1.5, 1000) + "," + _msg("B-BTC", 2.0, 2000) + "]\n")
    with open(f"{tmp_dir}/b/m.txt", "w") as f:
        f.write(_json.dumps([{"e": "x", "E": 3000, "s": "CUSDC", "c": "4.25", "o": "1", "h": "1", "l": "1",
                              "v": "1", "q": "1"}]) + "\n")
    raw = {"kucoin": text_stream(spark, f"{tmp_dir}/k"), "binance": text_stream(spark, f"{tmp_dir}/b")}
    qs = J.start_normalization(spark, raw, f"{tmp_dir}/ckpt", text_root=f"{tmp_dir}/out",
                               trigger={"availableNow": True})
    try:
        for q in qs:
            q.awaitTermination(120)
    finally:
        for q in qs:
            q.stop()
    got = sorted((t["symbol"], t["price"], t["time"])
                 for s in ("kucoin", "binance") for r in spark.read.text(f"{tmp_dir}/out/{s}").collect()
                 for t in _json.loads(r.value))
    assert got == [("AUSDT", 1.5, "1970-01-01T00:00:01.000000"), ("CUSDC", 4.25, "1970-01-01T00:00:03.000000")]


def test_bounded_poll_max_files_per_trigger(spark, tmp_dir):
    """At most one file per micro-batch."""
    src = f"{tmp_dir}/in"
    for i in range(3):
        spark.createDataFrame([(_msg("A-USDT", 1.0, 1000 + i), None, i)], SCHEMA).write.mode("append").parquet(src)
    ticks = J.kucoin_ticks(frames_stream(spark, src, SCHEMA, max_files_per_trigger=1))
    q = J.start(ticks.drop("created_at"), f"{tmp_dir}/ckpt", path=f"{tmp_dir}/out", trigger={"availableNow": True})
    q.awaitTermination(120)
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes == [1, 1, 1]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["A-USDT", "B-USDT"]), st.integers(0, 9)), min_size=3, max_size=40),
       st.integers(1, 5), st.integers(0, 12), st.integers(1, 4))
def test_property_stream_equals_batch(spark, pairs, size, timeout, n_chunks):
    """Random data, random trigger splits (time ordered): closed + open
    batches of the streaming fold equal the reference fold."""
    import tempfile
    tmp = tempfile.mkdtemp(prefix="tickloom-prop-")
    t, rows = 0, []
    for i, (k, gap) in enumerate(pairs):
        t += gap
        rows.append((k, 1_700_000_000_000 + t, i))
    cut = sorted({0, len(rows), *[len(rows) * j // n_chunks for j in range(1, n_chunks)]})
    src, out, ckpt = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt"
    spark.createDataFrame([], SCHEMA).write.parquet(src)
    recs = J.kucoin_records(frames_stream(spark, src, SCHEMA))
    b = stream_batches(recs, ["subject"], "ms", ["seq"], "record", size=size, timeout_ms=timeout, idle_ms=None)
    for lo, hi in zip(cut[:-1], cut[1:]):
        _write(spark, src, rows[lo:hi])                 # the chunk lands whole, then one run
        q = J.start(b, ckpt, path=out, trigger={"availableNow": True})
        q.awaitTermination(120)
        q.stop()
    closed = [(r.subject, r.batch_id, r.n) for r in spark.read.schema(b.schema).parquet(out).collect()]
    open_ = [(r.subject, r.batch_id, r.n) for r in open_batches(spark, ckpt, ["subject"]).collect()]
    expected = {}
    for rid, (k, bb) in brute(rows, size, timeout).items():
        expected[(k, bb)] = expected.get((k, bb), 0) + 1
    got = {(k, bb): n for k, bb, n in closed + open_}
    assert got == expected and len(closed) + len(open_) == len(expected)


def test_slices_come_from_one_pass_over_their_source(spark, tmp_path):
    """Each row arrives in its slice, is worked out once, and one without a number in none."""
    from tickloom.plans.streams import _in_slices
    seen = spark.sparkContext.accumulator(0)

    def work(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(100).mapInArrow(work, "id long")
    number = F.when(F.col("id") > 0, (F.col("id") >= 30).cast("int") + (F.col("id") >= 70).cast("int"))
    got, arrived = [], set()
    for i in _in_slices(spark, str(tmp_path), rows, number, 3):
        now = {r[0] for r in spark.read.schema("id long").parquet(f"{tmp_path}/in").collect()}
        got.append((i, min(now - arrived), max(now - arrived), len(now)))
        arrived = now
    assert got == [(0, 1, 29, 29), (1, 30, 69, 69), (2, 70, 99, 99)]
    assert seen.value == 100
