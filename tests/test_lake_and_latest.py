"""Keys (F7-F10), landing/replay (K5, K6, S9, S10), last-value operators (A8, A9), sinks."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalar as S
from tickloom.operators import latest as L
from tickloom.sinks import files as FS
from tickloom.sinks import kafka as K
from tickloom.sinks import landing as LZ
from tickloom.sources import landing as RP


def test_object_and_hourly_keys(spark):
    df = spark.createDataFrame([("kucoin", dt.datetime(2025, 5, 7, 15, 4, 5, 999000))], "source string, ts timestamp")
    r = df.select(S.object_name(F.col("source"), F.col("ts")).alias("o"),
                  S.hourly_key(F.col("source"), F.col("ts")).alias("h")).first()
    assert r.o == "kucoin/2025-05-07T15-04-05.json"
    assert r.h == "raw/kucoin/2025/05/07/15/data_20250507T15.json.gz"


@pytest.mark.parametrize("path,expected", [
    ("binance/2025-05-23T10-11-12.json", dt.datetime(2025, 5, 23, 10, 11, 12)),
    ("binance/2025-13-07T15-04-05.json", None),
    ("binance/note.txt", None),
    ("binance/2025-05-23T10-11-12.json.gz", None)])
def test_key_time(spark, path, expected):
    got = spark.createDataFrame([(path,)], "p string").select(S.key_time(F.col("p"))).first()[0]
    assert got == expected


def _envelopes(spark, times):
    rows = [(json.dumps({"subject": "A-USDT", "data": {"price": str(i), "time": 0}}), t, "kucoin")
            for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "data string, ingest_ts timestamp, source string")


def test_landing_replay_bounds_inclusive(spark, tmp_dir):
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    times = [base, base + dt.timedelta(seconds=30), base + dt.timedelta(minutes=1, seconds=5),
             base + dt.timedelta(hours=2), base + dt.timedelta(days=1)]
    fl = LZ.flush_groups(_envelopes(spark, times), 60)
    keys = {r.object_key for r in fl.collect()}
    assert "kucoin/2024-01-01T10-00-00.json" in keys and len(keys) == 4   # first two share a flush
    LZ.write_landing(fl, tmp_dir)
    got = RP.replay_ingest(spark, tmp_dir, "kucoin", base, base + dt.timedelta(minutes=1, seconds=5))
    assert got.count() == 3                                                 # both ends inclusive
    assert RP.replay_ingest(spark, tmp_dir, "kucoin", base + dt.timedelta(seconds=1),
                            base + dt.timedelta(hours=2)).count() == 2      # flush named after its first item
    assert RP.replay_ingest(spark, tmp_dir, "kucoin", dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "hour" in plan


def test_reference_style_objects(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/binance")
    recs = [{"e": "24hrMiniTicker", "E": 1, "s": "AUSDT", "c": "1", "o": "1", "h": "1", "l": "1", "v": "1", "q": "1"}]
    for name in ["2025-05-23T00-00-00.json", "2025-05-23T12-00-00.json", "2025-05-24T00-00-00.json",
                 "2025-05-25T00-00-00.json", "2025-13-07T15-04-05.json"]:
        with open(f"{tmp_dir}/binance/{name}", "w") as f:
            json.dump(recs * 2, f)
    with open(f"{tmp_dir}/binance/note.txt", "w") as f:
        f.write("x")
    listed = RP.list_objects(spark, tmp_dir, "binance", "2025-05-23 00:00:00", "2025-05-24 00:00:00")
    assert listed.count() == 3
    rows = RP.read_objects(spark, tmp_dir, "binance", "2025-05-23 00:00:00", "2025-05-24 00:00:00")
    got = rows.select("object_name", "el.event_type", "el.event_time").collect()
    assert len(got) == 6 and {r.event_type for r in got} == {"24hrMiniTicker"} and {r.event_time for r in got} == {1}


def test_current_price_late_row_does_not_overwrite(spark):
    rows = [("kucoin", "AUSDT", 1.0, dt.datetime(2024, 1, 1, 0, 0, 2), 1, 0),
            ("kucoin", "AUSDT", 9.0, dt.datetime(2024, 1, 1, 0, 0, 1), 2, 0),   # arrives later, older event
            ("kucoin", "AUSDT", 3.0, dt.datetime(2024, 1, 1, 0, 0, 2), 3, 0),   # same time, later arrival wins
            ("binance", "AUSDT", 5.0, dt.datetime(2024, 1, 1), 1, 0)]
    df = spark.createDataFrame(rows, "source string, symbol string, price double, time timestamp, seq long, pos int") \
        .withColumn("created_at", F.current_timestamp())
    got = {(r.source, r.symbol): r.price for r in L.current_price(df).collect()}
    assert got == {("kucoin", "AUSDT"): 3.0, ("binance", "AUSDT"): 5.0}


def test_object_overwrite_last_write_wins(spark):
    rows = [("k1", 1, "a"), ("k1", 2, "b"), ("k2", 1, "c")]
    df = spark.createDataFrame(rows, "key string, w long, v string")
    got = {r.key: r.v for r in L.object_overwrite(df, "key", ["w"], ["v"]).collect()}
    assert got == {"k1": "b", "k2": "c"}


def test_kafka_options_and_text_fallback(spark, tmp_dir):
    opts = K.producer_options("localhost:9092", K.RAW_TOPICS["kucoin"])
    assert opts["kafka.acks"] == "all" and opts["kafka.compression.type"] == "gzip" and opts["topic"] == "kucoin_raw_data"
    msgs = spark.createDataFrame([("[1,2]",)], "message string")
    K.write(K.messages(msgs), opts, fmt="text", path=f"{tmp_dir}/k")
    assert [r.value for r in spark.read.text(f"{tmp_dir}/k").collect()] == ["[1,2]"]
    from tickloom.sources.streams import kafka_options
    o = kafka_options("h:1", "binance_raw_data", max_offsets_per_trigger=100)
    assert o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "100"


def test_tick_messages_are_arrays_with_iso_timestamps(spark):
    tick = "array<struct<symbol:string,price:double,time:timestamp>>"
    df = spark.createDataFrame([([("AUSDT", 1.5, dt.datetime(2024, 1, 2, 3, 4, 5, 6000))] * 2,), ([],)], f"ticks {tick}")
    rows = [json.loads(r.value) for r in K.tick_messages(df).collect()]
    assert rows == [[{"symbol": "AUSDT", "price": 1.5, "time": "2024-01-02T03:04:05.006000"}] * 2]


def test_flat_csv_and_tee(spark, tmp_dir):
    from tickloom.operators.flatten import flatten_ticker
    from tickloom.operators.decode import keep_messages, parse_kucoin
    frames = spark.createDataFrame([('{"type":"message","subject":"A-USDT","data":{"price":"1"}}',),
                                    ('{"type":"welcome"}',)], "value string")
    flat = flatten_ticker(keep_messages(parse_kucoin(frames)))
    seen = []
    FS.tee(flat, lambda d: FS.write_flat_csv(d, f"{tmp_dir}/csv"), lambda d: seen.append(d.count()))
    back = spark.read.option("header", True).csv(f"{tmp_dir}/csv").collect()
    assert seen == [1] and len(back) == 1
    assert back[0].subject == "A-USDT" and back[0].price == "1" and back[0].bestAsk is None or back[0].bestAsk == ""


def test_backfill_gap_fill(spark, tmp_dir):
    from tickloom.sinks.current import backfill, read_snapshot, upsert_batch
    rows = [("AUSDT", 1.0, dt.datetime(2024, 1, 1, 10), "kucoin", 0, 0),
            ("AUSDT", 2.0, dt.datetime(2024, 1, 1, 11), "kucoin", 1, 0),
            ("BUSDT", 3.0, dt.datetime(2024, 1, 2, 11), "kucoin", 2, 0)]
    ticks = spark.createDataFrame(rows, "symbol string, price double, time timestamp, source string, seq long, pos int") \
        .withColumn("created_at", F.current_timestamp())
    LZ.write_ticks(ticks, f"{tmp_dir}/lake")
    newer = ticks.where("symbol = 'AUSDT' and seq = 1").withColumn("price", F.lit(7.0)) \
        .withColumn("time", F.lit(dt.datetime(2024, 2, 1)))
    upsert_batch(newer, 0, f"{tmp_dir}/snap")
    backfill(spark, f"{tmp_dir}/lake", f"{tmp_dir}/snap", "2024-01-01 00:00:00", "2024-01-03 00:00:00")
    snap = {r.symbol: r.price for r in read_snapshot(spark, f"{tmp_dir}/snap").collect()}
    assert snap == {"AUSDT": 7.0, "BUSDT": 3.0}


def test_landing_by_event_hour(spark, tmp_dir):
    """K6: the raw zone laid out by event hour instead of ingest time."""
    env = _envelopes(spark, [dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 10, 0, 1)])
    env = env.withColumn("event_ts", F.when(F.col("data").contains('"0"'), F.lit(dt.datetime(2023, 12, 31, 23, 59)))
                         .otherwise(F.lit(dt.datetime(2024, 1, 1, 9, 0))))
    LZ.write_landing(LZ.flush_groups(env, 60).withColumn("event_ts", F.col("event_ts")), tmp_dir,
                     by_event="event_ts")
    got = sorted((r.dt, r.hour) for r in spark.read.json(tmp_dir).select("dt", "hour").collect())
    assert [(str(d), h) for d, h in got] == [("2023-12-31", 23), ("2024-01-01", 9)]


def test_two_flushes_in_the_same_second_are_both_kept(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1, 10, 0, 0, 100000)
    for i in range(2):                                   # two separate flushes, same object key
        LZ.write_landing(LZ.flush_groups(_envelopes(spark, [t + dt.timedelta(microseconds=i)]), 60), tmp_dir)
    got = RP.replay_ingest(spark, tmp_dir, "kucoin", "2024-01-01 10:00:00", "2024-01-01 10:00:00")
    assert got.count() == 2 and got.select("object_key").distinct().count() == 1


def _snapshot_of(spark, root):
    from tickloom.sinks.current import read_snapshot
    return {r.symbol: r.price for r in read_snapshot(spark, root).collect()}


def _tick(spark, symbol, price, minute):
    return spark.createDataFrame([(symbol, price, dt.datetime(2024, 1, 1, 10, minute), "kucoin", 0, 0)],
                                 "symbol string, price double, time timestamp, source string, seq long, pos int") \
        .withColumn("created_at", F.current_timestamp())


@pytest.mark.parametrize("at", [0, 1, 2])
def test_backfill_and_stream_share_a_snapshot(spark, tmp_dir, at):
    """Whenever the backfill runs between the stream's batches, all rows stay."""
    from tickloom.sinks.current import backfill, upsert_batch
    LZ.write_ticks(_tick(spark, "FILL", 5.0, 30), f"{tmp_dir}/lake")
    for bid in range(3):
        if bid == at:
            backfill(spark, f"{tmp_dir}/lake", f"{tmp_dir}/snap", "2024-01-01 00:00:00", "2024-01-02 00:00:00")
        upsert_batch(_tick(spark, f"S{bid}", float(bid), bid), bid, f"{tmp_dir}/snap")
    assert _snapshot_of(spark, f"{tmp_dir}/snap") == {"FILL": 5.0, "S0": 0.0, "S1": 1.0, "S2": 2.0}


def test_a_new_checkpoint_folds_into_the_old_snapshot(spark, tmp_dir):
    from tickloom.sinks.current import upsert_batch
    for bid, symbol in enumerate("ABCD"):
        upsert_batch(_tick(spark, symbol, 1.0, bid), bid, tmp_dir)
    upsert_batch(_tick(spark, "E", 1.0, 9), 0, tmp_dir)            # batch ids start again
    upsert_batch(_tick(spark, "E", 1.0, 9), 0, tmp_dir)            # and are replayed
    assert set(_snapshot_of(spark, tmp_dir)) == set("ABCDE")


def test_a_reader_keeps_its_snapshot_across_commits(spark, tmp_dir):
    from tickloom.sinks.current import KEEP, read_snapshot, upsert_batch
    upsert_batch(_tick(spark, "A", 1.0, 0), 0, tmp_dir)
    held = read_snapshot(spark, tmp_dir)
    for bid in range(1, KEEP):
        upsert_batch(_tick(spark, "A", 1.0 + bid, bid), bid, tmp_dir)
    assert [r.price for r in held.collect()] == [1.0]
    for bid in range(KEEP, KEEP + 4):
        upsert_batch(_tick(spark, "A", 1.0 + bid, bid), bid, tmp_dir)
    assert _snapshot_of(spark, tmp_dir) == {"A": KEEP + 4.0}
    assert len([n for n in os.listdir(tmp_dir) if n.startswith("commit-")]) == KEEP   # old ones go


def test_two_writers_do_not_lose_each_other(spark, tmp_dir, monkeypatch):
    """Another writer commits between this one's read and its commit."""
    from tickloom.sinks import current as C
    C.upsert_batch(_tick(spark, "A", 1.0, 0), 0, tmp_dir)
    real, fired = C._settled, []

    def late(spark_, root):
        got = real(spark_, root)
        if not fired:
            fired.append(1)
            C.upsert_batch(_tick(spark, "B", 2.0, 1), 0, tmp_dir)
        return got

    monkeypatch.setattr(C, "_settled", late)
    C.upsert_batch(_tick(spark, "C", 3.0, 2), 1, tmp_dir)
    assert _snapshot_of(spark, tmp_dir) == {"A": 1.0, "B": 2.0, "C": 3.0}


def test_rows_without_a_time_stay(spark, tmp_dir):
    env = _envelopes(spark, [dt.datetime(2024, 1, 1, 10), None])
    flushed = LZ.flush_groups(env)
    assert flushed.count() == 2
    LZ.write_landing(flushed, tmp_dir)
    assert spark.read.json(tmp_dir).count() == 2
    from tickloom.operators.batching import assign_aligned
    rows = spark.createDataFrame([("k", dt.datetime(2024, 1, 1, 10), 1), ("k", None, None)], "k string, ts timestamp, ms long")
    assert assign_aligned(rows, ["k"], "ts", "ms", window="60 seconds", size=5).count() == 2


def test_a_batch_that_lands_again_replaces_itself_only(spark, tmp_dir):
    one, two = (_envelopes(spark, [dt.datetime(2024, 1, 1, 10, m)]) for m in (0, 1))
    for batch, env in (("q-0", one), ("q-1", two), ("q-0", one)):
        LZ.write_landing(LZ.flush_groups(env), tmp_dir, batch=batch)
    got = RP.replay_ingest(spark, tmp_dir, "kucoin", "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert sorted(r.ingest_ts.minute for r in got.collect()) == [0, 1]


def test_replay_of_a_missing_range_is_empty(spark, tmp_dir):
    got = RP.replay_event(spark, tmp_dir, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert got.count() == 0 and {"symbol", "price", "time"} <= set(got.columns)
