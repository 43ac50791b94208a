"""Objects under their public names and their manifest."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tickloom.sinks import landing as LZ
from tickloom.sinks import objects as OS
from tickloom.sources import landing as RP
from tickloom.sources import objects as OB

BASE = dt.datetime(2024, 1, 1, 10, 0, 0)


def _record(i, source="kucoin", ms=0):
    if source == "binance":
        return json.dumps({"e": "24hrMiniTicker", "E": ms, "s": "AUSDT", "c": str(i), "o": "1", "h": "1", "l": "1",
                           "v": "1", "q": str(i)})
    return json.dumps({"topic": "t", "type": "message", "subject": "A-USDT",
                       "data": {"bestAsk": "]", "bestAskSize": "[,", "bestBid": "é", "price": str(i), "sequence": str(i),
                                "size": "1", "time": ms}})


def _envelopes(spark, seconds, source="kucoin", shift_ms=0):
    rows = [(_record(i, source, 1_000_000 + 1000 * s + shift_ms), BASE + dt.timedelta(seconds=s), source,
             1_000_000 + 1000 * s + shift_ms, i) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "data string, ingest_ts timestamp, source string, event_ms long, seq long").repartition(4)


def _write(env, root, seconds=60):
    OS.write_objects(LZ.flush_groups(env, seconds), root, ("ingest_ts", "seq"))


def test_objects_are_arrays_in_order_under_their_names(spark, tmp_dir):
    _write(_envelopes(spark, [0, 30, 59, 60, 125, 30]), tmp_dir)
    names = sorted(n for n in os.listdir(f"{tmp_dir}/kucoin") if not n.startswith("."))
    assert names == ["2024-01-01T10-00-00.json", "2024-01-01T10-01-00.json", "2024-01-01T10-02-05.json"]
    with open(f"{tmp_dir}/kucoin/{names[0]}") as f:
        assert [r["data"]["sequence"] for r in json.load(f)] == ["0", "1", "5", "2"]
    assert not [n for n in os.listdir(tmp_dir) if n.startswith("_staging")]


def test_range_by_name_is_inclusive_and_skips_other_names(spark, tmp_dir):
    _write(_envelopes(spark, [0, 60, 120, 180]), tmp_dir)
    text = json.dumps([json.loads(_record(99))])
    for name in ("note.txt", "2024-13-01T10-01-00.json", "2024-01-01T10-01-30.json.bak", "x.json"):
        with open(f"{tmp_dir}/kucoin/{name}", "w") as f:
            f.write(text)
    rows = RP.read_objects(spark, tmp_dir, "kucoin", BASE + dt.timedelta(seconds=60), BASE + dt.timedelta(seconds=120))
    assert sorted(r[0] for r in rows.select("msg.data.sequence").collect()) == ["1", "2"]
    assert {r[0] for r in OB.listed(spark, tmp_dir, ["kucoin"]).select("object_key").collect()} == {
        f"kucoin/2024-01-01T10-0{m}-00.json" for m in range(4)}


def test_same_name_replaces_and_the_newest_entry_counts(spark, tmp_dir):
    _write(_envelopes(spark, [0, 1]), tmp_dir)
    _write(_envelopes(spark, [0, 1, 2], shift_ms=5), tmp_dir)
    e = OB.read_manifest(spark, tmp_dir).collect()
    assert [(r.object_key, r.rows, r.first_event_ms, r.last_event_ms) for r in e] == [
        ("kucoin/2024-01-01T10-00-00.json", 3, 1_000_005, 1_002_005)]
    assert e[0].bytes == os.path.getsize(f"{tmp_dir}/kucoin/2024-01-01T10-00-00.json")


@pytest.mark.parametrize("source", ["kucoin", "binance"])
def test_replay_by_event_time_opens_matching_objects_only(spark, tmp_dir, source):
    _write(_envelopes(spark, range(0, 600, 7), source), tmp_dir)
    start, end = (dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms) for ms in (1_070_000, 1_182_000))
    rows = OB.replay_objects(spark, tmp_dir, source, start, end)
    got = sorted(r.event_ms for r in rows.collect())
    assert got == [1_000_000 + 1000 * s for s in range(70, 183, 7)]             # both ends are records
    opened = {os.path.basename(f) for f in rows.inputFiles()}
    assert opened == {f"2024-01-01T10-0{m}-{s:02d}.json" for m, s in ((1, 3), (2, 6), (3, 2))}
    assert OB.replay_objects(spark, tmp_dir, source, dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2)) is None


def test_manifest_is_repaired_from_the_folder(spark, tmp_dir):
    _write(_envelopes(spark, [0, 60, 120]), tmp_dir)
    os.remove(f"{tmp_dir}/kucoin/2024-01-01T10-00-00.json")
    with open(f"{tmp_dir}/kucoin/2024-01-01T10-01-00.json", "w") as f:         # another writer's object, one line
        json.dump([json.loads(_record(7, ms=5)), json.loads(_record(8, ms=9))], f)
    with open(f"{tmp_dir}/kucoin/2024-01-01T11-00-00.json", "w") as f:         # and one laid out over lines
        json.dump([json.loads(_record(9, ms=7))], f, indent=1)
    for name in ("2024-01-01T10-01-00", "2024-01-01T10-00-00"):                # the writers' checksums, if any
        if os.path.exists(f"{tmp_dir}/kucoin/.{name}.json.crc"):
            os.remove(f"{tmp_dir}/kucoin/.{name}.json.crc")
    changes = {tuple(r) for r in OS.repair_manifest(spark, tmp_dir).collect()}
    assert changes == {("kucoin/2024-01-01T10-01-00.json", "added"), ("kucoin/2024-01-01T11-00-00.json", "added"),
                       ("kucoin/2024-01-01T10-00-00.json", "gone")}
    e = {r.object_key[7:]: (r.rows, r.first_event_ms, r.last_event_ms) for r in OB.read_manifest(spark, tmp_dir).collect()}
    assert e == {"2024-01-01T10-01-00.json": (2, 5, 9), "2024-01-01T11-00-00.json": (1, 7, 7),
                 "2024-01-01T10-02-00.json": (1, 1_120_000, 1_120_000)}
    epoch = dt.datetime(1970, 1, 1)
    rows = OB.replay_objects(spark, tmp_dir, "kucoin", epoch, epoch + dt.timedelta(milliseconds=8))
    assert sorted(r[0] for r in rows.select("msg.data.sequence").collect()) == ["7", "9"]
    assert OS.repair_manifest(spark, tmp_dir).count() == 0


def test_rows_without_a_name_are_kept_apart(spark, tmp_dir):
    env = _envelopes(spark, [0, 1]).unionByName(
        spark.createDataFrame([("{}", None, "kucoin", None, 5), ("{}", BASE, None, 1, 6)],
                              "data string, ingest_ts timestamp, source string, event_ms long, seq long"))
    _write(env, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/unnamed.parquet").count() == 2
    assert OB.read_manifest(spark, tmp_dir).agg(F.sum("rows")).first()[0] == 2


def test_nothing_to_write(spark, tmp_dir):
    _write(_envelopes(spark, [0]).limit(0), tmp_dir)
    assert OB.read_manifest(spark, tmp_dir).count() == 0 and OB.listed(spark, tmp_dir, ["kucoin"]).count() == 0


def test_binance_messages_do_not_grow_with_the_table(spark):
    from tickloom.sources import feeds
    sizes = []
    for n in (2_000, 40_000):
        ev = spark.range(n).selectExpr("id event_id", f"timestamp_millis(id * {3_600_000 * 4} div {n}) ts", "id % 7 user_id",
                                       "'view' event_type", "1.5D value", "'' props")
        frames = feeds.binance_frames(ev).select(F.size(F.from_json("value", "array<struct<s:string>>")).alias("n"))
        r = frames.agg(F.max("n"), F.sum("n")).first()
        assert r[1] == n
        sizes.append(r[0])
    assert max(sizes) <= 2 * feeds.FRAME_ELEMENTS
