"""Edge cases of FIXTURES 4: decode, validate, normalise."""

import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.operators import decode as D
from tickloom.operators import normalize as N

KU = ('{"topic":"/market/ticker:all","type":"message","subject":"%s","data":{"bestAsk":"0.10605",'
      '"bestAskSize":"2522.2","bestBid":"0.10596","bestBidSize":"2160","price":%s,"sequence":"915875484",'
      '"size":"159.3256","time":%s}}')


def ku(subject="CRO-USDT", price='"0.10604"', time="1743147198992"):
    return KU % (subject, price, time)


def frames(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq long")


def ticks(spark, values, **kw):
    parsed = D.drop_control_frames(D.parse_kucoin(frames(spark, values)))
    valid = D.validate_kucoin(parsed).valid
    return N.normalize(valid, N.KUCOIN, keep=("seq",), **kw)


def test_sample_message(spark):
    rows = ticks(spark, [ku()]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.symbol == "CROUSDT" and r.price == 0.10604 and r.source == "kucoin"
    assert str(r.time) == "2025-03-28 07:33:18.992000"


def test_float32_option(spark):
    r = ticks(spark, [ku()], price_type="float").collect()[0]
    assert r.price == pytest.approx(0.10604000091552734, abs=0) or r.price == 0.10604000091552734


@pytest.mark.parametrize("subject,kept", [
    ("A-BTC", False), ("ada-usdt", False), ("X-Y-USDC", True), ("CRO-USDT", True)])
def test_quote_filter(spark, subject, kept):
    rows = ticks(spark, [ku(subject=subject)]).collect()
    assert (len(rows) == 1) == kept
    if kept and subject == "X-Y-USDC":
        assert rows[0].symbol == "XYUSDC"


def test_null_subject_and_control_frames(spark):
    vals = [ku().replace('"subject":"CRO-USDT",', ""), '{"id":"zmlD9FsJJw","type":"welcome"}',
            '{"id":"1","type":"ack"}', '{"subject":"USDTUSDT","type":"message"}']
    parsed = D.parse_kucoin(frames(spark, vals))
    kept = D.drop_control_frames(parsed)
    # only the frame with both subject and data survives P4 ... none here
    assert kept.count() == 0


@pytest.mark.parametrize("price,ok,value", [
    ('"abc"', False, None), ('""', False, None), ('"NaN"', False, None), ('"Infinity"', False, None),
    ('" 1.5 "', True, 1.5), ('"1e3"', True, 1000.0), ('"1.5d"', True, 1.5)])
def test_price_parsing_never_throws(spark, price, ok, value):
    split = N.split_ticks(ticks(spark, [ku(price=price)]))
    if ok:
        assert [r.price for r in split.valid.collect()] == [value]
        assert split.rejects.count() == 0
    else:
        rej = split.rejects.collect()
        assert len(rej) == 1 and rej[0].reason == "bad:price"


def test_time_as_string_is_rejected(spark):
    parsed = D.drop_control_frames(D.parse_kucoin(frames(spark, [ku(time='"12"'), ku(time="1.0")])))
    split = D.validate_kucoin(parsed)
    assert split.valid.count() == 0
    assert {r.reason for r in split.rejects.collect()} == {"missing:data.time"}


def test_garbage_and_empty_frames(spark):
    parsed = D.parse_kucoin(frames(spark, ["not json", "[]", None, ku()]))
    # garbage is no control frame: it stays, and is rejected
    split = D.validate_kucoin(D.drop_control_frames(parsed))
    assert split.valid.count() == 1
    assert sorted(r.reason for r in split.rejects.collect()) == ["malformed", "malformed"]


def test_narrow_schema_is_validated_on_what_it_reads(spark):
    bad = ku().replace('"price":"0.10604",', "")
    parsed = D.drop_control_frames(D.parse_kucoin(frames(spark, [ku(), bad]), schema=S.KUCOIN_TICK_SOURCE))
    split = D.validate_kucoin(parsed)
    assert split.valid.count() == 1
    assert [r.reason for r in split.rejects.collect()] == ["missing:data.price"]


def test_one_pass_gives_every_row_its_fate(spark):
    from tickloom.streaming import jobs as J
    rows = [ku(), "not json", None, ku(price='"abc"'), ku(subject="A-BTC"), '{"id":"1","type":"ack"}', ku(time='"12"')]
    out = J.kucoin_outcomes(frames(spark, rows).withColumn("seq", F.lit(0))).select("symbol", "reason").collect()
    assert sorted(((r.symbol or "", r.reason or "") for r in out)) == sorted([
        ("CROUSDT", ""), ("", "malformed"), ("", "malformed"), ("CROUSDT", "bad:price"), ("", "missing:data.time")])


def test_array_message_is_exploded_in_order(spark):
    arr = "[" + ",".join([ku(subject="A-USDT"), ku(subject="B-USDT")]) + "]"
    rows = ticks(spark, [arr]).select("symbol").collect()
    assert [r.symbol for r in rows] == ["AUSDT", "BUSDT"]


def test_unknown_fields_dropped_and_bestbidsize_kept(spark):
    v = json.loads(ku())
    v["extra"] = 1
    parsed = D.parse_kucoin(frames(spark, [json.dumps(v)]))
    assert "extra" not in parsed.schema["msg"].dataType.names
    assert parsed.select("msg.data.bestBidSize").first()[0] == "2160"


def test_strict_mode_fails_fast(spark):
    parsed = D.parse_kucoin(frames(spark, [ku(), "not json"]), strict=True)
    with pytest.raises(Exception):
        parsed.collect()


def test_strict_validation_raises_on_missing_field(spark):
    bad = ku().replace('"bestAsk":"0.10605",', "")
    parsed = D.drop_control_frames(D.parse_kucoin(frames(spark, [bad])))
    with pytest.raises(Exception):
        D.validate_kucoin(parsed, strict=True).valid.collect()


BI = ('[{"e":"24hrMiniTicker","E":1743147448467,"s":"BTCUSDT","c":"85439.99000000","o":"87304.35000000",'
      '"h":"87728.27000000","l":"85300.01000000","v":"20230.79019000","q":"1754434346.25694750"},'
      '{"e":"24hrMiniTicker","E":1672515782136,"s":"BNBBTC","c":"0.0025","o":"0.0010","h":"0.0025",'
      '"l":"0.0010","v":"10000","q":"18"}]')


def test_binance_case_distinct_fields(spark):
    rows = D.parse_binance(frames(spark, [BI])).select("pos", "el.*").collect()
    assert [r.pos for r in rows] == [0, 1]
    assert rows[0].event_type == "24hrMiniTicker" and rows[0].event_time == 1743147448467
    assert rows[1].symbol == "BNBBTC" and rows[1].quote_volume == "18"


def test_binance_ticks(spark):
    valid = D.validate_binance(D.parse_binance(frames(spark, [BI]))).valid
    t = N.normalize(valid, N.BINANCE).collect()
    assert len(t) == 1 and t[0].symbol == "BTCUSDT" and t[0].price == 85439.99
    assert str(t[0].time) == "2025-03-28 07:37:28.467000"


def test_binance_number_becomes_string_and_lone_object(spark):
    lone = '{"e":"x","E":1,"s":"AUSDT","c":5,"o":"1","h":"1","l":"1","v":"1","q":"1"}'
    rows = D.parse_binance(frames(spark, [lone])).select("el.close").collect()
    assert [r.close for r in rows] == ["5"]


def test_event_time_unknown_source_raises(spark):
    from tickloom.functions.scalar import event_time
    df = spark.createDataFrame([("other", 1, 2)], "source string, k long, b long")
    with pytest.raises(Exception):
        df.select(event_time(F.col("source"), F.col("k"), F.col("b"))).collect()
    ok = spark.createDataFrame([("kucoin", 1743147198992, 0)], "source string, k long, b long")
    assert str(ok.select(event_time(F.col("source"), F.col("k"), F.col("b"))).first()[0]) == "2025-03-28 07:33:18.992000"


def test_narrow_schema_tick_path(spark):
    from tickloom.schemas import KUCOIN_TICK_SOURCE
    parsed = D.drop_control_frames(D.parse_kucoin(frames(spark, [ku()]), schema=KUCOIN_TICK_SOURCE))
    assert parsed.schema["msg"].dataType.names == ["subject", "data"]
    r = N.normalize(parsed, N.KUCOIN).first()
    assert r.symbol == "CROUSDT" and r.price == 0.10604


def test_kafka_binary_values_are_decoded(spark):
    rows = [(bytearray(ku().encode("utf-8")), 0)]
    df = spark.createDataFrame(rows, "value binary, seq long")
    t = N.normalize(D.validate_kucoin(D.drop_control_frames(D.parse_kucoin(df))).valid, N.KUCOIN).collect()
    assert [(r.symbol, r.price) for r in t] == [("CROUSDT", 0.10604)]


def test_scalar_helpers(spark):
    from tickloom.functions import scalar as S
    df = spark.createDataFrame([("A-B-USDT", None, "x")], "s string, n string, t string")
    r = df.select(S.strip_hyphens("s").alias("a"), S.default_if_missing("n").alias("b"),
                  S.present("n").alias("c"), S.has_quote("n").alias("d"),
                  S.utf8_decode(S.utf8_encode("t")).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == ("ABUSDT", "", False, False, "x")
