"""Gap finding and filling (T8), message-atomic validation (P11), dead-letter routing."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import gaps as G
from tickloom.operators import messages as M
from tickloom.operators import routing as RT
from tickloom.sinks import landing as LZ
from tickloom.streaming import jobs as J


# -- gaps ---------------------------------------------------------------------
def _brute_gaps(times, tolerance, span=None):
    t = sorted(x for x in times if x is not None and (span is None or span[0] <= x <= span[1]))
    if span:
        t = [span[0] - 1, *t, span[1] + 1]
    return sorted((a, b) for a, b in zip(t, t[1:]) if b - a > tolerance)


@pytest.mark.parametrize("span", [None, (100, 9_000)])
def test_gaps_equal_a_sorted_walk(spark, span):
    r = random.Random(2)
    rows = [(k, r.choice([None, *[r.randint(0, 10_000)] * 5])) for k in ("a", "b", None) for _ in range(60)]
    rows += [("hot", x) for x in range(0, 10_000, 3) if not 4_000 < x < 4_800]
    ticks = spark.createDataFrame(rows, "symbol string, ms long").repartition(6)
    got = G.find_gaps(ticks, ["symbol"], "ms", 250, span).collect()
    for k in ("a", "b", None, "hot"):
        want = _brute_gaps([ms for s, ms in rows if s == k], 250, span)
        assert sorted((x.after_ms, x.before_ms) for x in got if x.symbol == k) == want
    assert all(x.silence_ms == x.before_ms - x.after_ms for x in got)


def test_gap_of_exactly_the_tolerance_is_none(spark):
    ticks = spark.createDataFrame([("a", 5), ("a", 105), ("a", 206)], "symbol string, ms long")
    assert [(r.after_ms, r.before_ms) for r in G.find_gaps(ticks, ["symbol"], "ms", 100).collect()] == [(105, 206)]


def test_keys_without_any_tick_are_gaps_of_the_whole_span(spark):
    ticks = spark.createDataFrame([("a", 50)], "symbol string, ms long")
    expected = spark.createDataFrame([("a",), ("b",), (None,)], "symbol string")
    got = G.find_gaps(ticks, ["symbol"], "ms", 99, (0, 100), expected).collect()
    assert {(r.symbol, r.after_ms, r.before_ms) for r in got} == {("b", -1, 101), (None, -1, 101)}
    assert G.find_gaps(ticks.limit(0), ["symbol"], "ms", 99).count() == 0


def test_a_hot_key_is_reduced_before_its_window(spark):
    ticks = spark.range(100_000).selectExpr("'hot' symbol", "id ms")
    plan = G.find_gaps(ticks, ["symbol"], "ms", 1_000)._jdf.queryExecution().executedPlan().toString()
    window, partial = plan.index("Window"), plan.rindex("partial_max")
    assert window < partial                 # the partial aggregate stands below the window


def test_merged_ranges_equal_a_sorted_walk(spark):
    r = random.Random(5)
    day = G.MERGE_MS
    rows = []
    for s in ("x", "y"):
        for _ in range(150):
            a = r.randint(0, 30 * day)
            rows.append((s, a, a + r.choice([10, day // 20, day // 2, 2 * day])))
    got = {(x.source, x.after_ms, x.before_ms, x.gaps) for x in G.merge_ranges(
        spark.createDataFrame(rows, "source string, after_ms long, before_ms long"), ["source"]).collect()}
    want = set()
    for s in ("x", "y"):
        held = None
        for a, b in sorted((a, b) for k, a, b in rows if k == s):
            if held and a <= held[1]:
                held = [held[0], max(held[1], b), held[2] + 1]
            else:
                if held:
                    want.add((s, *held))
                held = [a, b, 1]
        want.add((s, *held))
    assert got == want


def test_replay_brings_back_what_is_inside_a_gap_only(spark, tmp_dir):
    base = dt.datetime(2024, 1, 1)
    rows = [(s, float(i), base + dt.timedelta(hours=3 * i), "kucoin", base) for i in range(40) for s in ("A", "B")]
    ticks = spark.createDataFrame(rows, "symbol string, price double, time timestamp, source string, created_at timestamp")
    LZ.write_ticks(ticks, f"{tmp_dir}/lake")
    lost = (F.col("symbol") == "A") & F.col("time").between(F.lit(base + dt.timedelta(hours=30)), F.lit(base + dt.timedelta(hours=60)))
    left = ticks.where(~lost)
    gaps = G.find_gaps(left.withColumn("ms", F.unix_millis("time")), ["source", "symbol"], "ms", 3 * 3_600_000)
    assert gaps.count() == 1
    back = G.replay_gaps(spark, f"{tmp_dir}/lake", gaps)
    assert sorted(r.price for r in back.collect()) == [float(i) for i in range(10, 21)]
    assert {f.split("dt=")[1][:10] for f in back.inputFiles()} == {"2024-01-02", "2024-01-03"}
    assert G.replay_gaps(spark, f"{tmp_dir}/lake", gaps.limit(0)) is None


# -- messages -----------------------------------------------------------------
def _element(i, **change):
    data = {"bestAsk": "1", "bestAskSize": "1", "bestBid": "1", "price": str(i), "sequence": str(i), "size": "1", "time": i}
    data.update(change)
    return {"topic": "t", "type": "message", "subject": "A-USDT", "data": {k: v for k, v in data.items() if v is not None}}


def test_one_bad_element_rejects_its_message_with_position_and_reason(spark):
    ok = [_element(i) for i in range(3)]
    texts = {
        0: json.dumps(ok), 1: json.dumps([*ok, _element(3, price=None), 7]), 2: json.dumps([*ok[:1], 7, _element(3, price=None)]),
        3: json.dumps(ok)[:-1], 4: json.dumps(ok[0]), 5: "[]", 6: "", 7: None, 8: "7", 9: "[null]", 10: '["x"]',
        11: json.dumps([ok[0], [ok[1]]]), 12: json.dumps([ok[0], _element(1, time="noon")]), 13: " \n" + json.dumps(ok),
        14: '{"a": [1, 2', 15: json.dumps([{**ok[0], "extra": [1, {"y": None}]}])}
    frames = spark.createDataFrame([(k, None if v is None else v.encode()) for k, v in texts.items()], "id long, value binary")
    checked = M.check_messages(frames)
    got = {r.id: (r.bad_pos, r.reason, None if r.texts is None else len(r.texts)) for r in checked.collect()}
    assert got == {
        0: (None, None, 3), 1: (3, "missing:data.price", None), 2: (1, "not an object", None), 3: (None, "malformed", None),
        4: (None, "not an array", None), 5: (None, None, 0), 6: (None, "malformed", None), 7: (None, "malformed", None),
        8: (None, "malformed", None), 9: (0, "not an object", None), 10: (0, "not an object", None),
        11: (1, "not an object", None), 12: (1, "missing:data.time", None), 13: (None, None, 3),
        14: (None, "malformed", None), 15: (None, None, 1)}
    split = M.split_messages(checked)
    assert sorted((r.id, r.pos, r.msg.data.price) for r in split.valid.collect()) == sorted(
        [(i, k, str(k)) for i in (0, 13) for k in range(3)] + [(15, 0, "0")])
    assert split.rejects.count() == 12 and split.rejects.where("raw is null").count() == 1


def test_a_bad_message_rejects_its_poll(spark):
    good, bad = json.dumps([_element(1)]), "["
    frames = spark.createDataFrame([(1, good), (1, bad), (1, bad), (2, good), (None, good), (None, bad), (3, "[]")],
                                   "poll long, value string")
    got = sorted(((r.poll or 0), r.reason or "", r.texts is None) for r in
                 M.reject_polls(M.check_messages(frames), ["poll"]).collect())
    assert got == [(0, "malformed", True), (0, "poll", True), (1, "malformed", True), (1, "malformed", True),
                   (1, "poll", True), (2, "", False), (3, "", False)]


def test_messages_are_checked_on_a_stream(spark, tmp_dir):
    spark.createDataFrame([(json.dumps([_element(1), _element(2)]),), (json.dumps([_element(3), 4]),)], "value string"
                          ).write.parquet(f"{tmp_dir}/in")
    stream = M.split_messages(M.check_messages(spark.readStream.schema("value string").parquet(f"{tmp_dir}/in"))).valid
    q = J.start(stream.select("msg.data.price"), f"{tmp_dir}/ck", path=f"{tmp_dir}/out", trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == ["1", "2"]


# -- routing ------------------------------------------------------------------
def _landed(spark):
    k, b = _element(5), {"e": "x", "E": 9, "s": "AUSDC", "c": "2.5", "o": "1", "h": "1", "l": "1", "v": "1", "q": "1"}
    rows = [("k", json.dumps(k)), ("k", json.dumps(_element(5, price="NaN"))), ("k", json.dumps({**k, "subject": "A-BTC"})),
            ("k", json.dumps(k)[:15]), ("k", None), ("k", "[]"), ("k", json.dumps(b)), ("b", json.dumps(b)),
            ("b", json.dumps({**b, "E": None})), ("b", json.dumps({**b, "e": None})), ("x", json.dumps(k)), (None, "{}")]
    name = {"k": "kucoin", "b": "binance", "x": "kraken", None: None}
    return spark.createDataFrame([(i, name[s], d, "t") for i, (s, d) in enumerate(rows)],
                                 "id long, source string, data string, outcome string")


WANT = [(0, "tick", "AUSDT", 5.0, None), (1, "reject", None, None, "bad:price"), (2, "other", "ABTC", 5.0, None),
        (3, "reject", None, None, "malformed"), (4, "reject", None, None, "malformed"), (5, "reject", None, None, "malformed"),
        (6, "reject", None, None, "missing:topic"), (7, "tick", "AUSDC", 2.5, None),
        (8, "reject", None, None, "missing:event_time"), (9, "reject", None, None, "missing:event_type"),
        (10, "unknown", None, None, "unknown source: kraken"), (11, "unknown", None, None, "unknown source: null")]


def test_every_record_gets_one_outcome(spark, tmp_dir):
    rows = RT.route(_landed(spark))
    assert sorted((r.id, r.outcome, r.symbol, r.price, r.reason) for r in rows.collect()) == WANT
    RT.write_routes(rows, f"{tmp_dir}/r")
    dead = RT.read_route(spark, f"{tmp_dir}/r", "unknown", rows.schema)
    assert {(r.id, r.data is not None) for r in dead.collect()} == {(10, True), (11, True)}
    again = RT.route(dead, {**RT.ROUTES, "kraken": RT.ROUTES["kucoin"]})
    assert {(r.id, r.outcome) for r in again.collect()} == {(10, "tick"), (11, "unknown")}
    assert RT.route(_landed(spark).limit(0)).count() == 0


def test_an_unknown_source_does_not_stop_the_stream(spark, tmp_dir):
    _landed(spark).write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema("id long, source string, data string").parquet(f"{tmp_dir}/in")
    q = J.start_routing(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    got = spark.read.parquet(f"{tmp_dir}/out").select("id", "outcome").collect()
    assert sorted(map(tuple, got)) == [(i, o) for i, o, *_ in WANT]


def test_routing_parses_a_record_once(spark):
    """One parse for each source's rule, also below a filter on what the routing adds."""
    env = spark.createDataFrame([("{}", "kucoin")], "data string, source string").withColumn("ingest_ts", F.current_timestamp())
    routed = RT.route(env)
    for df in (routed, routed.where(F.col("outcome") == RT.REJECT).select("reason", "price")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == len(RT.ROUTES)
    assert [tuple(r) for r in routed.select("outcome", "reason").collect()] == [(RT.REJECT, "missing:topic")]


def test_messages_and_their_elements_are_parsed_once(spark):
    frames = spark.createDataFrame([("[{}, 7]",), (None,), ("{}",)], "value string")
    checked = M.check_messages(frames)
    split = M.split_messages(checked)
    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")

    # the message as an array and as an object, and its elements; the records again where they are read
    assert parses(checked) == parses(checked.where(F.col("reason").isNull())) == parses(split.rejects) == 3
    assert parses(split.valid.where(F.col("msg.data.price").isNotNull()).select("msg.subject", "msg.data.price")) == 4
    assert [tuple(r) for r in checked.select("bad_pos", "reason").collect()] == [
        (0, "missing:topic"), (None, "malformed"), (None, "not an array")]
