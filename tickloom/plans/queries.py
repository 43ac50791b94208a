"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the driver's tables (or data Spark derives from them). Every query runs
over the whole ``events`` table; time ranges appear only where the range is
the feature (replay)."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas as SCH
from tickloom.functions import scalar as S
from tickloom.operators import batching as B
from tickloom.operators import decode as D
from tickloom.operators import envelope as E
from tickloom.operators import gaps as G
from tickloom.operators import latest as L
from tickloom.operators import messages as M
from tickloom.operators import normalize as N
from tickloom.operators import routing as RT
from tickloom.operators.flatten import flatten_ticker as _flatten
from tickloom.plans import common as C
from tickloom.session import scratch_path
from tickloom.sinks import current as CUR
from tickloom.sinks import files as FS
from tickloom.sinks import history as HI
from tickloom.sinks import kafka as KS
from tickloom.sinks import landing as LZ
from tickloom.sinks import objects as OS
from tickloom.sources import feeds
from tickloom.sources import files as FF
from tickloom.sources import landing as RP
from tickloom.sources import objects as OB
from tickloom.streaming import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered queries (shared with the SQL oracles).
# Sizes and timeouts are such that both close many batches at sf0.01.
BATCH_SIZE, BATCH_TIMEOUT_MS = 5, 10 * 3600 * 1000            # per-symbol batches (A10)
SOURCE_BATCH_SIZE, SOURCE_BATCH_TIMEOUT_MS = 12, 3600 * 1000  # one key per feed (A2)
IDLE_MS = 4 * 3600 * 1000                                      # a key's silence that closes its batch (A6)
TIME_ONLY_SIZE, TIME_ONLY_TIMEOUT_MS = 99_999_999, 60_000
ALIGNED_WINDOW, ALIGNED_SIZE = "12 hours", 4
FLUSH_SECONDS = 3600
OBJECT_SECONDS = 6 * 3600                                     # a flush that becomes one object
REPLAY_START, REPLAY_END = "2024-01-10 06:30:00", "2024-01-14 18:45:30"

# What each feed lost, the span it should cover, and the silence that is no gap.
OUTAGES = {"kucoin": (REPLAY_START, REPLAY_END), "binance": ("2024-01-26 03:00:00", "2024-02-01 00:00:00")}
SPAN, TOLERATED_MS = ("2024-01-01 00:00:00", "2024-01-31 00:00:00"), 6 * 3600 * 1000
MESSAGE_RECORDS = 8
INSTANTS = ("2024-01-01 00:30:00", REPLAY_START, "2024-01-17 12:00:00.5", "2024-01-20 00:00:00", "2024-02-10 00:00:00")


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- decode / normalise

@register
def kucoin_normalize(spark, sf_dir):
    """Kucoin frames -> decode (F14) -> control-frame filter (P4) -> validate
    -> quote filter, hyphen removal, price/time parse (F1-F6, P1-P9)."""
    return C.tick_out(C.kucoin_ticks(spark, sf_dir))


@register
def binance_normalize(spark, sf_dir):
    """Binance array frames -> decode + explode (F12, A7) -> rename (P7) -> ticks."""
    return C.tick_out(C.binance_ticks(spark, sf_dir))


@register
def kucoin_price_float32(spark, sf_dir):
    """F3 with the reference's float32 rounding of Kucoin prices (H2)."""
    valid = D.validate_kucoin(C.kucoin_decoded(spark, sf_dir)).valid
    return C.tick_out(N.split_ticks(N.normalize(valid, N.KUCOIN, price_type="float")).valid)


@register
def unified_feed(spark, sf_dir):
    """T4: both feeds in one tick schema."""
    return C.tick_out(C.unified_ticks(spark, sf_dir))


@register
def control_frame_filter(spark, sf_dir):
    """Frames without ``subject``/``data`` (welcome, ack) are dropped;
    a ``notice`` frame that carries both is kept."""
    parsed = D.parse_kucoin(feeds.kucoin_frames(C.events(spark, sf_dir), notices=True))
    return D.drop_control_frames(parsed).select(
        F.col("seq").alias("event_id"), F.col("msg.type").alias("type"), F.col("msg.subject").alias("subject"))


@register
def message_type_filter(spark, sf_dir):
    """P5: keep ``type == 'message'`` frames that carry a subject (notices
    and control frames are dropped)."""
    parsed = D.parse_kucoin(feeds.kucoin_frames(C.events(spark, sf_dir), notices=True))
    return D.keep_messages(parsed).select(
        F.col("seq").alias("event_id"), F.col("msg.type").alias("type"), F.col("msg.subject").alias("subject"))


def _dirty_price(ev: DataFrame):
    """Bad price texts injected by value band: '' , 'NaN', 'abc'."""
    v = ev["value"]
    return (F.when(v < 1, F.lit("")).when(v >= 200, F.lit("NaN"))
            .when((v >= 100) & (v < 101), F.lit("abc")).otherwise(v.cast("string")))


def _missing_ask(t: DataFrame):
    """A missing model field injected by value band (null -> key left out)."""
    return F.when((t["value"] >= 101) & (t["value"] < 102), F.lit(None).cast("string")).otherwise(t["price_text"])


def _bad_time(t: DataFrame):
    """A time that is no whole number of milliseconds, injected by event id."""
    return F.when(t["event_id"] % 89 == 0, F.lit("noon")).otherwise(t["ms"].cast("string"))


def _garbled(t: DataFrame, message):
    """Frames cut off, or without any text, injected by event id; the others'
    time is a bare number again (it was text to hold a bad one)."""
    number = F.regexp_replace(message, F.lit('"time":"([0-9]+)"'), F.lit('"time":$1'))
    return (F.when(t["event_id"] % 97 == 0, F.substring(message, 1, 40))
            .when(t["event_id"] % 97 == 1, F.lit(None).cast("string")).otherwise(number))


@register
def valid_rejects(spark, sf_dir):
    """Permissive validation in one pass. Frames that are
    not JSON, lack a model field or have a bad time, and ticks with a bad price
    go to rejects with a reason instead of failing the batch; everything else
    that is no control frame is a valid tick."""
    frames = feeds.kucoin_frames(C.events(spark, sf_dir), price=_dirty_price, best_ask=_missing_ask,
                                 time=_bad_time, text=_garbled)
    return J.kucoin_outcomes(frames, keep=("seq",)).select(
        F.col("seq").alias("event_id"), "symbol", "price", "reason")


@register
def narrow_projection(spark, sf_dir):
    """The decode reads only what the tick transform selects; the model
    check then covers the fields that were read."""
    parsed = D.drop_control_frames(D.parse_kucoin(feeds.kucoin_frames(C.events(spark, sf_dir)),
                                                  schema=SCH.KUCOIN_TICK_SOURCE))
    return C.tick_out(N.split_ticks(N.normalize(D.validate_kucoin(parsed).valid, N.KUCOIN)).valid)


@register
def flatten_ticker(spark, sf_dir):
    """P10/F16: the flat CSV layout of every ticker message (after P5); the
    feed carries frames without ``bestAsk``, which flatten to ''."""
    parsed = D.parse_kucoin(feeds.kucoin_frames(C.events(spark, sf_dir), best_ask=_missing_ask))
    return _flatten(D.keep_messages(parsed))


@register
def flat_csv_roundtrip(spark, sf_dir):
    """K8: the flat layout written as CSV with a header and read back (an empty
    cell reads as null; the layout has none)."""
    root = scratch_path(spark, "flat-csv")
    FS.write_flat_csv(flatten_ticker(spark, sf_dir), root)
    back = spark.read.schema(", ".join(f"{c} string" for c in SCH.FLAT_TICKER_COLUMNS)).option("header", True).csv(root)
    return back.na.fill("")


@register
def tee_roundtrip(spark, sf_dir):
    """The same rows computed once for two sinks, read back from both."""
    root = scratch_path(spark, "tee")
    ticks = C.kucoin_ticks(spark, sf_dir, keep=("seq",)).drop("created_at")
    FS.tee(ticks, lambda d: d.write.parquet(f"{root}/lake"),
           lambda d: d.write.json(f"{root}/log"))
    lake, log = spark.read.parquet(f"{root}/lake"), spark.read.schema(ticks.schema).json(f"{root}/log")
    cols = [F.col("seq").alias("event_id"), "symbol", "price"]
    return (lake.select(F.lit("lake").alias("sink"), *cols).unionByName(log.select(F.lit("log").alias("sink"), *cols)))


@register
def transformed_roundtrip(spark, sf_dir):
    """K2 -> S3: both feeds' raw messages -> one JSON array of ticks per message
    -> decoded again, one row per tick."""
    ev = C.events(spark, sf_dir)
    feeds_ = {"kucoin": feeds.kucoin_frames(ev), "binance": feeds.binance_frames(ev)}
    messages = [KS.tick_messages(J.tick_arrays(s, f)) for s, f in feeds_.items()]
    return C.tick_out(N.split_ticks(D.parse_ticks(N.unify(*messages))).valid)


@register
def event_time_by_source(spark, sf_dir):
    """Event time read from each source's own field of the landed record."""
    k = E.envelope(C.kucoin_records(spark, sf_dir), E.kucoin_record_json(), "kucoin", "ingest_ts")
    b = E.envelope(C.binance_records(spark, sf_dir), E.binance_record_json(), "binance", "ingest_ts")
    env = k.unionByName(b)
    k_ms = F.from_json("data", "data struct<time: bigint>")["data"]["time"]
    b_ms = F.from_json("data", "E bigint")["E"]
    return env.select("source", C.ntz(S.event_time(F.col("source"), k_ms, b_ms)).alias("event_time"))


# ---------------------------------------------------------------- keys

@register
def object_key(spark, sf_dir):
    """landing object name from the ingest time (second resolution)."""
    r = C.kucoin_records(spark, sf_dir)
    return r.select(F.col("seq").alias("event_id"), S.object_name(F.lit("kucoin"), F.col("ingest_ts")).alias("object_key"))


@register
def hourly_key(spark, sf_dir):
    """F8: hourly raw key from the *event* time."""
    r = C.kucoin_records(spark, sf_dir)
    return r.select(F.col("seq").alias("event_id"),
                    S.hourly_key(F.lit("kucoin"), S.millis_to_ts(F.col("ms"))).alias("hour_key"))


@register
def object_overwrite(spark, sf_dir):
    """The tick that survives per hourly object key when writes overwrite."""
    t = C.unified_ticks(spark, sf_dir).withColumn("object_key", S.hourly_key(F.col("source"), F.col("time")))
    won = L.object_overwrite(t, "object_key", ["time", "seq", "pos"], ["symbol", "price", "time"])
    return won.select("object_key", "symbol", "price", C.ntz("time").alias("time"))


# ---------------------------------------------------------------- latest

@register
def current_price(spark, sf_dir):
    """Latest price per (source, symbol) by event time, then arrival order."""
    cur = L.current_price(C.unified_ticks(spark, sf_dir))
    return cur.select("source", "symbol", "price", C.ntz("time").alias("time"))


# ---------------------------------------------------------------- batching

def _symbol_batches(spark, sf_dir, payload=()):
    """A1 per symbol. The batcher checkpoints its input, which stops column
    pruning at that point, so callers name the payload they need."""
    recs = C.kucoin_records(spark, sf_dir).select("subject", "ms", "seq", "pos", *payload)
    return B.assign_batches(recs, ["subject"], "ms", ["seq", "pos"], size=BATCH_SIZE, timeout_ms=BATCH_TIMEOUT_MS)


@register
def micro_batch(spark, sf_dir):
    """A1 + A10: count-or-timeout batches per symbol (exact, anchored)."""
    return B.batch_stats(_symbol_batches(spark, sf_dir), ["subject"], "ms")


@register
def micro_batch_source(spark, sf_dir):
    """A1 + A2: one batcher per feed; each key holds about half of all rows,
    which the range-partitioned batcher splits across tasks."""
    cols = ["source", "ms", "seq", "pos"]
    recs = C.kucoin_records(spark, sf_dir).select(*cols).unionByName(C.binance_records(spark, sf_dir).select(*cols))
    tagged = B.assign_batches(recs, ["source"], "ms", ["seq", "pos"], size=SOURCE_BATCH_SIZE,
                              timeout_ms=SOURCE_BATCH_TIMEOUT_MS)
    return B.batch_stats(tagged, ["source"], "ms")


@register
def micro_batch_feed_symbol(spark, sf_dir):
    """A1 + A2 + A10 over both feeds: one batcher per (source, symbol), the
    default key (batches never mix sources)."""
    cols = ["source", "subject", "ms", "seq", "pos"]
    recs = C.kucoin_records(spark, sf_dir).select(*cols).unionByName(C.binance_records(spark, sf_dir).select(*cols))
    tagged = B.assign_batches(recs, ["source", "subject"], "ms", ["seq", "pos"], size=BATCH_SIZE,
                              timeout_ms=BATCH_TIMEOUT_MS)
    return B.batch_stats(tagged, ["source", "subject"], "ms")


@register
def micro_batch_time_only(spark, sf_dir):
    """A1/A5 as the reference's object batcher is set up: batches of one feed
    that only time closes, anchored at their first record."""
    cols = ["source", "ms", "seq", "pos"]
    recs = C.kucoin_records(spark, sf_dir).select(*cols).unionByName(C.binance_records(spark, sf_dir).select(*cols))
    tagged = B.assign_batches(recs, ["source"], "ms", ["seq", "pos"], size=TIME_ONLY_SIZE,
                              timeout_ms=TIME_ONLY_TIMEOUT_MS)
    return B.batch_stats(tagged, ["source"], "ms")


@register
def micro_batch_aligned(spark, sf_dir):
    """A5: epoch-aligned windows per symbol, cut into chunks of ALIGNED_SIZE."""
    recs = C.kucoin_records(spark, sf_dir).select("subject", "ms", "seq", "pos", "ingest_ts")
    recs = recs.withColumn("event_ts", S.millis_to_ts(F.col("ms")))
    tagged = B.assign_aligned(recs, ["subject"], "event_ts", "ms", ["seq", "pos"], ALIGNED_WINDOW, ALIGNED_SIZE)
    return (tagged.groupBy("subject", "window_start", "chunk")
            .agg(F.count(F.lit(1)).alias("n"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"))
            .select("subject", C.ntz("window_start").alias("window_start"), "chunk", "n", "first_ms", "last_ms"))


@register
def batch_envelope(spark, sf_dir):
    """One JSON-array message per batch, with the first record's
    ingest time and source as the batch's attributes."""
    tagged = _symbol_batches(spark, sf_dir, ("ingest_ts", "source", "msg"))
    msgs = B.batch_messages(tagged, ["subject"], ["batch_id"], F.col("msg"), ["ms", "seq", "pos"],
                            {"first_ingest_ts": "ingest_ts", "source": "source"})
    return msgs.select("subject", "batch_id", "n", "source",
                       C.ntz("first_ingest_ts").alias("first_ingest_ts"),
                       F.size(S.decode_array(F.col("message"), SCH.KUCOIN)).cast("long").alias("n_in_message"))


@register
def array_roundtrip(spark, sf_dir):
    """F13 -> F12 -> A7: batches encoded as JSON arrays, decoded and exploded
    back to one row per record, in batch order."""
    tagged = _symbol_batches(spark, sf_dir, ("msg",))
    msgs = B.batch_messages(tagged, ["subject"], ["batch_id"], F.col("msg"), ["ms", "seq", "pos"], {})
    rows = msgs.select(F.posexplode(S.decode_array(F.col("message"), SCH.KUCOIN)).alias("idx", "m"))
    return rows.select(F.col("m.data.sequence").cast("long").alias("event_id"),
                       F.col("m.subject").alias("subject"),
                       S.parse_price(F.col("m.data.price")).alias("price"),
                       C.ntz(S.millis_to_ts(F.col("m.data.time"))).alias("time"))


# ---------------------------------------------------------------- lake + replay

def _landed(spark, sf_dir) -> str:
    """Land both feeds' validated records (P15 envelopes, flushes by ingest time, K5)."""
    k = E.envelope(C.kucoin_records(spark, sf_dir), E.kucoin_record_json(), "kucoin", "ingest_ts")
    b = E.envelope(C.binance_records(spark, sf_dir), E.binance_record_json(), "binance", "ingest_ts")
    root = scratch_path(spark, "landing")
    LZ.write_landing(LZ.flush_groups(k.unionByName(b), FLUSH_SECONDS), root)
    return root


@register
def replay_ingest_range(spark, sf_dir):
    """Replay Kucoin flushes whose object time is within the
    range (inclusive), then the usual decode + normalise (T8)."""
    root = _landed(spark, sf_dir)
    env = RP.replay_ingest(spark, root, "kucoin", REPLAY_START, REPLAY_END)
    parsed = D.drop_control_frames(D.parse_kucoin(env.select(F.col("data").alias("value"))))
    return C.tick_out(N.split_ticks(N.normalize(D.validate_kucoin(parsed).valid, N.KUCOIN)).valid)


@register
def replay_event_range(spark, sf_dir):
    """H10 event-time replay over the tick lake (K6 layout, pruned by hour)."""
    root = scratch_path(spark, "ticks")
    LZ.write_ticks(C.unified_ticks(spark, sf_dir).drop("seq", "pos"), root)
    return C.tick_out(RP.replay_event(spark, root, REPLAY_START, REPLAY_END))


def _objects(spark, sf_dir) -> str:
    """Both feeds' records as objects under their public names, with a manifest."""
    cols = ("seq", "pos", "event_ms")
    k = C.kucoin_records(spark, sf_dir).withColumnRenamed("ms", "event_ms")
    b = C.binance_records(spark, sf_dir).withColumnRenamed("ms", "event_ms")
    env = E.envelope(k, E.kucoin_record_json(), "kucoin", "ingest_ts", keep=cols).unionByName(
        E.envelope(b, E.binance_record_json(), "binance", "ingest_ts", keep=cols))
    root = scratch_path(spark, "objects")
    OS.write_objects(LZ.flush_groups(env, OBJECT_SECONDS), root, ("ingest_ts", "event_ms", "seq", "pos"))
    return root


@register
def object_scan(spark, sf_dir):
    """Objects written under their public names, listed by name, and
    read by the range of their names. The bounds are names that exist, so both
    ends must be inclusive; files that are no object's lie among them."""
    root = _objects(spark, sf_dir)
    first = OB.listed(spark, root, ["kucoin"]).agg(F.min("object_key")).first()[0]
    if first:
        text = FF.read_small(spark, f"{root}/{first}")
        for name in ("note.txt", "2024-13-07T00-00-00.json", "2024-01-12T00-00-00.json.bak", "latest.json"):
            FF.write_new(spark, f"{root}/kucoin/{name}", text)
    ticks = []
    for source, spec, check in (("kucoin", N.KUCOIN, D.validate_kucoin), ("binance", N.BINANCE, D.validate_binance)):
        inside = RP.list_objects(spark, root, source, REPLAY_START, REPLAY_END)
        low, high = inside.agg(F.min("file_time"), F.max("file_time")).first()
        if low is None:
            continue
        rows = RP.read_objects(spark, root, source, low, high)
        key = F.concat(F.lit(f"{source}/"), F.col("object_name"))
        ticks.append(N.normalize(check(rows).valid.withColumn("object_key", key), spec, keep=("object_key",)))
    if not ticks:
        return spark.createDataFrame([], "object_key string, symbol string, price double, time timestamp_ntz")
    found = N.split_ticks(N.unify(*ticks)).valid
    return found.select("object_key", "symbol", "price", C.ntz("time").alias("time"))


@register
def object_manifest(spark, sf_dir):
    """What the manifest says of every object: its records, their span of
    event time, and whether the object is as long as it says."""
    root = _objects(spark, sf_dir)
    there = OB.listed(spark, root, ["kucoin", "binance"]).select("object_key", "length")
    return OB.read_manifest(spark, root).join(there, "object_key", "full").select(
        "object_key", "rows", "first_event_ms", "last_event_ms", (F.col("bytes") == F.col("length")).alias("whole"))


@register
def object_manifest_replay(spark, sf_dir):
    """Replay by event time through the manifest; only objects whose
    span touches the range are opened."""
    root = _objects(spark, sf_dir)
    ticks = []
    for source, spec, check in (("kucoin", N.KUCOIN, D.validate_kucoin), ("binance", N.BINANCE, D.validate_binance)):
        rows = OB.replay_objects(spark, root, source, REPLAY_START, REPLAY_END)
        if rows is not None:
            ticks.append(N.normalize(check(rows).valid, spec))
    if not ticks:
        return spark.createDataFrame([], "symbol string, price double, time timestamp_ntz, source string")
    return C.tick_out(N.split_ticks(N.unify(*ticks)).valid)


# ---------------------------------------------------------------- gaps

def _ms(text: str) -> int:
    return int(RP._ts(text).replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)


def _outage(spark, sf_dir):
    """The whole feed, and what is left of it with each source's outage."""
    ticks = C.unified_ticks(spark, sf_dir)
    lost = F.lit(False)
    for source, (start, end) in OUTAGES.items():
        lost = lost | ((F.col("source") == source) & F.col("time").between(
            F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return ticks, ticks.where(~lost)


def _gaps(partial):
    return G.find_gaps(partial.withColumn("ms", F.unix_millis("time")), ["source", "symbol"], "ms", TOLERATED_MS,
                       (_ms(SPAN[0]), _ms(SPAN[1])))


@register
def gap_intervals(spark, sf_dir):
    """Silences per source and symbol longer than tolerated, in a feed that
    lost a middle part (Kucoin) and its end (Binance)."""
    return _gaps(_outage(spark, sf_dir)[1]).select("source", "symbol", "after_ms", "before_ms", "silence_ms")


@register
def gap_ranges(spark, sf_dir):
    """The gaps of all symbols of a source merged into ranges to replay."""
    return G.merge_ranges(_gaps(_outage(spark, sf_dir)[1]), ["source"])


def _filled(spark, sf_dir):
    """The partial feed and what a replay of its gaps alone brings back."""
    root = scratch_path(spark, "gap-fill")
    whole, partial = _outage(spark, sf_dir)
    LZ.write_ticks(whole, f"{root}/lake")
    partial.write.parquet(f"{root}/partial")
    partial = spark.read.schema(partial.schema).parquet(f"{root}/partial")
    gaps = _gaps(partial)
    gaps.write.parquet(f"{root}/gaps")
    found = G.replay_gaps(spark, f"{root}/lake", spark.read.schema(gaps.schema).parquet(f"{root}/gaps"))
    return root, partial, found


@register
def gap_fill(spark, sf_dir):
    """The feed with its gaps filled is the whole feed, each tick once."""
    _, partial, found = _filled(spark, sf_dir)
    rows = C.tick_out(partial)
    return rows if found is None else rows.unionByName(C.tick_out(found))


@register
def gap_fill_current(spark, sf_dir):
    """T8 + K7: the current-price table of the partial feed, after the gaps' ticks
    are folded in, is that of the whole feed."""
    root, partial, found = _filled(spark, sf_dir)
    CUR.fold_ticks(partial, f"{root}/snapshot")
    if found is not None:
        CUR.fold_ticks(found.select(*partial.columns), f"{root}/snapshot")
    snap = CUR.read_snapshot(spark, f"{root}/snapshot")
    return snap.select("source", "symbol", "price", C.ntz("time").alias("time"))


# ---------------------------------------------------------------- history

def _history(spark, sf_dir) -> str:
    """The unified feed merged into the history in three parts that know no order."""
    root = scratch_path(spark, "history")
    ticks = C.unified_ticks(spark, sf_dir)
    for part in range(3):
        HI.merge_history(ticks.where(F.pmod(F.xxhash64("symbol", "time", "seq", "pos"), F.lit(3)) == part), root)
    return root


@register
def price_at_instants(spark, sf_dir):
    """Every symbol's price at given instants, from a history that was
    merged out of order."""
    at = spark.sql("select explode(array(" + ", ".join(f"timestamp'{t}'" for t in INSTANTS) + ")) as at")
    rows = HI.price_at(spark, _history(spark, sf_dir), at)
    return rows.select(C.ntz("at").alias("instant"), "source", "symbol", "price", C.ntz("time").alias("time"))


@register
def price_intervals(spark, sf_dir):
    """The intervals in which each price held."""
    rows = HI.intervals(spark, _history(spark, sf_dir))
    return rows.select("source", "symbol", "price", C.ntz("valid_from").alias("valid_from"), C.ntz("valid_to").alias("valid_to"))


# ---------------------------------------------------------------- whole messages, dead letters

def _raw_messages(spark, sf_dir):
    """Kucoin messages of MESSAGE_RECORDS events, with faults of every kind."""
    t = feeds.kucoin_frames(C.events(spark, sf_dir), control_types=(), best_ask=_missing_ask, time=_bad_time)
    number = F.regexp_replace("value", F.lit('"time":"([0-9]+)"'), F.lit('"time":$1'))
    element = F.when(F.col("seq") % 61 == 7, F.lit("7")).when(F.col("seq") % 67 == 3, F.lit("null")).otherwise(number)
    by = F.floor(F.col("seq") / MESSAGE_RECORDS).alias("message")
    rows = t.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("seq", element.alias("text")))).alias("_e"))
    inner = F.array_join(F.transform("_e", lambda e: e["text"]), ", ")
    n = F.col("message")
    value = (F.when(n % 37 == 5, F.concat(F.lit('{"records": ['), inner, F.lit("]}")))
             .when(n % 41 == 6, F.concat(F.lit("["), inner)).when(n % 43 == 7, F.lit("[]"))
             .otherwise(F.concat(F.lit("["), inner, F.lit("]"))))
    return rows.select("message", F.floor(n / 8).alias("poll"), S.utf8_encode(value).alias("value"))


@register
def atomic_messages(spark, sf_dir):
    """Messages as a consumer gets them (bytes): each is valid with all its
    records, or rejected for its first bad element."""
    rows = M.check_messages(_raw_messages(spark, sf_dir))
    return rows.select("message", F.size("texts").cast("long").alias("records"), "bad_pos", "reason")


@register
def atomic_ticks(spark, sf_dir):
    """The ticks of the valid messages, and of no others."""
    valid = M.split_messages(M.check_messages(_raw_messages(spark, sf_dir))).valid
    return C.tick_out(N.split_ticks(N.normalize(valid, N.KUCOIN)).valid)


@register
def atomic_polls(spark, sf_dir):
    """One bad message rejects the whole poll it came in."""
    rows = M.reject_polls(M.check_messages(_raw_messages(spark, sf_dir)), ["poll"])
    return rows.select("message", "poll", F.size("texts").cast("long").alias("records"), "reason")


def _mixed_envelopes(spark, sf_dir):
    """Landed records of both feeds; some name a source without a rule or none,
    some are cut off."""
    ev = C.events(spark, sf_dir)
    k = D.keep_messages(D.parse_kucoin(feeds.kucoin_frames(ev, price=_dirty_price)))
    b = C.binance_records(spark, sf_dir).withColumn("seq", F.col("el.quote_volume").cast("long"))
    env = E.envelope(k, E.kucoin_record_json(), "kucoin", "ingest_ts", keep=("seq",)).unionByName(
        E.envelope(b, E.binance_record_json(), "binance", "ingest_ts", keep=("seq",)))
    seq = F.col("seq")
    source = (F.when(seq % 50 == 3, F.lit("kraken")).when(seq % 50 == 4, F.lit(None).cast("string"))
              .otherwise(F.col("source")))
    data = F.when(seq % 53 == 9, F.substring("data", 1, 20)).otherwise(F.col("data"))
    return env.select("seq", "ingest_ts", F.col("source").alias("feed"), source.alias("source"), data.alias("data"))


@register
def dead_letter_routing(spark, sf_dir):
    """Every landed record's outcome in one pass; an unknown source is a dead
    letter, not a failed job."""
    rows = RT.route(_mixed_envelopes(spark, sf_dir))
    return rows.select("feed", F.col("seq").alias("event_id"), "outcome", "source", "symbol", "price", "reason")


# ---------------------------------------------------------------- streaming twins

@register
def stream_dead_letter(spark, sf_dir):
    """P6 on a stream: one query writes every outcome to a folder of its own; the
    dead letters are routed again once their source has a rule."""
    from tickloom.plans import streams
    return streams.stream_dead_letter(spark, sf_dir)


@register
def stream_normalize(spark, sf_dir):
    """Structured Streaming: both feeds, file source -> transforms -> Parquet sink."""
    from tickloom.plans import streams
    return streams.stream_normalize(spark, sf_dir)


@register
def stream_micro_batch(spark, sf_dir):
    """Structured Streaming A1: applyInPandasWithState per symbol."""
    from tickloom.plans import streams
    return streams.stream_micro_batch(spark, sf_dir, BATCH_SIZE, BATCH_TIMEOUT_MS)


@register
def stream_current_price(spark, sf_dir):
    """Structured Streaming K7: foreachBatch upsert into the current-price snapshot."""
    from tickloom.plans import streams
    return streams.stream_current_price(spark, sf_dir)


@register
def stream_current_price_backfill(spark, sf_dir):
    """K7 + T8: the stream misses a range; backfills from the tick lake, before,
    between and after its micro-batches and a restart with a new checkpoint,
    leave the same table as the whole feed."""
    from tickloom.plans import streams
    return streams.stream_current_price_backfill(spark, sf_dir, REPLAY_START, REPLAY_END)


@register
def stream_load_current(spark, sf_dir):
    """S3 -> K7: transformed messages as text files -> loader -> current price."""
    from tickloom.plans import streams
    return streams.stream_load_current(spark, sf_dir)


@register
def stream_landing(spark, sf_dir):
    """K5 + T6: the landing sink over both feeds, with a micro-batch written
    twice; records per source as read back from the zone."""
    from tickloom.plans import streams
    return streams.stream_landing(spark, sf_dir, FLUSH_SECONDS)


@register
def stream_micro_batch_hot(spark, sf_dir):
    """A1/A2 on a stream with two hot keys: no task folds a key whole, and a
    trigger that runs again changes nothing."""
    from tickloom.plans import streams
    return streams.stream_micro_batch_hot(spark, sf_dir, SOURCE_BATCH_SIZE, SOURCE_BATCH_TIMEOUT_MS)


@register
def stream_idle_flush(spark, sf_dir):
    """A6 on a stream: batches that size, time or a key's silence closes, on the
    clock of arrival."""
    from tickloom.plans import streams
    return streams.stream_idle_flush(spark, sf_dir, BATCH_SIZE, BATCH_TIMEOUT_MS, IDLE_MS)


@register
def stream_price_state(spark, sf_dir):
    """K7 as keyed state: a trigger costs the keys it changes."""
    from tickloom.plans import streams
    return streams.stream_price_state(spark, sf_dir)


@register
def stream_produce_once(spark, sf_dir):
    """T6 + K1: messages that a broken-off micro-batch sent twice are read once."""
    from tickloom.plans import streams
    return streams.stream_produce_once(spark, sf_dir)
