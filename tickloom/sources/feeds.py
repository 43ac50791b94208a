"""Raw exchange feeds derived from the ``events`` table.

The reference reads live WebSocket frames; here the frames are produced by a
Spark job over ``events`` (FIXTURES 5), so every downstream operator works on
the real wire format and its cost grows with the table. A frame row looks like
a Kafka/text-source row: ``value`` (JSON text), ``ingest_ts`` (arrival time)
and ``seq`` (arrival order). Only executors touch the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import ts_to_millis

# Fixed mapping of the fixture (FIXTURES 5): quote currency by user_id % 4.
FIXTURE_QUOTES = ("USDT", "USDC", "BTC", "ETH")
KUCOIN_TOPIC = "/market/ticker:all"
BINANCE_EVENT = "24hrMiniTicker"
# Event types that bring a Kucoin control frame ("welcome" / "ack") besides
# their message.
CONTROL_EVENT_TYPES = ("error",)
# Events whose id is divisible by this carry the time of their full hour: ties
# at one millisecond, and records that are older than what came before them.
TIE_EVERY, HOUR_MS = 5, 3_600_000
# Users whose id is divisible by this trade a base with a hyphen of its own.
HYPHEN_EVERY = 7
BINANCE_FRAME_MS = HOUR_MS
# About how many tickers a Binance message carries.
FRAME_ELEMENTS = 64


def _base(ev: DataFrame) -> Column:
    return F.upper(ev["event_type"])


def _quote(ev: DataFrame) -> Column:
    return F.element_at(F.array(*[F.lit(q) for q in FIXTURE_QUOTES]),
                        (ev["user_id"] % len(FIXTURE_QUOTES)).cast("int") + 1)


def _ms(ev: DataFrame) -> Column:
    return ts_to_millis(ev["ts"])


def fixture_ticks(events: DataFrame) -> DataFrame:
    """The fields every feed is built from: one row per event."""
    return events.select(
        "event_id",
        "event_type",
        "value",
        _base(events).alias("base"),
        F.when(events["user_id"] % HYPHEN_EVERY == 0,
               F.concat(F.substring(_base(events), 1, 2), F.lit("-"), F.substring(_base(events), 3, 100)))
        .otherwise(_base(events)).alias("hyphenated"),
        _quote(events).alias("quote"),
        events["value"].cast("string").alias("price_text"),
        events["user_id"].cast("string").alias("size_text"),
        F.when(events["event_id"] % TIE_EVERY == 0, _ms(events) - F.pmod(_ms(events), F.lit(HOUR_MS)))
        .otherwise(_ms(events)).alias("ms"),
        events["ts"].cast("timestamp").alias("ingest_ts"),
    )


def kucoin_frames(events: DataFrame, control_types=CONTROL_EVENT_TYPES,
                  price=None, best_ask=None, notices: bool = False, time=None, text=None) -> DataFrame:
    """One Kucoin text frame per event, a ticker message with one field that the
    model does not know (P13), and besides it a control frame (``welcome`` /
    ``ack``) for the event types in ``control_types``.

    ``price``, ``best_ask`` and ``time`` map the fixture rows to overriding
    values (used to inject bad prices and times, or a missing field: a null is
    left out of the JSON); ``text`` maps the rows and the finished text to the
    text sent. With ``notices``, every third control frame is a ``notice`` that
    carries ``subject`` and ``data`` (kept by P4, dropped by P5).
    """
    t = fixture_ticks(events)
    price_col = t["price_text"] if price is None else price(t)
    ask_col = t["price_text"] if best_ask is None else best_ask(t)
    data = F.struct(
        ask_col.alias("bestAsk"),
        t["size_text"].alias("bestAskSize"),
        t["price_text"].alias("bestBid"),
        t["size_text"].alias("bestBidSize"),
        price_col.alias("price"),
        t["event_id"].cast("string").alias("sequence"),
        t["size_text"].alias("size"),
        (t["ms"] if time is None else time(t)).alias("time"),
        F.lit("new").alias("marketState"),
    )
    is_control = t["event_type"].isin(*control_types) if control_types else F.lit(False)
    is_notice = is_control & (t["event_id"] % 3 == 0) if notices else F.lit(False)
    def frame(kind: str) -> Column:
        return F.to_json(F.struct(
            F.lit(KUCOIN_TOPIC).alias("topic"), F.lit(kind).alias("type"),
            F.concat(t["hyphenated"], F.lit("-"), t["quote"]).alias("subject"), data.alias("data")))

    message = frame("message") if text is None else text(t, frame("message"))
    control = F.to_json(F.struct(
        t["event_id"].cast("string").alias("id"),
        F.when(t["event_id"] % 2 == 0, F.lit("welcome")).otherwise(F.lit("ack")).alias("type"),
    ))
    control = F.when(is_notice, frame("notice")).otherwise(control)
    return t.select(
        F.explode(F.when(is_control, F.array(control, message)).otherwise(F.array(message))).alias("value"),
        "ingest_ts",
        t["event_id"].alias("seq"),
    )


def binance_frames(events: DataFrame, frame_ms: int = BINANCE_FRAME_MS,
                   elements: int = FRAME_ELEMENTS) -> DataFrame:
    """Binance text frames: the tickers of each ``frame_ms`` of event time (the
    exchange pushes lists of them), in messages of about ``elements`` each, which
    arrive together. A frame's messages are cut along the event ids into equal
    ranges, as many as its count asks for, so a message does not grow with the
    table; elements are ordered by ``(ms, event_id)``, messages by their first id.
    """
    t = fixture_ticks(events)
    element = F.struct(
        F.lit(BINANCE_EVENT).alias("e"),
        t["ms"].alias("E"),
        F.concat(t["base"], t["quote"]).alias("s"),
        t["price_text"].alias("c"),
        t["price_text"].alias("o"),
        t["price_text"].alias("h"),
        t["price_text"].alias("l"),
        t["size_text"].alias("v"),
        t["event_id"].cast("string").alias("q"),
    )
    keyed = t.select(
        F.floor(t["ms"] / frame_ms).alias("frame"),
        F.struct(t["ms"].alias("ms"), t["event_id"].alias("id"), element.alias("el")).alias("k"),
        "event_id",
    )
    # one row per frame of time, whatever the table's size
    spans = t.groupBy(F.floor(t["ms"] / frame_ms).alias("frame")).agg(
        F.max("ingest_ts").alias("ingest_ts"), F.min("event_id").alias("_low"),
        F.ceil((F.max("event_id") - F.min("event_id") + 1) * elements / F.count(F.lit(1))).alias("_width"))
    part = F.floor((F.col("event_id") - F.col("_low")) / F.col("_width"))
    frames = keyed.join(spans, "frame").groupBy("frame", "ingest_ts", part.alias("_part")).agg(
        F.array_sort(F.collect_list("k")).alias("ks"),
        F.min("event_id").alias("seq"),
    )
    return frames.select(
        F.to_json(F.transform("ks", lambda k: k["el"])).alias("value"),
        "ingest_ts",
        "seq",
    )
