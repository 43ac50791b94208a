"""Raw and canonical schemas.

The wire field names and the CSV column order are fixed values: they are the
exchanges' and must match for frames to decode.
"""

from pyspark.sql import types as T

KUCOIN_DATA = T.StructType([
    T.StructField("bestAsk", T.StringType()),
    T.StructField("bestAskSize", T.StringType()),
    T.StructField("bestBid", T.StringType()),
    T.StructField("bestBidSize", T.StringType()),  # on the wire; kept (nullable)
    T.StructField("price", T.StringType()),
    T.StructField("sequence", T.StringType()),
    T.StructField("size", T.StringType()),
    T.StructField("time", T.LongType()),           # epoch milliseconds
])

KUCOIN = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("data", KUCOIN_DATA),
])

# Fields the Kucoin ticker model requires (bestBidSize is optional on our side).
KUCOIN_REQUIRED = ("topic", "type", "subject", "data.bestAsk", "data.bestAskSize", "data.bestBid",
                   "data.price", "data.sequence", "data.size", "data.time")

# Binance carries `e` (event type) and `E` (event time); the names differ only
# by case (hazard H1). JSON keys match schema fields case-sensitively, so one
# parse with the wire schema is exact; the result is then cast positionally to
# friendly names, so no code ever resolves `e`/`E` by name.
BINANCE_WIRE = T.ArrayType(T.StructType([
    T.StructField("e", T.StringType()),
    T.StructField("E", T.LongType()),              # epoch milliseconds
    T.StructField("s", T.StringType()),
    T.StructField("c", T.StringType()),
    T.StructField("o", T.StringType()),
    T.StructField("h", T.StringType()),
    T.StructField("l", T.StringType()),
    T.StructField("v", T.StringType()),
    T.StructField("q", T.StringType()),
]))
# Friendly names, in wire order.
BINANCE_RENAMES = (("e", "event_type"), ("E", "event_time"), ("s", "symbol"), ("c", "close"),
                   ("o", "open"), ("h", "high"), ("l", "low"), ("v", "base_volume"),
                   ("q", "quote_volume"))
BINANCE_NAMED = T.ArrayType(T.StructType([
    T.StructField(dst, f.dataType) for (src, dst), f in zip(BINANCE_RENAMES, BINANCE_WIRE.elementType.fields)]))
BINANCE_REQUIRED = tuple(name for _, name in BINANCE_RENAMES)
# Narrow schemas used by the tick transforms (P1): only what is selected.
KUCOIN_TICK_SOURCE = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("price", T.StringType()),
        T.StructField("sequence", T.StringType()),
        T.StructField("time", T.LongType()),
    ])),
])

TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# Fixed value: how a tick's timestamps stand in a transformed message.
TICK_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Times in landed JSON lines, to the microsecond.
LANDING_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Flat CSV layout of a Kucoin message (P10).
FLAT_TICKER_COLUMNS = ("topic", "type", "subject", "bestAsk", "bestAskSize", "bestBid",
                       "bestBidSize", "price", "sequence", "size", "time")
