"""Normalisation of decoded frames into the canonical tick.

A feed is described by a small spec: where the symbol, price text and event
time live, how the symbol is cleaned, and the source label. Both exchanges go
through the same expression; only the spec differs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import (DEFAULT_QUOTES, has_quote, millis_to_ts, now, parse_price,
                                       strip_hyphens)
from tickloom.operators.decode import Split


@dataclass(frozen=True)
class FeedSpec:
    source: str
    symbol: str            # path of the raw symbol field
    price: str             # path of the price text
    millis: str            # path of the event time (epoch ms)
    hyphenated: bool = False
    quotes: tuple[str, ...] = field(default=DEFAULT_QUOTES)


KUCOIN = FeedSpec("kucoin", "msg.subject", "msg.data.price", "msg.data.time", hyphenated=True)
BINANCE = FeedSpec("binance", "el.symbol", "el.close", "el.event_time")

TICK_OUT = ("symbol", "price", "time", "source", "created_at")


def _symbol(spec: FeedSpec) -> Column:
    raw = F.col(spec.symbol)
    return strip_hyphens(raw) if spec.hyphenated else raw


def tick_columns(spec: FeedSpec, price_type: str = "double") -> list[Column]:
    return [
        _symbol(spec).alias("symbol"),
        parse_price(F.col(spec.price), as_float=(price_type == "float")).alias("price"),
        millis_to_ts(F.col(spec.millis)).alias("time"),
        F.lit(spec.source).alias("source"),
        now().alias("created_at"),   # required by the tick model (hazard H3)
    ]


def normalize(decoded: DataFrame, spec: FeedSpec, price_type: str = "double",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Decoded rows -> ticks of one feed: quote filter (P3), hyphen removal
    (F1), price parse (F3/F4), ms -> timestamp (F5), constant source (P8),
    final selection (P9). Rows with an unusable price/time are kept here with
    nulls; :func:`split_ticks` routes them to rejects.

    The filter is written on the cleaned symbol before the projection, so
    Catalyst evaluates it first and can push it into a Parquet scan when the
    input is a stored table.
    """
    cols = tick_columns(spec, price_type)
    extra = [F.col(c) for c in keep]
    return (decoded.where(has_quote(_symbol(spec), spec.quotes))
            .select(*cols, *extra))


def tick_reason() -> Column:
    """The not-null constraint of the current-price table, as a reason."""
    return (F.when(F.col("symbol").isNull(), F.lit("null:symbol"))
            .when(F.col("price").isNull(), F.lit("bad:price"))
            .when(F.col("time").isNull(), F.lit("bad:time"))
            .when(F.col("source").isNull(), F.lit("null:source")))


def outcomes(decoded: DataFrame, spec: FeedSpec, model_reason: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every decoded row's fate in one pass: a tick (``reason`` null) or a reject
    with its reason and ``raw`` text. Records of other quote currencies (P3) are
    neither and are left out. A record that breaks its model has no tick."""
    rows = decoded.withColumn("_model", model_reason)
    rows = rows.where(F.col("_model").isNotNull() | has_quote(_symbol(spec), spec.quotes))
    rows = rows.select(*tick_columns(spec), *keep, "raw", "_model")
    good = F.col("_model").isNull()
    return rows.select(F.when(good, F.col("symbol")).alias("symbol"), F.when(good, F.col("price")).alias("price"),
                       F.when(good, F.col("time")).alias("time"), "source", "created_at", *keep, "raw",
                       F.coalesce("_model", tick_reason()).alias("reason"))


def split_outcomes(rows: DataFrame) -> Split:
    """The ticks, and the rejects with their raw text, of :func:`outcomes`."""
    extra = [c for c in rows.columns if c not in (*TICK_OUT, "raw", "reason")]
    return Split(rows.where(F.col("reason").isNull()).drop("raw", "reason"),
                 rows.where(F.col("reason").isNotNull()).select("source", "raw", "reason", *extra))


def tick_array(elements: Column, record: str, spec: FeedSpec, required) -> Column:
    """K2: the valid ticks of one decoded frame (an array of records), as an
    array: filter and projection inside the row, no explode and no grouping.
    ``record`` is the name under which ``spec`` addresses a record."""
    def field(x: Column, path: str) -> Column:
        for name in path.removeprefix(f"{record}.").split("."):
            x = x[name]
        return x

    def symbol(x):
        raw = field(x, spec.symbol)
        return strip_hyphens(raw) if spec.hyphenated else raw

    def valid(x):
        ok = has_quote(symbol(x), spec.quotes) & parse_price(field(x, spec.price)).isNotNull()
        for path in required:
            ok = ok & field(x, path).isNotNull()
        return ok

    def tick(x):
        return F.struct(symbol(x).alias("symbol"), parse_price(field(x, spec.price)).alias("price"),
                        millis_to_ts(field(x, spec.millis)).alias("time"), F.lit(spec.source).alias("source"),
                        now().alias("created_at"))

    return F.transform(F.filter(elements, valid), tick)


def split_ticks(ticks: DataFrame) -> Split:
    """The not-null constraint of the current-price table, as a split."""
    tagged = ticks.withColumn("reason", tick_reason())
    return Split(tagged.where(F.col("reason").isNull()).drop("reason"),
                 tagged.where(F.col("reason").isNotNull()))


def unify(*ticks: DataFrame) -> DataFrame:
    """T4: one feed from several sources with the same tick schema."""
    out = ticks[0]
    for t in ticks[1:]:
        out = out.unionByName(t)
    return out
