"""Routing landed records by source with a dead-letter output.

Every record gets one outcome in one pass: a ``tick`` of its source, ``other``
(a quote currency the ticks leave out), a ``reject`` that breaks its source's
model, or ``unknown`` where no rule exists for its source. An unknown source is an
error of the record, never of the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas as S
from tickloom.functions.scalar import has_quote, millis_to_ts, parse_price, strip_hyphens
from tickloom.operators.messages import starts

TICK, OTHER, REJECT, UNKNOWN = "tick", "other", "reject", "unknown"


@dataclass(frozen=True)
class Route:
    """How a source's record (JSON text) is read: its schema, the fields its model
    needs, and where symbol, price and event time are, as positions."""
    schema: T.StructType
    required: tuple[str, ...]
    symbol: str
    price: str
    millis: str
    hyphenated: bool = False


def _named(array: T.ArrayType) -> T.StructType:
    return array.elementType


#: Binance's e and E differ by case only: records are read by the wire schema and
#: renamed by position.
ROUTES = {
    "kucoin": Route(S.KUCOIN, S.KUCOIN_REQUIRED, "subject", "data.price", "data.time", hyphenated=True),
    "binance": Route(_named(S.BINANCE_WIRE), S.BINANCE_REQUIRED, "symbol", "close", "event_time"),
}


def _field(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record[name]
    return record


def _read(name: str, route: Route, data: Column) -> Column:
    """What a source's record gives, as a struct; null if it is no JSON object."""
    # under an array schema a lone object is one element, and text cut off is null
    record = F.get(F.from_json(data, T.ArrayType(route.schema)), F.lit(0))
    if name == "binance":
        record = record.cast(_named(S.BINANCE_NAMED))
    return F.when(starts(data, "{"), record)


def _fields(route: Route, record: Column) -> Column:
    symbol = _field(record, route.symbol)
    lacks = F.lit(None).cast("string")
    for path in reversed(route.required):
        lacks = F.when(_field(record, path).isNull(), F.lit(path)).otherwise(lacks)
    return F.when(record.isNotNull(), F.struct(
        (strip_hyphens(symbol) if route.hyphenated else symbol).alias("symbol"),
        parse_price(_field(record, route.price)).alias("price"), _field(record, route.millis).alias("ms"),
        lacks.alias("lacks")))


def route(envelopes: DataFrame, routes: dict[str, Route] | None = None) -> DataFrame:
    """Envelope rows (``data, source`` and others) plus ``outcome, symbol, price,
    time, reason``; works on streams alike. ``data`` stays, so that a dead letter
    can be routed again once its source has a rule.

    A record is parsed once, by its own source's rule: the parse stands inside a
    generator (of one row each), so that no expression above it brings a copy."""
    routes = routes or ROUTES
    rest = [c for c in envelopes.columns if c not in ("outcome", "symbol", "price", "time", "reason")]
    known, source = F.lit(False), F.col("source")
    records, fields = [], F.lit(None)
    for i, (name, r) in enumerate(routes.items()):
        mine = F.coalesce(source == name, F.lit(False))
        records.append(_read(name, r, F.when(mine, F.col("data"))).alias(f"r{i}"))
        fields = F.when(mine, _fields(r, F.col(f"_records.r{i}"))).otherwise(fields)
        known = known | mine
    rows = envelopes.select(*rest, F.explode_outer(F.array(F.struct(*records))).alias("_records"))
    rows = rows.select(*rest, known.alias("_known"), F.explode_outer(F.array(fields)).alias("_f"))
    symbol, price, lacks = F.col("_f.symbol"), F.col("_f.price"), F.col("_f.lacks")
    broken = F.col("_f").isNull() | lacks.isNotNull()
    quoted = has_quote(symbol)
    outcome = (F.when(~F.col("_known"), F.lit(UNKNOWN)).when(broken, F.lit(REJECT)).when(~quoted, F.lit(OTHER))
               .when(price.isNull(), F.lit(REJECT)).otherwise(F.lit(TICK)))
    reason = (F.when(~F.col("_known"), F.concat(F.lit("unknown source: "), F.coalesce("source", F.lit("null"))))
              .when(F.col("_f").isNull(), F.lit("malformed"))
              .when(lacks.isNotNull(), F.concat(F.lit("missing:"), lacks))
              .when(quoted & price.isNull(), F.lit("bad:price")))
    kept = F.col("_known") & ~broken & (~quoted | price.isNotNull())
    return rows.select(*rest, outcome.alias("outcome"), F.when(kept, symbol).alias("symbol"), F.when(kept, price).alias("price"),
                       F.when(kept, millis_to_ts(F.col("_f.ms"))).alias("time"), reason.alias("reason"))


def write_routes(routed: DataFrame, root: str) -> None:
    """All outcomes in one pass, a folder each."""
    routed.write.mode("append").partitionBy("outcome").parquet(root)


def read_route(spark, root: str, outcome: str, schema: T.StructType) -> DataFrame:
    """One output; empty if nothing had that outcome."""
    return spark.read.schema(schema).parquet(root).where(F.col("outcome") == outcome)
