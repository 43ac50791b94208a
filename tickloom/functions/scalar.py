"""Scalar column functions F1-F17.

Each helper returns a ``Column`` built from ``pyspark.sql.functions`` only, so
it stays inside whole-stage codegen and Catalyst can prune and push around it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Quote currencies kept by the tick transforms (code keeps both, docs say USDT).
DEFAULT_QUOTES = ("USDT", "USDC")
# Object name of a landing batch: second-resolution UTC time of its first item.
OBJECT_TIME_PATTERN = "yyyy-MM-dd'T'HH-mm-ss"
OBJECT_NAME_REGEX = r"(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2})\.json$"
# Hourly key: raw/{source}/YYYY/MM/DD/HH/data_YYYYMMDDTHH.json.gz
HOURLY_DIR_PATTERN = "yyyy/MM/dd/HH"
HOURLY_STAMP_PATTERN = "yyyyMMdd'T'HH"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_hyphens(subject) -> Column:
    """remove every '-' (``X-Y-USDC`` -> ``XYUSDC``). A plain string
    replace: same result as the regex form, without the regex engine."""
    return F.replace(_c(subject), F.lit("-"), F.lit(""))


def has_quote(symbol, quotes: Iterable[str] = DEFAULT_QUOTES) -> Column:
    """Case-sensitive suffix test against the quote list; null -> false."""
    s = _c(symbol)
    cond = F.lit(False)
    for q in quotes:
        cond = cond | s.endswith(q)
    return F.coalesce(cond, F.lit(False))


def parse_price(text, as_float: bool = False) -> Column:
    """decimal text -> DOUBLE, never throwing (hazard H4).

    ``try_cast`` gives null for garbage; NaN and +-Infinity parse in Spark but
    are not prices, so they become null as well. ``as_float`` reproduces the
    old float32 rounding of the Kucoin transform (hazard H2).
    """
    d = _c(text).try_cast("double")
    if as_float:
        d = d.try_cast("float").cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(d)


def millis_to_ts(ms) -> Column:
    """epoch milliseconds -> TIMESTAMP (exact, no double division)."""
    return F.timestamp_millis(_c(ms))


def ts_to_millis(ts) -> Column:
    """Inverse of F5 for TIMESTAMP or TIMESTAMP_NTZ input (session TZ is UTC)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def event_millis(source, kucoin_ms, binance_ms) -> Column:
    """per-source path to the event time; an unknown source is an error."""
    s = _c(source)
    return (F.when(s == "kucoin", _c(kucoin_ms))
            .when(s == "binance", _c(binance_ms))
            .otherwise(F.raise_error(F.concat(F.lit("no event-time rule for source "), F.coalesce(s, F.lit("null"))))
                       .cast("bigint")))


def event_time(source, kucoin_ms, binance_ms) -> Column:
    """F6 as a timestamp."""
    return millis_to_ts(event_millis(source, kucoin_ms, binance_ms))


def object_name(source, ts) -> Column:
    """``{source}/YYYY-MM-DDTHH-MM-SS.json`` (truncates to the second)."""
    return F.concat(_c(source), F.lit("/"), F.date_format(_c(ts), OBJECT_TIME_PATTERN), F.lit(".json"))


def hourly_key(source, ts) -> Column:
    """F8: ``raw/{source}/YYYY/MM/DD/HH/data_YYYYMMDDTHH.json.gz`` from event time."""
    t = _c(ts)
    return F.concat(F.lit("raw/"), _c(source), F.lit("/"), F.date_format(t, HOURLY_DIR_PATTERN),
                    F.lit("/data_"), F.date_format(t, HOURLY_STAMP_PATTERN), F.lit(".json.gz"))


def key_time_text(path) -> Column:
    """the time text of an object name; null when the name does not match."""
    return F.nullif(F.regexp_extract(_c(path), OBJECT_NAME_REGEX, 1), F.lit(""))


def key_time(path) -> Column:
    """object name -> TIMESTAMP; impossible dates give null (skipped)."""
    return F.try_to_timestamp(key_time_text(path), F.lit(OBJECT_TIME_PATTERN))


def now() -> Column:
    """ingestion time, constant within a query / micro-batch."""
    return F.current_timestamp()


def decode_array(text, element_schema: DataType) -> Column:
    """JSON array text -> ARRAY<STRUCT>. A lone object becomes a
    one-element array, ``[]`` an empty one, garbage null (hazard H14)."""
    from pyspark.sql.types import ArrayType
    schema = element_schema if isinstance(element_schema, ArrayType) else ArrayType(element_schema)
    return F.from_json(_c(text), schema)


def encode_array(rows) -> Column:
    """an ARRAY<STRUCT> column -> JSON array text."""
    return F.to_json(_c(rows))


def decode_object(text, schema: DataType, failfast: bool = False) -> Column:
    """JSON object text -> STRUCT; FAILFAST raises on malformed input."""
    opts = {"mode": "FAILFAST"} if failfast else {}
    return F.from_json(_c(text), schema, opts)


def utf8_decode(value) -> Column:
    """BINARY (Kafka value) -> STRING."""
    return F.decode(_c(value), "UTF-8")


def utf8_encode(text) -> Column:
    """STRING -> BINARY."""
    return F.encode(_c(text), "UTF-8")


def default_if_missing(c, default: str = "") -> Column:
    """F16: ``.get(k, "")``."""
    return F.coalesce(_c(c).cast("string"), F.lit(default))


def present(c) -> Column:
    """key membership; a JSON null counts as absent."""
    return _c(c).isNotNull()
