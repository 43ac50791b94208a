"""The ingestion envelope every landed record carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import now


def envelope(df: DataFrame, data: str | Column, source: str | Column,
             ingest_ts: str | Column | None = None, keep=()) -> DataFrame:
    """``data`` (raw JSON text), ``ingest_ts`` (batch ingest time, default
    now) and ``source`` (literal or column)."""
    d = F.col(data) if isinstance(data, str) else data
    s = source if isinstance(source, Column) else (F.col(source) if source in df.columns else F.lit(source))
    ts = now() if ingest_ts is None else (F.col(ingest_ts) if isinstance(ingest_ts, str) else ingest_ts)
    return df.select(*keep, d.alias("data"), ts.alias("ingest_ts"), s.alias("source"))


def kucoin_record_json(msg: str = "msg") -> Column:
    """A decoded Kucoin message back to JSON text (unknown keys dropped, P13)."""
    return F.to_json(F.col(msg))


def binance_record_json(el: str = "el") -> Column:
    """A decoded Binance element back to its wire names (e, E, s, ...)."""
    from tickloom.schemas import BINANCE_RENAMES
    return F.to_json(F.struct(*[F.col(f"{el}.{dst}").alias(src) for src, dst in BINANCE_RENAMES]))
