"""P10/F16: one flat, all-text row per Kucoin ticker message (CSV layout)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import default_if_missing
from tickloom.schemas import FLAT_TICKER_COLUMNS


def flatten_ticker(parsed: DataFrame, msg: str = "msg") -> DataFrame:
    """Top-level fields and ``data.*`` side by side; absent -> ''."""
    top = ("topic", "type", "subject")
    cols = [default_if_missing(F.col(f"{msg}.{c}")).alias(c) for c in top]
    cols += [default_if_missing(F.col(f"{msg}.data.{c}")).alias(c)
             for c in FLAT_TICKER_COLUMNS if c not in top]
    return parsed.select(*cols)
