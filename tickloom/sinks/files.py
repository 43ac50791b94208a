"""File sinks: flat CSV (K8) and the fan-out helper."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tickloom.schemas import FLAT_TICKER_COLUMNS


def write_flat_csv(flat: DataFrame, path: str) -> None:
    """K8: header + one flattened row per ticker message."""
    flat.select(*FLAT_TICKER_COLUMNS).write.mode("append").option("header", True).csv(path)


def tee(df: DataFrame, *writers: Callable[[DataFrame], None]) -> None:
    """The same rows to several sinks, computed once (use inside
    ``foreachBatch``). Persisted to memory and disk so a lost executor
    recomputes only its blocks."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for w in writers:
            w(df)
    finally:
        df.unpersist()
