"""Last-value-wins operators.

Both are one aggregate with ``max_by`` over an explicit order struct, combined
map-side before the shuffle: a hot key costs one partial row per task, never its
whole history in one place. Spark runs it as a sort aggregate, because struct
buffers are not of fixed width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  values: Sequence[str]) -> DataFrame:
    """Per key, the ``values`` of the row with the greatest ``order`` tuple."""
    keys, order, values = list(keys), list(order), list(values)
    win = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*keys).agg(win.alias("_w")).select(*keys, *[F.col(f"_w.{v}").alias(v) for v in values])


def current_price(ticks: DataFrame, order: Sequence[str] = ("time", "seq", "pos"),
                  keys: Sequence[str] = ("source", "symbol")) -> DataFrame:
    """Latest tick per (source, symbol) by *event* time, then arrival
    order, so a late row never replaces a newer price."""
    return latest_by_key(ticks, keys, order, ["price", "time", "created_at"])


def object_overwrite(writes: DataFrame, key: str, order: Sequence[str],
                     values: Sequence[str]) -> DataFrame:
    """What survives when every write to the same object key replaces the
    previous one (the reference's second-resolution keys). Our sinks append,
    so this is a query over the appended history, not a data loss."""
    return latest_by_key(writes, [key], order, values)

