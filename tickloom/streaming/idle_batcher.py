"""A1 + A6 on a stream: batches that size, time or silence closes.

The clock is the records' arrival time, so a run over the same records gives the
same batches, whatever the wall clock says and however the triggers cut the
stream. A batch closes with the row that brings it to ``size`` or ``timeout_ms``
after its first row; and as idle, when its key is silent for more than ``idle_ms``
while the clock goes on. Two things end a silence: the key's next row, and a timer
on the stream's watermark for keys that have no next row.

The watermark drives timers only and drops nothing. It is read from clock rows, one
per Arrow batch with the newest time in it; the records themselves pass with a null
in its column, which is never behind it. So a late row joins the open batch, and a
batch whose silence had already ended when its rows came is closed at once.

State per key is the open batch (fewer than ``size`` records) and the next batch
id. A trigger's rows of one key are sorted in one task: cap the trigger's volume,
or use ``hot_batcher`` where a key may hold much of a trigger.

Defined results: rows without a clock time are in no batch; a null key is a key; an
empty trigger only moves timers; ties keep ``order``; equal rows all count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.operators.batching import _Fold

STATE_SCHEMA = "batch_id long, first_ms long, last_ms long, records array<string>"
_OUT = ["batch_id", "n", "first_ms", "last_ms", "message", "closed_by"]


def _runs(t: np.ndarray, idle_ms: int) -> list[tuple[int, int]]:
    """Stretches of rows without a silence between them."""
    if not len(t):
        return []
    edges = [0, *(np.flatnonzero(np.diff(t) > idle_ms) + 1).tolist(), len(t)]
    return list(zip(edges[:-1], edges[1:]))


def _folder(keys: Sequence[str], order: Sequence[str], record: str, size: int, timeout_ms: int, idle_ms: int):
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bid, first, last, held = state.get if state.exists else (0, 0, 0, [])
        held, rows = list(held or []), []

        def close(why):
            nonlocal bid, held
            rows.append((*key, bid, len(held), first, last, "[" + ",".join(held) + "]", why))
            bid, held = bid + 1, []

        if state.hasTimedOut:
            close("idle")
        else:
            pdf = pd.concat(list(pdfs), ignore_index=True)
            pdf = pdf[pdf["_clock"].isna()].sort_values(["_clock_ms", *order], kind="stable")
            t, rec = pdf["_clock_ms"].to_numpy(dtype=np.int64), pdf[record].tolist()
            for a, z in _runs(t, idle_ms):
                if held and t[a] - last > idle_ms:
                    close("idle")
                fold = _Fold(n=len(held), st=first)         # the same fold as the bounded operator
                starts = (fold.feed(t[a:z], size, timeout_ms) + a).tolist()
                if held:                                    # rows before the first start join the open batch
                    end = starts[0] if starts else z
                    held += rec[a:end]
                    last = max(last, int(t[end - 1])) if end > a else last
                    if starts or not fold.n:
                        close("size" if len(held) >= size else "time")
                for i, s in enumerate(starts):
                    end = starts[i + 1] if i + 1 < len(starts) else z
                    held, first, last = rec[s:end], int(t[s]), int(t[end - 1])
                    if end < z or not fold.n:
                        close("size" if len(held) >= size else "time")
            if held:
                try:
                    state.setTimeoutTimestamp(last + idle_ms)
                except PySparkException:                    # the clock is past it: all its rows were late
                    close("idle")
        state.update((bid, first if held else 0, last if held else 0, held))
        if rows:
            yield pd.DataFrame(rows, columns=[*keys, *_OUT])

    return fn


def _with_clock_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with a null ``_clock``, and per Arrow batch its newest row once more
    with its time there."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_clock", T.TimestampType())])
    kind = pa.timestamp("us", "UTC")

    def run(batches):
        for b in batches:
            if b.num_rows:
                newest = b.slice(int(np.argmax(b.column(0).to_numpy())), 1)
                at = pc.multiply(newest.column(0), 1000).cast(kind)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, kind)], names=schema.names)
                yield pa.RecordBatch.from_arrays([*newest.columns, at], names=schema.names)

    return rows.mapInArrow(run, schema)


def idle_batches(records: DataFrame, keys: Sequence[str], clock: str, order: Sequence[str], record: str,
                 size: int, timeout_ms: int, idle_ms: int, lag: str = "0 seconds") -> DataFrame:
    """Closed batches ``(keys, batch_id, n, first_ms, last_ms, message,
    closed_by)``. ``clock`` is a timestamp column; timers run ``lag`` behind the
    newest one seen."""
    keys, order = list(keys), list(order)
    out = T.StructType([*(records.schema[k] for k in keys),
                        *T._parse_datatype_string("batch_id long, n long, first_ms long, last_ms long, "
                                                  "message string, closed_by string").fields])
    rows = records.where(F.col(clock).isNotNull()).select(
        F.unix_millis(F.col(clock)).alias("_clock_ms"), *keys, *order, record)
    rows = _with_clock_rows(rows).withWatermark("_clock", lag)
    return rows.groupBy(*keys).applyInPandasWithState(
        _folder(keys, order, record, size, timeout_ms, idle_ms), out, STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)


def open_batches(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The batches that are still open, from the query's state."""
    held = F.col("value.groupState")
    return (spark.read.format("statestore").load(checkpoint)
            .select(*[F.col(f"key.{k}").alias(k) for k in keys], held["batch_id"].alias("batch_id"),
                    F.size(held["records"]).cast("long").alias("n"), held["first_ms"].alias("first_ms"),
                    held["last_ms"].alias("last_ms"))
            .where("n > 0"))
