"""A1 in Structured Streaming: ``applyInPandasWithState`` per key.

State per key is the open batch only: ``(batch_id, n, start_ms, last_ms,
records)`` with at most ``size - 1`` buffered records, so state stays bounded
however hot the key is. A batch is emitted when it closes (A1/A3: one message
per closed batch); an idle key's open batch is flushed by a processing-time
timeout (A5/A6, the reference's 1 s poll on the S3 path).

Rows of one key can arrive in several Arrow chunks in no order; they are
gathered and sorted by ``(ms, order...)`` before folding. Rows that arrive in
a later trigger than a newer row of the same key are folded in arrival order,
as the reference does.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.operators.batching import _Fold

STATE_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("start_ms", T.LongType()),
    T.StructField("last_ms", T.LongType()),
    T.StructField("records", T.ArrayType(T.StringType())),
])


def _output_schema(key_fields: list[T.StructField]) -> T.StructType:
    return T.StructType([*key_fields,
                         T.StructField("batch_id", T.LongType()),
                         T.StructField("n", T.LongType()),
                         T.StructField("first_ms", T.LongType()),
                         T.StructField("last_ms", T.LongType()),
                         T.StructField("message", T.StringType()),
                         T.StructField("closed_by", T.StringType())])


def _folder(keys: Sequence[str], ms: str, order: Sequence[str], record: str, size: int,
            timeout_ms: int, idle_ms: int):
    out_cols = [*keys, "batch_id", "n", "first_ms", "last_ms", "message", "closed_by"]

    def emit(key, bid, recs, first, last, why):
        return (*key, bid, len(recs), first, last, "[" + ",".join(recs) + "]", why)

    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            bid, n, st, last, recs = state.get
            # the next batch id stays in the state: ids never start again
            state.update((bid + (1 if n else 0), 0, 0, last, []))
            if n:
                yield pd.DataFrame([emit(key, bid, list(recs), st, last, "idle")], columns=out_cols)
            return
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values([ms, *order], kind="stable")
        t = pdf[ms].to_numpy(dtype=np.int64)
        rec = pdf[record].tolist()
        m = len(t)
        bid, n, st, last, recs = state.get if state.exists else (0, 0, 0, 0, [])
        recs = list(recs or [])
        fold = _Fold(n=n, st=st)                # the same fold as the bounded operator
        starts = fold.feed(t, size, timeout_ms).tolist()
        rows = []
        if n:                                   # the carried batch takes the rows before the first start
            end = starts[0] if starts else m
            recs += rec[:end]
            last = int(t[end - 1]) if end else last
            if starts or fold.n == 0:
                rows.append(emit(key, bid, recs, st, last, "size" if len(recs) >= size else "time"))
                bid, recs = bid + 1, []
        for i, s0 in enumerate(starts):
            e = starts[i + 1] if i + 1 < len(starts) else m
            if i + 1 < len(starts) or fold.n == 0:
                rows.append(emit(key, bid, rec[s0:e], int(t[s0]), int(t[e - 1]),
                                 "size" if e - s0 >= size else "time"))
                bid += 1
            else:                               # still open at the end of this trigger
                recs, st, last = rec[s0:e], int(t[s0]), int(t[e - 1])
        n = fold.n
        if not n:
            recs = []
        state.update((bid, n, fold.st if n else 0, last, recs))
        if n and idle_ms:
            state.setTimeoutDuration(idle_ms)
        if rows:
            yield pd.DataFrame(rows, columns=out_cols)

    return fn


def stream_batches(records: DataFrame, keys: Sequence[str], ms: str, order: Sequence[str],
                   record: str, size: int, timeout_ms: int, idle_ms: int | None = 1000) -> DataFrame:
    """Streaming A1 + A3: closed batches as rows ``(keys, batch_id, n,
    first_ms, last_ms, message, closed_by)``; ``record`` holds each row's JSON.

    ``idle_ms`` flushes an idle key's open batch after that much processing
    time (A6). Spark then plans no-data micro-batches to evaluate timeouts, so
    ``processAllAvailable`` does not return; pass ``None`` to keep open
    batches in state (readable with the ``statestore`` data source)."""
    keys, order = list(keys), list(order)
    key_fields = [records.schema[k] for k in keys]
    return (records.select(*keys, ms, *order, record)
            .groupBy(*keys)
            .applyInPandasWithState(_folder(keys, ms, order, record, size, timeout_ms, idle_ms),
                                    _output_schema(key_fields), STATE_SCHEMA, "append",
                                    GroupStateTimeout.ProcessingTimeTimeout if idle_ms
                                    else GroupStateTimeout.NoTimeout))


def open_batches(spark, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """A6 at the end of a bounded stream: the batches still open in the
    batcher's state, read from the query checkpoint with the ``statestore``
    source (``keys, batch_id, n, first_ms, last_ms``)."""
    from pyspark.sql import functions as F
    state = spark.read.format("statestore").load(checkpoint)
    return (state.select(*[F.col(f"key.{k}").alias(k) for k in keys],
                         F.col("value.groupState.batch_id").alias("batch_id"),
                         F.col("value.groupState.n").alias("n"),
                         F.col("value.groupState.start_ms").alias("first_ms"),
                         F.col("value.groupState.last_ms").alias("last_ms"))
            .where(F.col("n") > 0))
