"""Micro-batching.

A1 is the reference's count-or-timeout batcher: per key, records in order;
a batch opens at its first record and closes after the record that makes it
``size`` long, or whose time is ``timeout`` or more after the batch start
(that record is included). Windows are anchored at the first record, so the
rule is sequential within a key.

Bounded form, hot-key safe (no key is ever gathered into one task):

1. Range-partition on ``(key, time, tiebreak)`` and sort within partitions;
   a hot key is cut into many contiguous segments, one per partition. The
   result is checkpointed to the shared checkpoint folder (lineage cut,
   survives executor loss, and partition ids stay stable).
2. One Arrow pass folds every segment, streaming over record batches. A
   segment that opens a partition may continue a batch from the previous
   partition, so for it the pass computes a transfer table over the possible
   first-batch offsets, as runs of equal outcome: batches started, and the
   batch still open at the segment end; the times of its first rows are kept
   too, up to where any carried batch has closed. Neither grows with ``size``.
   Output: a few rows per partition.
3. The stitch resolves each partition's entry offset and batch-id base from
   those boundary rows only: blocks of ``STITCH_BLOCK`` rows per key compute
   their state maps in parallel, blocks are composed in groups of
   ``SUPER_BLOCK``, and the per-key chain is one row per
   ``STITCH_BLOCK * SUPER_BLOCK`` partitions. Small jobs skip the levels
   they do not need.
4. A second Arrow pass re-folds each partition from its resolved entry and
   tags rows with ``batch_id`` (0-based per key).

Data moves once (the range shuffle); the passes are narrow. The streaming form
lives in :mod:`tickloom.streaming.batcher` and uses the same fold primitive.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PID, POS = "_tl_pid", "_tl_pos"
# The resolution table has one row of three longs per range partition; it is
# broadcast; more partitions than this (~50 MB) are refused.
MAX_BROADCAST_PARTITIONS = 2_000_000


# --------------------------------------------------------------------------
# Per-segment fold (numpy; runs inside Arrow tasks)
# --------------------------------------------------------------------------

def _next_start(t: np.ndarray, size: int, timeout: int) -> np.ndarray:
    """``nxt[i]``: where the next batch starts if one starts at ``i``.

    Closing record of the batch opened at ``i`` = min(i + size - 1, first j
    with t[j] >= t[i] + timeout). Values >= len(t) mean the batch is still
    open at the end of the segment.
    """
    m = len(t)
    i = np.arange(m, dtype=np.int64)
    if timeout <= 0:
        j = i
    else:
        j = np.searchsorted(t, t + timeout, side="left").astype(np.int64)
        j = np.maximum(j, i)
    return np.minimum(i + size - 1, j) + 1


def _walk(nxt: list[int], entry: int, m: int) -> list[int]:
    starts = []
    s = entry
    while s < m:
        starts.append(s)
        s = nxt[s]
    return starts


class _Fold:
    """One key's fold, fed chunk by chunk in order. ``skip`` rows still belong
    to a batch opened before this point (the stitch's entry offset); ``n``,
    ``st`` describe the open batch (n == 0: none); ``cnt`` counts starts."""

    __slots__ = ("skip", "n", "st", "cnt")

    def __init__(self, skip: int = 0, n: int = 0, st: int = 0):
        self.skip, self.n, self.st, self.cnt = skip, n, st, 0

    def state(self) -> tuple[int, int, int]:
        return self.skip, self.n, self.st

    def feed(self, t: np.ndarray, size: int, timeout: int) -> np.ndarray:
        """Consume the next times of the key; return the local batch starts."""
        m, i = len(t), 0
        if self.skip:
            i = min(self.skip, m)
            self.skip -= i
            if i == m:
                return _NONE
        if self.n:                              # close the carried batch on the first rows
            lim = min(m - i, size - self.n)
            hit = np.flatnonzero(((t[i:i + lim] - self.st) >= timeout)
                                 | (np.arange(self.n + 1, self.n + lim + 1) >= size))
            if len(hit) == 0:                   # the whole chunk joins it
                self.n += m - i
                return _NONE
            i += int(hit[0]) + 1
            self.n, self.st = 0, 0
            if i == m:
                return _NONE
        nxt = _next_start(t[i:], size, timeout).tolist()
        starts = _walk(nxt, 0, m - i)
        self.cnt += len(starts)
        last = starts[-1]
        if nxt[last] > m - i:                   # still open at the end of the chunk
            self.n, self.st = m - i - last, int(t[i + last])
        else:
            self.n, self.st = 0, 0
        return np.asarray(starts, dtype=np.int64) + i


_NONE = np.zeros(0, dtype=np.int64)


class _Candidates:
    """The transfer table of a segment that may continue a batch: for every entry
    offset (how many of its rows still belong to that batch), the batches started
    and the batch open at the end. Offsets with the same future are one run.

    A carried batch began at or before the segment's first time, so it closes by
    the first row that is ``timeout`` after that time, or as row ``size - 1``:
    only offsets up to there are possible, however large ``size`` is. A chunk is
    solved for all of its rows at once by pointer doubling over "where the next
    batch starts", so the cost does not depend on the number of offsets either."""

    def __init__(self, size: int, timeout: int):
        self.size, self.timeout, self.rows, self.limit = size, timeout, 0, None
        self.first = None                       # the segment's first time
        self.runs = np.zeros((4, 0), dtype=np.int64)     # first offset, count, n, st

    def _solve(self, t: np.ndarray):
        """Per row of a chunk: batches started from there on, and the open one."""
        m, nxt = len(t), _next_start(t, self.size, self.timeout)
        count, last, hop = np.ones(m, dtype=np.int64), np.arange(m), nxt
        while (inside := hop < m).any():
            to = np.where(inside, hop, 0)
            count = count + np.where(inside, count[to], 0)
            last = np.where(inside, last[to], last)
            hop = np.where(inside, hop[to], hop)
        is_open = nxt[last] > m
        return count, np.where(is_open, m - last, 0), np.where(is_open, t[last], 0)

    def feed(self, t: np.ndarray) -> None:
        m = len(t)
        if not m:
            return
        if self.first is None:
            self.first = int(t[0])
        count, n_end, st_end = self._solve(t)
        at, cnt, n, st = self.runs
        if len(at):                             # the open batches go on into this chunk
            by_time = np.searchsorted(t, st + self.timeout, side="left") if self.timeout > 0 else np.zeros_like(st)
            start = np.where(n > 0, np.minimum(by_time, self.size - n - 1) + 1, 0)
            joins, begins = start > m, start < m
            to = np.where(begins, start, 0)
            cnt = cnt + np.where(begins, count[to], 0)
            n, st = (np.where(joins, n + m, np.where(begins, n_end[to], 0)),
                     np.where(joins, st, np.where(begins, st_end[to], 0)))
        if self.limit is None:                  # offsets that end in this chunk
            hi = max(0, min(m, self.size - self.rows))
            close = int(np.searchsorted(t, self.first + max(self.timeout, 0), side="left"))
            if close < m:
                self.limit = min(self.size, self.rows + close + 2)
                hi = min(hi, close + 2)
            new = (np.arange(self.rows, self.rows + hi), count[:hi], n_end[:hi], st_end[:hi])
        elif self.rows < self.limit:            # the row after the closing one
            new = (np.array([self.rows]), count[:1], n_end[:1], st_end[:1])
        else:
            new = (_NONE,) * 4
        runs = np.stack([np.concatenate(p) for p in zip((at, cnt, n, st), new)])
        if runs.shape[1] > 1:
            keep = np.concatenate([[True], (runs[1:, 1:] != runs[1:, :-1]).any(axis=0)])
            runs = runs[:, keep]
        self.runs, self.rows = runs, self.rows + m

    def table(self) -> tuple[list[int], ...]:
        return tuple(r.tolist() for r in self.runs)


def _runs(cols: list[pa.Array], n: int) -> list[tuple[int, int]]:
    """Runs of equal key tuples (nulls equal to nulls), vectorised in Arrow."""
    if n == 0:
        return []
    change = np.zeros(n, dtype=bool)
    change[0] = True
    if n > 1:
        for c in cols:
            x, y = c.slice(1), c.slice(0, n - 1)
            xn, yn = pc.is_null(x), pc.is_null(y)
            diff = pc.or_(pc.fill_null(pc.not_equal(x, y), False), pc.xor(xn, yn))
            change[1:] |= diff.to_numpy(zero_copy_only=False)
    b = np.flatnonzero(change).tolist() + [n]
    return list(zip(b[:-1], b[1:]))


def _chunk_segments(rb: pa.RecordBatch, keys: Sequence[str], ms: str):
    """Times of one Arrow batch and its runs of equal ``(pid, key)``."""
    t = rb.column(rb.schema.get_field_index(ms)).to_numpy(zero_copy_only=False).astype(np.int64)
    cols = [rb.column(rb.schema.get_field_index(k)) for k in (PID, *keys)]
    return t, [(a, b, tuple(c[a].as_py() for c in cols)) for a, b in _runs(cols, rb.num_rows)]


# --------------------------------------------------------------------------
# Spark plan
# --------------------------------------------------------------------------

def _summary_schema(key_fields: list[T.StructField]) -> T.StructType:
    L = T.ArrayType(T.LongType())
    return T.StructType([*key_fields,
                         T.StructField(PID, T.LongType()),
                         T.StructField("role", T.StringType()),   # first | last
                         T.StructField("m", T.LongType()),
                         T.StructField("closes", T.BooleanType()),   # any carried batch ends inside
                         T.StructField("heads", L),
                         T.StructField("offsets", L),
                         T.StructField("cnt", L),
                         T.StructField("n_open", L),
                         T.StructField("st_open", L)])


def _summarise(keys, ms, size, timeout, schema: T.StructType):
    """Arrow pass 1: per partition, the boundary segments' fold summaries.
    Streams over the partition's Arrow batches; memory is one batch, the runs of
    the transfer table and the times of the first rows, up to where any carried
    batch has closed."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow_schema = to_arrow_schema(schema)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        cur = None           # (pid, *key) of the open segment
        st = {}              # its fold state
        pending = None       # a finished non-first segment: emitted if it ends its partition

        def close():
            nonlocal pending
            if cur is None:
                return
            kv = dict(zip(keys, cur[1:]))
            if st["first"]:
                offsets, cnt, n_open, st_open = st["fold"].table()
                rows.append({**kv, PID: cur[0], "role": "first", "m": st["m"], "heads": st["heads"],
                             "closes": st["full"] or st["m"] >= size - 1, "offsets": offsets,
                             "cnt": cnt, "n_open": n_open, "st_open": st_open})
            else:
                f = st["fold"]
                pending = {**kv, PID: cur[0], "role": "last", "m": st["m"], "heads": [], "closes": False,
                           "offsets": [0], "cnt": [f.cnt], "n_open": [f.n], "st_open": [f.st]}

        for rb in batches:
            if rb.num_rows == 0:
                continue
            t, segs = _chunk_segments(rb, keys, ms)
            for a, b, kv in segs:
                if kv != cur:
                    close()
                    first = cur is None or kv[0] != cur[0]
                    if first and pending is not None:
                        rows.append(pending)     # the previous partition's last segment
                    pending = None
                    cur = kv
                    st = {"first": first, "m": 0, "heads": [], "full": False,
                          "fold": _Candidates(size, timeout) if first else _Fold()}
                chunk = t[a:b]
                st["m"] += b - a
                if not st["first"]:
                    st["fold"].feed(chunk, size, timeout)
                    continue
                st["fold"].feed(chunk)
                if not st["full"] and len(st["heads"]) < size - 1:
                    heads = chunk[: size - 1 - len(st["heads"])]
                    end = int(np.searchsorted(heads, st["fold"].first + max(timeout, 0), side="left"))
                    st["full"] = end < len(heads)
                    st["heads"].extend(heads[:end + 1].tolist())
            if len(rows) >= 1024:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
                rows = []
        close()
        if pending is not None:
            rows.append(pending)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
    return fn


# Boundary rows of one key handled by one stitch group (a hot key spanning
# many partitions is stitched block by block, in parallel), and blocks per
# second-level group: one key's chain is one row per STITCH_BLOCK *
# SUPER_BLOCK partitions.
STITCH_BLOCK = 512
SUPER_BLOCK = 512


def _step(r: dict, state, size: int, timeout: int):
    """One boundary row given the carried open batch ``state = (n, st)``
    (None: the key starts here). Returns (entry, batches started, state)."""
    m = int(r["m"])
    if r["role"] == "last":                    # the key begins inside this partition
        return None, int(r["cnt"][0]), (int(r["n_open"][0]), int(r["st_open"][0]))
    n, st = state if state is not None else (0, 0)
    entry = 0
    if n > 0:                                  # close the carried batch on the heads
        h = np.asarray(r["heads"], dtype=np.int64)
        hit = np.flatnonzero((n + np.arange(1, len(h) + 1) >= size) | (h - st >= timeout))
        if len(hit) == 0:                      # the whole segment joins the carried batch
            return m, 0, (n + m, st)
        entry = int(hit[0]) + 1
    if entry >= m:                             # carried batch closed on the last row
        return entry, 0, (0, 0)
    k = _run_of(r, entry)
    return entry, int(r["cnt"][k]), (int(r["n_open"][k]), int(r["st_open"][k]))


def _run_of(r: dict, entry: int) -> int:
    return int(np.searchsorted(np.asarray(r["offsets"]), entry, side="right")) - 1


def _candidates(first: dict):
    """Incoming states of a block: the previous (cut) row's table states, and
    'closed on its last row'. Block 0 starts the key: one candidate."""
    if first["block"] == 0:
        return [None]
    return [(int(a), int(b)) for a, b in zip(first["prev_n_open"], first["prev_st_open"])] + [(0, 0)]


def _block_maps(keys, size, timeout):
    """Per (key, block): for every incoming candidate, the index of the state
    the block hands on (an entry of its last row's table, or 'closed') and
    the batches it starts."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("r").to_dict("records")
        last = rows[-1]
        out_idx, counts, memo = [], [], {}
        for cand in _candidates(rows[0]):
            if cand not in memo:
                state, total, entry = cand, 0, None
                for r in rows:
                    entry, cnt, state = _step(r, state, size, timeout)
                    total += cnt
                if entry is None:
                    k = 0                       # the key begins in the last row: one state
                else:
                    k = _run_of(last, entry) if entry < last["m"] else len(last["cnt"])
                memo[cand] = (k, total)
            out_idx.append(memo[cand][0])
            counts.append(memo[cand][1])
        return pd.DataFrame([{**{k: rows[0][k] for k in keys}, "block": rows[0]["block"],
                              "out_idx": out_idx, "cnt": counts}])
    return fn


def _compose(keys, level: str):
    """Per (key, super-block): compose its block maps (total functions on
    small index domains) into one map, for every incoming index."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("block").to_dict("records")
        out_idx, counts = [], []
        for d in range(len(rows[0]["out_idx"])):
            idx, total = d, 0
            for r in rows:
                total += int(r["cnt"][idx])
                idx = int(r["out_idx"][idx])
            out_idx.append(idx)
            counts.append(total)
        return pd.DataFrame([{**{k: rows[0][k] for k in keys}, level: rows[0][level],
                              "out_idx": out_idx, "cnt": counts}])
    return fn


def _chain(keys, order: str, emit: str):
    """Walk maps in ``order`` from a starting index and base; emit, per map,
    the incoming index and base. Grouped by key (the super-block chain: one
    row per STITCH_BLOCK * SUPER_BLOCK partitions) or by (key, super-block)
    (at most SUPER_BLOCK rows, started from the super-block's resolved state)."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(order).to_dict("records")
        idx = int(rows[0].get("_in_idx", 0) or 0)
        base = int(rows[0].get("_in_base", 0) or 0)
        out = []
        for r in rows:
            out.append({**{k: r[k] for k in keys}, emit: r[emit], "in_idx": idx, "in_base": base})
            base += int(r["cnt"][idx])
            idx = int(r["out_idx"][idx])
        return pd.DataFrame(out, columns=[*keys, emit, "in_idx", "in_base"])
    return fn


def _join_on(left: DataFrame, right: DataFrame, keys: list[str], extra: str) -> DataFrame:
    """Equi-join on the batching key (null-safe) plus one more column."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(extra).alias(f"_r_{extra}"),
                     *[c for c in right.columns if c not in (*keys, extra)])
    cond = F.col(extra) == F.col(f"_r_{extra}")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys], f"_r_{extra}")


def _block_resolve(size, timeout):
    """Per (key, block): walk the block from its resolved incoming state and
    emit each partition's entry offset and batch-id base."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("r").to_dict("records")
        state = _candidates(rows[0])[int(rows[0]["in_idx"])]
        base = int(rows[0]["in_base"])
        out = []
        for r in rows:
            entry, cnt, state = _step(r, state, size, timeout)
            if r["role"] == "first":
                out.append((int(r[PID]), entry, base))
            base += cnt
        return pd.DataFrame(out, columns=[PID, "entry", "base"])
    return fn


def _stitch(summary: DataFrame, keys: list[str], size: int, timeout: int) -> DataFrame:
    """Entry offset and batch-id base of every partition's first segment.

    The boundary rows of a key are ranked by partition; blocks of about
    ``STITCH_BLOCK`` rows end on a row in which any carried batch closes, whose
    out-state is one of its table states. Each block's map from incoming to
    outgoing state index is computed in parallel, chained per key (one row per
    block), then each block is walked once more from its resolved state."""
    w = Window.partitionBy(*keys).orderBy(PID)
    cut = (F.col("closes") & (F.col("r") % STITCH_BLOCK == 0)).cast("int")
    ranked = (summary.withColumn("r", F.row_number().over(w))
              .withColumn("prev_n_open", F.lag("n_open").over(w))
              .withColumn("prev_st_open", F.lag("st_open").over(w))
              .withColumn("_cut", cut)
              .withColumn("block", F.coalesce(F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)).cast("long"))
              .drop("_cut"))
    ranked = ranked.checkpoint(eager=True)
    key_fields = [ranked.schema[k] for k in keys]
    L = T.ArrayType(T.LongType())
    chain_schema = lambda col: T.StructType([*key_fields, T.StructField(col, T.LongType()),
                                             T.StructField("in_idx", T.LongType()),
                                             T.StructField("in_base", T.LongType())])
    # How deep the chain goes is one scalar of the (small, checkpointed)
    # boundary table: chains within one block resolve directly.
    depth = ranked.agg(F.max("block")).first()[0] or 0
    if depth == 0:
        joined = ranked.withColumn("in_idx", F.lit(0).cast("long")).withColumn("in_base", F.lit(0).cast("long"))
    else:
        maps = ranked.groupBy(*keys, "block").applyInPandas(
            _block_maps(keys, size, timeout),
            T.StructType([*key_fields, T.StructField("block", T.LongType()),
                          T.StructField("out_idx", L), T.StructField("cnt", L)]))
        if depth < SUPER_BLOCK:
            starts = maps.groupBy(*keys).applyInPandas(_chain(keys, "block", "block"), chain_schema("block"))
        else:
            maps = maps.withColumn("sb", F.floor(F.col("block") / SUPER_BLOCK).cast("long")).checkpoint(eager=True)
            supers = maps.groupBy(*keys, "sb").applyInPandas(
                _compose(keys, "sb"),
                T.StructType([*key_fields, T.StructField("sb", T.LongType()),
                              T.StructField("out_idx", L), T.StructField("cnt", L)]))
            sb_starts = (supers.groupBy(*keys).applyInPandas(_chain(keys, "sb", "sb"), chain_schema("sb"))
                         .withColumnRenamed("in_idx", "_in_idx").withColumnRenamed("in_base", "_in_base"))
            starts = (_join_on(maps, sb_starts, keys, "sb").groupBy(*keys, "sb")
                      .applyInPandas(_chain(keys, "block", "block"), chain_schema("block")))
        joined = _join_on(ranked, starts, keys, "block")
    return joined.groupBy(*keys, "block").applyInPandas(
        _block_resolve(size, timeout), f"{PID} long, entry long, base long")


def _assign(keys, ms, size, timeout, out_schema: T.StructType):
    """Arrow pass 2: re-fold every partition from its resolved entry and tag
    each row with its batch id, one output batch per input batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow_schema = to_arrow_schema(out_schema)
    out_names = [f.name for f in out_schema.fields if f.name != "batch_id"]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur, fold, next_id = None, None, 0
        for rb in batches:
            if rb.num_rows == 0:
                continue
            t, segs = _chunk_segments(rb, keys, ms)
            ids = np.empty(rb.num_rows, dtype=np.int64)
            entry_col = rb.column(rb.schema.get_field_index("_tl_entry"))
            base_col = rb.column(rb.schema.get_field_index("_tl_base"))
            for a, b, kv in segs:
                if kv != cur:
                    if cur is None or kv[0] != cur[0]:      # first segment of a partition
                        entry, base = entry_col[a].as_py(), base_col[a].as_py()
                        fold, next_id = _Fold(skip=int(entry or 0)), int(base or 0)
                    else:
                        fold, next_id = _Fold(), 0
                    cur = kv
                starts = fold.feed(t[a:b], size, timeout)
                flags = np.zeros(b - a, dtype=np.int64)
                flags[starts] = 1
                ids[a:b] = next_id - 1 + np.cumsum(flags)
                next_id += len(starts)
            cols = [rb.column(rb.schema.get_field_index(n)) for n in out_names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(ids, pa.int64())], schema=arrow_schema)
    return fn


def assign_batches(df: DataFrame, keys: Sequence[str], ms: str, order: Sequence[str] = (),
                   size: int = 50, timeout_ms: int = 1000, partitions: int | None = None) -> DataFrame:
    """A1/A2/A10: tag each row with ``batch_id`` (0-based, per key).

    ``keys``: batching key (e.g. ``source, symbol``); ``ms``: epoch-ms time
    column; ``order``: tie-breakers after time. ``partitions`` sets how many
    contiguous ranges the sorted rows are cut into (default: the session's
    shuffle partitions); size it so one range fits a Python worker. Rows with
    a null time are returned with a null ``batch_id``.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    if not isinstance(df.schema[ms].dataType, (T.LongType, T.IntegerType)):
        raise TypeError(f"{ms} must hold epoch milliseconds (bigint); use functions.ts_to_millis")
    spark = df.sparkSession
    from tickloom.session import checkpoint_root
    checkpoint_root(spark)
    keys, order = list(keys), list(order)
    n_parts = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    if n_parts > MAX_BROADCAST_PARTITIONS:
        raise ValueError(f"at most {MAX_BROADCAST_PARTITIONS} partitions")
    sort_cols = [*keys, ms, *order]
    # The range exchange samples its input in a separate job before the
    # shuffle reads it again; keep the input so an expensive upstream (decode,
    # validation) runs once. Blocks lost with an executor are recomputed.
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    timed = src.where(F.col(ms).isNotNull())
    untimed = src.where(F.col(ms).isNull()).withColumn("batch_id", F.lit(None).cast("long"))
    ranged = (timed.repartitionByRange(n_parts, *sort_cols).sortWithinPartitions(*sort_cols)
              .withColumn(PID, F.spark_partition_id().cast("long"))
              .withColumn(POS, F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)

    key_fields = [f for f in ranged.schema.fields if f.name in keys]
    key_fields = [next(f for f in key_fields if f.name == k) for k in keys]
    summary_schema = _summary_schema(key_fields)
    summary = ranged.select(*keys, ms, PID).mapInArrow(
        _summarise(keys, ms, size, timeout_ms, summary_schema), summary_schema)
    resolution = (_stitch(summary, keys, size, timeout_ms)
                  .withColumnRenamed("entry", "_tl_entry").withColumnRenamed("base", "_tl_base"))
    resolution = resolution.checkpoint(eager=True)

    # one fixed-width row per partition: size bounded by n_parts, checked above
    joined = ranged.join(F.broadcast(resolution), PID, "left")
    schema = T.StructType([*[f for f in ranged.schema.fields],
                           T.StructField("batch_id", T.LongType())])
    joined = joined.select(*[f.name for f in ranged.schema.fields], "_tl_entry", "_tl_base")
    tagged = joined.mapInArrow(_assign(keys, ms, size, timeout_ms, schema), schema).drop(PID, POS)
    # rows without a time cannot be ordered: kept, with a null batch id
    untimed = untimed.checkpoint(eager=True)
    src.unpersist()
    return tagged.unionByName(untimed)


def batch_stats(tagged: DataFrame, keys: Sequence[str], ms: str) -> DataFrame:
    """Per batch: size and first / last time. Rows of a batch are contiguous,
    so the partial aggregate collapses them before the shuffle."""
    return (tagged.groupBy(*keys, "batch_id")
            .agg(F.count(F.lit(1)).alias("n"), F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms")))


# --------------------------------------------------------------------------
# A5: aligned time windows (fully parallel variant)
# --------------------------------------------------------------------------

def _seconds(window: str) -> int:
    """Length of a window given as ``"<n> seconds|minutes|hours|days"``."""
    n, unit = window.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def assign_aligned(df: DataFrame, keys: Sequence[str], ts: str, ms: str, order: Sequence[str] = (),
                   window: str = "60 seconds", size: int | None = None) -> DataFrame:
    """A5: epoch-aligned windows of ``window`` on ``ts``, optionally cut into
    chunks of ``size`` rows. Boundaries differ from A1 (aligned, not anchored)
    but every (key, window) is independent, so a hot key spreads over as many
    tasks as it has windows; one window's rows are bounded by feed rate."""
    seconds = _seconds(window)
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    # by arithmetic: F.window would drop rows without a time; those share a null window
    out = df.withColumn("window_start", F.timestamp_seconds(at - F.pmod(at, F.lit(seconds))))
    if size:
        w = Window.partitionBy(*keys, "window_start").orderBy(F.col(ms), *[F.col(c) for c in order])
        out = out.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
    else:
        out = out.withColumn("chunk", F.lit(0).cast("long"))
    return out


# --------------------------------------------------------------------------
# Batch -> one array message with first-item attributes
# --------------------------------------------------------------------------

def batch_messages(tagged: DataFrame, keys: Sequence[str], batch_cols: Sequence[str],
                   record: Column, order: Sequence[str], first: dict[str, str]) -> DataFrame:
    """A3 + A4: one JSON array per batch, records in ``order``; ``first`` maps
    output name -> column whose value is taken from the batch's first record.
    A batch holds at most ``size`` records, so the array is bounded."""
    ord_struct = F.struct(*[F.col(c) for c in order])
    aggs = [F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(ord_struct.alias("o"), record.alias("r")))),
                                  lambda x: x["r"])).alias("message"),
            F.count(F.lit(1)).alias("n")]
    aggs += [F.min_by(F.col(src), ord_struct).alias(name) for name, src in first.items()]
    return tagged.groupBy(*keys, *batch_cols).agg(*aggs)
