"""Current-price table (K7): a keyed snapshot kept by ``foreachBatch``.

Folding ticks into the snapshot keeps, per key, the row with the greatest
(event time, arrival order). That fold is idempotent and independent of order,
so it needs no batch ids: a replayed micro-batch, a query restarted with a new
checkpoint and a backfill all fold into whatever is there and nothing is lost
(T6, T8).

Every commit writes a folder of its own and then creates one small file
``_commits/<n>`` with the folder's name. Creating it fails if ``n`` exists, so of
two writers one folds again on top of the other's result. Readers only ever see
the folder of the newest commit; it stays until ``KEEP`` newer ones exist.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.latest import latest_by_key
from tickloom.sources.files import hadoop_path, list_names, read_small, write_new

SNAPSHOT_COLUMNS = ("source", "symbol", "price", "time", "created_at")
# arrival order of the winning tick, kept so later merges tie-break exactly
ORDER_COLUMNS = ("seq", "pos")
KEEP = 8
MAX_TRIES = 20
CLAIM_SECONDS = 5
SNAPSHOT_SCHEMA = ("source string, symbol string, price double, time timestamp, created_at timestamp, "
                   "seq long, pos long")


def _commits(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in list_names(spark, f"{root}/_commits") if n.isdigit())


def _newest(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number of the newest commit and the newest folder named by one (0, None:
    none yet). A commit file still being written, or left empty by a crash, names
    no folder; the one before it holds."""
    commits = _commits(spark, root)
    for n in reversed(commits):
        folder = read_small(spark, f"{root}/_commits/{n:020d}")
        if folder:
            return commits[-1], f"{root}/{folder}"
    return commits[-1] if commits else 0, None


def _settled(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """:func:`_newest`, once the newest commit file has its content: a writer
    that has claimed a number fills it at once. One that stays empty was left by
    a crash, and its writer will fold the same ticks again."""
    deadline = time.monotonic() + CLAIM_SECONDS
    while True:
        n, folder = _newest(spark, root)
        if not n or read_small(spark, f"{root}/_commits/{n:020d}") or time.monotonic() > deadline:
            return n, folder
        time.sleep(0.1)


def _read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT_SCHEMA).parquet(folder)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest committed snapshot; None before the first commit."""
    _, folder = _newest(spark, root.rstrip("/"))
    return None if folder is None else _read(spark, folder)


def fold_ticks(ticks: DataFrame, root: str) -> None:
    """Fold ticks into the snapshot and commit. A late tick never replaces a
    newer price, and the result does not depend on how rows were split into
    micro-batches: previous snapshot and new ticks go through one ``max_by``."""
    spark, root = ticks.sparkSession, root.rstrip("/")
    order = [F.col(c).cast("long") if c in ticks.columns else F.lit(None).cast("long") for c in ORDER_COLUMNS]
    rows = ticks.select(*SNAPSHOT_COLUMNS, *[o.alias(c) for o, c in zip(order, ORDER_COLUMNS)])
    for _ in range(MAX_TRIES):
        n, folder = _settled(spark, root)
        both = rows if folder is None else _read(spark, folder).unionByName(rows)
        latest = latest_by_key(both, ["source", "symbol"], ["time", *ORDER_COLUMNS],
                               ["price", "time", "created_at", *ORDER_COLUMNS])
        mine = f"commit-{uuid.uuid4().hex}"
        latest.select(*SNAPSHOT_COLUMNS, *ORDER_COLUMNS).write.parquet(f"{root}/{mine}")
        if write_new(spark, f"{root}/_commits/{n + 1:020d}", mine):
            _clean(spark, root, n + 1)
            return
        _delete(spark, f"{root}/{mine}")        # another writer was first: fold on top of it
    raise RuntimeError(f"{root}: other writers committed first {MAX_TRIES} times")


def upsert_batch(ticks: DataFrame, batch_id: int, root: str) -> None:
    """foreachBatch body; the fold does not depend on ``batch_id``."""
    fold_ticks(ticks, root)


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def _clean(spark: SparkSession, root: str, newest: int) -> None:
    for n in _commits(spark, root):
        if n <= newest - KEEP:
            try:
                folder = read_small(spark, f"{root}/_commits/{n:020d}")
                if folder:
                    _delete(spark, f"{root}/{folder}")
                _delete(spark, f"{root}/_commits/{n:020d}")
            except Py4JJavaError:       # another writer cleaned it first
                continue


def source_view(snapshot: DataFrame, source: str) -> DataFrame:
    """H7: the reference declares one table per exchange keyed by ``symbol``;
    ours is one table keyed by ``(source, symbol)`` and this is the view."""
    return snapshot.where(F.col("source") == source)


def backfill(spark: SparkSession, lake_root: str, snapshot_root: str, start, end) -> None:
    """T8 gap fill: replay a range of the tick lake by event time and fold it
    into the snapshot; newer prices already there are kept."""
    from tickloom.sources.landing import replay_event
    ticks = replay_event(spark, lake_root, start, end)
    fold_ticks(ticks.select(*[c for c in ticks.columns if c not in ("dt", "hour", "hour_key")]), snapshot_root)
