"""A1/A10 on a stream whose keys may be hot: batches that no single task folds.

Every trigger puts the rows of the open batches before its own and runs the
bounded batcher over both: rows are range-sorted by key and time, so a hot key is
cut over many tasks, each folds its range to a transfer table, and the tables are
composed. An open batch starts at its first row, so folding it again with what
came later gives what one fold over all would.

State is two small tables per trigger: the rows of each key's open batch (fewer
than ``size``) and each key's next batch id. They, and the closed batches, are
written under the trigger's number from the tables of the one before, so a trigger
that runs again writes the same and nothing is counted twice (T6).

Rows that arrive in a later trigger than newer rows of their key are sorted among
the open batch's rows; batches that were closed stay as they are. Rows without a
time are in no batch and are written to ``untimed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import batching as B
from tickloom.sources.files import hadoop_path, list_names


def _equal(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[f"_{k}"])
    return cond


def _renamed(df: DataFrame, keys: Sequence[str], *others: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys], *others)


def fold_trigger(rows: DataFrame, number: int, root: str, keys: Sequence[str], ms: str, order: Sequence[str],
                 size: int, timeout_ms: int) -> None:
    """One trigger: ``rows`` and the state after trigger ``number - 1`` give the
    batches closed by it and the state after it, under ``root``."""
    spark, keys, order = rows.sparkSession, list(keys), list(order)
    root = root.rstrip("/")
    schema = rows.schema
    before = f"{root}/state/{number - 1}"
    known = bool(list_names(spark, before))
    everything = rows.unionByName(spark.read.schema(schema).parquet(f"{before}/open")) if known else rows
    untimed = everything.where(F.col(ms).isNull())
    untimed.write.mode("overwrite").parquet(f"{root}/untimed/{number}")
    tagged = B.assign_batches(everything.where(F.col(ms).isNotNull()), keys, ms, order, size, timeout_ms)
    tagged.write.mode("overwrite").parquet(f"{root}/work/{number}")         # read three times below
    tagged = spark.read.schema(tagged.schema).parquet(f"{root}/work/{number}")

    stats = B.batch_stats(tagged, keys, ms)
    # only a key's last batch can be open; its rows are fewer than size
    newest = stats.groupBy(*keys).agg(F.max("batch_id").alias("_newest"))
    last = _renamed(newest, keys, "_newest")
    stats = stats.join(last, _equal(stats, last, keys)).drop(*[f"_{k}" for k in keys])
    closed = (F.col("n") >= size) | (F.col("last_ms") - F.col("first_ms") >= timeout_ms)
    stats = stats.withColumn("_open", (F.col("batch_id") == F.col("_newest")) & ~closed)
    if known:
        ids = _renamed(spark.read.parquet(f"{before}/next"), keys, "next_id")
    else:
        ids = _renamed(newest, keys, F.lit(0).cast("long").alias("next_id")).limit(0)
    stats = stats.join(ids, _equal(stats, ids, keys), "left").withColumn("_from", F.coalesce("next_id", F.lit(0)))
    stats = stats.select(*keys, "batch_id", "n", "first_ms", "last_ms", "_open", "_from",
                         (F.col("batch_id") == F.col("_newest")).alias("_last"))
    stats.write.mode("overwrite").parquet(f"{root}/stats/{number}")
    stats = spark.read.schema(stats.schema).parquet(f"{root}/stats/{number}")

    out = stats.where(~F.col("_open")).select(*keys, (F.col("batch_id") + F.col("_from")).alias("batch_id"), "n",
                                              "first_ms", "last_ms")
    out.write.mode("overwrite").parquet(f"{root}/closed/{number}")
    now = f"{root}/state/{number}"
    left = _renamed(stats.where("_open"), keys, F.col("batch_id").alias("_batch"))
    still = tagged.join(left, _equal(tagged, left, keys) & (tagged["batch_id"] == left["_batch"]), "left_semi")
    still.select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{now}/open")
    after = stats.where("_last").select(*keys, (
        F.col("_from") + F.col("batch_id") + F.when(F.col("_open"), 0).otherwise(1)).alias("next_id"))
    if known:       # keys that had no row in this trigger
        old = spark.read.parquet(f"{before}/next")
        seen = _renamed(after, keys)
        after = after.unionByName(old.join(seen, _equal(old, seen, keys), "left_anti").select(*keys, "next_id"))
    after.write.mode("overwrite").parquet(f"{now}/next")
    for name in (f"work/{number}", f"stats/{number}", f"state/{number - 2}"):
        path, fs = hadoop_path(spark, f"{root}/{name}")
        fs.delete(path, True)


def start_hot_batches(records: DataFrame, root: str, checkpoint: str, keys: Sequence[str], ms: str,
                      order: Sequence[str], size: int, timeout_ms: int, trigger: dict | None = None) -> StreamingQuery:
    """Batches of a stream of records; :func:`closed_batches` and
    :func:`open_batches` read them."""
    return (records.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .foreachBatch(lambda df, n: fold_trigger(df, n, root, keys, ms, order, size, timeout_ms)).start())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n) for n in list_names(spark, folder) if n.isdigit())


def closed_batches(spark: SparkSession, root: str) -> DataFrame | None:
    """``keys, batch_id, n, first_ms, last_ms`` of all closed batches."""
    done = _numbers(spark, f"{root}/closed")
    return spark.read.parquet(*[f"{root}/closed/{n}" for n in done]) if done else None


def open_batches(spark: SparkSession, root: str, keys: Sequence[str], ms: str) -> DataFrame | None:
    """A6 at the end of a stream: the batches that are still open."""
    done = _numbers(spark, f"{root}/state")
    if not done:
        return None
    now = f"{root}/state/{done[-1]}"
    rows = spark.read.parquet(f"{now}/open").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms"))
    ids = _renamed(spark.read.parquet(f"{now}/next"), keys, "next_id")
    return rows.join(ids, _equal(rows, ids, keys)).select(
        *keys, F.col("next_id").alias("batch_id"), "n", "first_ms", "last_ms")
