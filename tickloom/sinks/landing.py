"""Landing zone and tick lake writers (K5, K6, A5 flushes).

The reference uploads one JSON array per flush to ``{source}/{ts}.json``
(second-resolution ingest time of the first item; the same key overwrites).
Here a flush is a group of envelope rows that share ``object_key``; rows go to a
Hive-style layout ``source=/dt=/hour=/batch=`` so replay can prune directories.
``batch`` names the write: nothing is lost when two flushes share a second, and
a micro-batch that is written again replaces its own files and no others (T6).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import hourly_key, object_name
from tickloom.schemas import LANDING_TIME_PATTERN
from tickloom.sources.files import read_small


def partition_columns(ts: str | Column) -> list[Column]:
    t = F.col(ts) if isinstance(ts, str) else ts
    return [F.date_format(t, "yyyy-MM-dd").alias("dt"), F.hour(t).alias("hour")]


def window_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned window of a time, in ms; null for a null time
    (``F.window`` would drop the row)."""
    ms = F.unix_millis(ts)
    return ms - F.pmod(ms, F.lit(seconds * 1000))


def flush_groups(env: DataFrame, seconds: int = 60) -> DataFrame:
    """A5 in bounded form: envelope rows -> flushes of ``seconds`` of ingest time
    per source (aligned windows), each named after its first item (A4 + F7).
    Rows without an ingest time stay, in a flush without a name.

    The first time of a flush is a partial aggregate; the small result is joined
    back, so a flush is never gathered in one task."""
    rows = env.withColumn("_flush", window_start(F.col("ingest_ts"), seconds))
    first = (rows.groupBy(F.col("source").alias("_src"), F.col("_flush").alias("_at"))
             .agg(F.min("ingest_ts").alias("object_ts")))
    same = rows["source"].eqNullSafe(first["_src"]) & rows["_flush"].eqNullSafe(first["_at"])
    return (rows.join(first, same).withColumn("object_key", object_name(F.col("source"), F.col("object_ts")))
            .drop("_flush", "_src", "_at"))


def write_landing(flushed: DataFrame, root: str, compression: str | None = None,
                  by_event: str | None = None, batch: str | None = None) -> None:
    """K5: write envelope rows (``data, ingest_ts, source, object_key``) as JSON
    lines under ``root/source=/dt=/hour=/batch=`` of the object (ingest) time.
    Plain JSON by default, like the reference's ``.json`` objects, which also
    keeps the files splittable for replay. Pass ``by_event`` (an event-time
    column) to lay the zone out by event hour instead (K6), gzip-compressed by
    default, like ``.json.gz`` keys. ``batch`` names this write; writing the same
    name again replaces those files only. By default the name is new."""
    if compression is None:
        compression = "gzip" if by_event else "none"
    part_ts = by_event or "object_ts"
    out = flushed.select("data", "ingest_ts", "object_key", "source", *partition_columns(part_ts),
                         F.lit(batch or uuid.uuid4().hex).alias("batch"))
    n = int(out.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # contiguous ranges down to the time: few folders per task, and a hot hour
    # is still cut across tasks
    out = out.repartitionByRange(n, "source", "dt", "hour", "ingest_ts").sortWithinPartitions(
        "source", "dt", "hour", "ingest_ts")
    # only a name that may have been written before has anything to replace
    w = out.write.mode("append") if batch is None else out.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic")
    (w.partitionBy("source", "dt", "hour", "batch").option("compression", compression)
     .option("timestampFormat", LANDING_TIME_PATTERN).json(root))


def micro_batch_name(spark, checkpoint: str, batch_id: int) -> str:
    """A name for a streaming query's micro-batch that no other query and no
    later checkpoint shares: the query id stored in the checkpoint, and the
    batch id."""
    import json
    query = json.loads(read_small(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
    return f"{query}-{batch_id}"


def write_ticks(ticks: DataFrame, root: str) -> None:
    """K6 for curated ticks: Parquet under ``source=/dt=/hour=`` of *event*
    time, with the reference's hourly object key kept as a column (F8)."""
    out = ticks.select("*", hourly_key(F.col("source"), F.col("time")).alias("hour_key"),
                       *partition_columns("time"))
    _cluster(out, "time").write.mode("append").partitionBy("source", "dt", "hour").parquet(root)


def _cluster(df: DataFrame, ts: str) -> DataFrame:
    """Contiguous (source, dt, hour, time) ranges per task: each task writes
    few directories (no small-file blow-up), and a hot hour is still cut
    across tasks because the range key goes down to the timestamp. Parquet
    files come out sorted by time, so min/max stats prune row groups."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, "source", "dt", "hour", ts).sortWithinPartitions("source", "dt", "hour", ts)
