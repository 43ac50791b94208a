"""Finding and filling gaps of a feed.

A gap is a silence of a key (say source and symbol) longer than what is
tolerated. Ticks are first reduced to one row per key and slot of time as long as
that tolerance: two ticks of one slot are never further apart, so every gap shows
between the last tick of one slot and the first of the next that has any. A key's
window then holds one row per slot, however many ticks it has.

Bounds are exclusive: ``after_ms`` and ``before_ms`` are the ticks around the
silence (or lie just outside the span), so what a replay finds strictly between
them cannot be there already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.sources.files import list_names

MERGE_MS = 86_400_000       # ranges are merged within days first


def find_gaps(ticks: DataFrame, keys: Sequence[str], ms: str, tolerance_ms: int, span: tuple[int, int] | None = None,
              expected: DataFrame | None = None) -> DataFrame:
    """``keys, after_ms, before_ms, silence_ms`` of every silence longer than
    ``tolerance_ms``. With ``span`` (ms, both inclusive), silences at its ends
    count too, and so do keys of ``expected`` that have no tick at all. Ticks
    without a time, and outside the span, are not looked at."""
    keys, t = list(keys), F.col(ms)
    seen = ticks.where(t.isNotNull() if span is None else t.between(*span))
    slots = seen.groupBy(*keys, F.floor(t / tolerance_ms).alias("_slot")).agg(
        F.min(t).alias("_first"), F.max(t).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_slot")
    rows = slots.select(*keys, F.lag("_last").over(before).alias("after_ms"), F.col("_first").alias("before_ms"))
    if span is None:
        rows = rows.where(F.col("after_ms").isNotNull())
    else:
        low, high = (F.lit(x).cast("long") for x in (span[0] - 1, span[1] + 1))
        ends = slots.groupBy(*keys).agg(F.max("_last").alias("after_ms")).withColumn("before_ms", high)
        rows = rows.withColumn("after_ms", F.coalesce("after_ms", low)).unionByName(ends)
        if expected is not None:
            e = expected.select(*keys).distinct()
            have = slots.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
            same = F.lit(True)
            for k in keys:
                same = same & e[k].eqNullSafe(have[f"_{k}"])
            rows = rows.unionByName(e.join(have, same, "left_anti").select(
                *keys, low.alias("after_ms"), high.alias("before_ms")))
    silence = F.col("before_ms") - F.col("after_ms")
    return rows.withColumn("silence_ms", silence).where(F.col("silence_ms") > tolerance_ms)


def _islands(ranges: DataFrame, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("after_ms", "before_ms")
    reach = F.max("before_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("after_ms") > reach, F.lit(True)).cast("long")
    return (ranges.withColumn("_island", new).withColumn("_island", F.sum("_island").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*by, "_island").agg(F.min("after_ms").alias("after_ms"), F.max("before_ms").alias("before_ms"),
                                     F.sum("gaps").alias("gaps")).drop("_island"))


def merge_ranges(gaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Overlapping gaps of ``by`` (say the source) as one range: ``by, after_ms,
    before_ms, gaps``. They are merged per day first, so the last window holds
    what is left of each day."""
    by = list(by)
    rows = gaps.select(*by, "after_ms", "before_ms", F.lit(1).cast("long").alias("gaps"))
    daily = _islands(rows.withColumn("_day", F.floor(F.col("after_ms") / MERGE_MS)), [*by, "_day"]).drop("_day")
    return _islands(daily, by)


def replay_gaps(spark: SparkSession, lake_root: str, gaps: DataFrame) -> DataFrame | None:
    """The lake's ticks that lie strictly inside a gap of their source and symbol;
    None if the lake has no folder for them. Only the day folders that the merged
    ranges touch are read, and within them the hours that a gap covers."""
    root = lake_root.rstrip("/")
    hour_ms = 3_600_000
    ranges = merge_ranges(gaps, ["source"])
    days = ranges.select("source", F.explode(F.sequence(
        F.floor((F.col("after_ms") + 1) / MERGE_MS), F.floor((F.col("before_ms") - 1) / MERGE_MS))).alias("d"))
    days = days.select("source", F.date_format(F.timestamp_millis(F.col("d") * MERGE_MS), "yyyy-MM-dd")).distinct()
    paths, have = [], {}
    for source, day in days.collect():              # names of day folders
        have.setdefault(source, set(list_names(spark, f"{root}/source={source}")))
        if f"dt={day}" in have[source]:
            paths.append(f"{root}/source={source}/dt={day}")
    if not paths:
        return None
    lake = spark.read.option("basePath", root).parquet(*paths)
    hours = gaps.select("source", "symbol", "after_ms", "before_ms", F.explode(F.sequence(
        F.floor((F.col("after_ms") + 1) / hour_ms), F.floor((F.col("before_ms") - 1) / hour_ms))).alias("_h"))
    at = F.timestamp_millis(F.col("_h") * hour_ms)
    hours = hours.select("source", "symbol", "after_ms", "before_ms", F.date_format(at, "yyyy-MM-dd").alias("dt"),
                         F.hour(at).alias("hour"))
    ms = F.unix_millis("time")
    found = lake.join(hours, ["source", "symbol", "dt", "hour"])
    return found.where((ms > F.col("after_ms")) & (ms < F.col("before_ms"))).drop("after_ms", "before_ms")
