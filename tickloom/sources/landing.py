"""Replay from the landing zone and the tick lake.

``replay_ingest`` keeps the reference's rule: an object is in range when the
second-resolution time in its name is within ``[start, end]`` (both ends
inclusive), i.e. the ingest time of the flush's first item. The range is also
turned into ``dt``/``hour`` partition bounds, so only the matching directories
are listed and read. ``replay_event`` selects by the ticks' own event time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import key_time
from tickloom.schemas import LANDING_TIME_PATTERN, TICK
from tickloom.sources.files import matches

LANDING_SCHEMA = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("object_key", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("dt", T.StringType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("batch", T.StringType()),
])
LAKE_SCHEMA = T.StructType([*TICK.fields, T.StructField("hour_key", T.StringType()),
                            T.StructField("dt", T.StringType()), T.StructField("hour", T.IntegerType())])


def _ts(x) -> _dt.datetime:
    """A range bound; ``None`` means now (UTC), evaluated at call time (H8)."""
    if x is None:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return x if isinstance(x, _dt.datetime) else _dt.datetime.fromisoformat(str(x))


def hour_bounds(start, end) -> Column:
    """Partition predicate on ``dt`` (yyyy-MM-dd) and ``hour`` covering
    ``[start, end]``; Catalyst turns it into PartitionFilters."""
    s, e = _ts(start), _ts(end)
    d0, d1 = s.strftime("%Y-%m-%d"), e.strftime("%Y-%m-%d")
    dt, hr = F.col("dt"), F.col("hour")
    lower = (dt > d0) | ((dt == d0) & (hr >= s.hour))
    upper = (dt < d1) | ((dt == d1) & (hr <= e.hour))
    return lower & upper


def day_glob(root: str, start, end, source: str | None = None) -> str:
    """Only the day folders of the range are listed: ``dt={d0,d1,...}``."""
    s, e = _ts(start), _ts(end)
    days, d = [], s.date()
    while d <= e.date():
        days.append(d.isoformat())
        d += _dt.timedelta(days=1)
    src = f"source={source}" if source else "source=*"
    return f"{root.rstrip('/')}/{src}/dt={{{','.join(days)}}}"


def _read_range(spark: SparkSession, root: str, start, end, source, reader) -> DataFrame | None:
    days = day_glob(root, start, end, source)
    if not matches(spark, days):        # no folder for any day of the range
        return None
    return reader(spark.read.option("basePath", root), days)


def landed_reader(reader, path: str) -> DataFrame:
    return reader.schema(LANDING_SCHEMA).option("timestampFormat", LANDING_TIME_PATTERN).json(path)


def replay_ingest(spark: SparkSession, root: str, source: str, start, end=None) -> DataFrame:
    """S9 + S10: envelope rows of the flushes whose object time is in range."""
    s, e = _ts(start), _ts(end)
    df = _read_range(spark, root, s, e, source, landed_reader)
    if df is None:
        return spark.createDataFrame([], LANDING_SCHEMA)
    t = key_time(F.col("object_key"))
    return (df.where((F.col("source") == source) & hour_bounds(s, e))
            .where(t.between(F.lit(s), F.lit(e))))


def replay_event(spark: SparkSession, root: str, start, end=None, source: str | None = None) -> DataFrame:
    """H10 event-time mode over the tick lake (partitioned by event hour)."""
    s, e = _ts(start), _ts(end)
    df = _read_range(spark, root, s, e, source, lambda r, p: r.parquet(p))
    if df is None:
        return spark.createDataFrame([], LAKE_SCHEMA)
    cond = hour_bounds(s, e) & F.col("time").between(F.lit(s), F.lit(e))
    if source:
        cond = (F.col("source") == source) & cond
    return df.where(cond)


def list_objects(spark: SparkSession, root: str, source: str, start=None, end=None) -> DataFrame:
    """S10 over objects named like the reference's (``{source}/YYYY-MM-DDTHH-MM-SS.json``):
    the listing is a file-metadata scan (content is not read), names that do
    not match or do not parse are skipped (F9, F10)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
             .load(f"{root.rstrip('/')}/{source}/").select("path"))
    files = files.select("path", key_time(F.col("path")).alias("file_time")).where(F.col("file_time").isNotNull())
    if start is not None:
        files = files.where(F.col("file_time") >= F.lit(_ts(start)))
    files = files.where(F.col("file_time") <= F.lit(_ts(end)))
    return files


def read_objects(spark: SparkSession, root: str, source: str, start=None, end=None) -> DataFrame:
    """S9 over reference-style objects: each file is one JSON array (one
    flush, so bounded), read whole and decoded by the same operators as any
    frame, one row per record (``msg`` for Kucoin, ``el`` for Binance, with
    both ``e`` and ``E``). The time range is applied to the file name through
    the ``_metadata`` column, which Spark evaluates while listing, so files
    outside the range are not opened; names that do not match or do not parse
    are skipped (F9, F10)."""
    from tickloom.operators import decode as D
    files = spark.read.text(f"{root.rstrip('/')}/{source}/", wholetext=True)
    t = key_time(F.col("_metadata.file_name"))
    cond = t.isNotNull() & (t <= F.lit(_ts(end)))
    if start is not None:
        cond = cond & (t >= F.lit(_ts(start)))
    files = files.where(cond)
    files = files.select("value", F.col("_metadata.file_name").alias("object_name"))
    parse = D.parse_binance if source == "binance" else D.parse_kucoin
    return parse(files)
