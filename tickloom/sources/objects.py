"""Reading objects named ``{source}/YYYY-MM-DDTHH-MM-SS.json`` (S9, S10) through
their manifest (written by :mod:`tickloom.sinks.objects`).

A replay by event time reads the manifest, a Parquet table filtered by its own
min/max columns, and opens only the objects whose span touches the range; nothing
is listed. Our own objects have one record a line and are split over tasks like
any text; others are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import key_time
from tickloom.operators import decode as D
from tickloom.sources.files import list_names
from tickloom.sources.landing import _ts

MANIFEST = T.StructType([
    T.StructField("object_key", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("object_ts", T.TimestampType()),          # the time in the name
    T.StructField("first_event_ms", T.LongType()),
    T.StructField("last_event_ms", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("bytes", T.LongType()),                   # null: the object is gone
    T.StructField("lines", T.BooleanType()),                # one record a line
    T.StructField("written", T.LongType()),
])


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The newest entry of every object that is still there."""
    root = root.rstrip("/")
    if not list_names(spark, f"{root}/manifest.parquet"):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest.parquet")
    rest = [c for c in MANIFEST.fieldNames() if c != "object_key"]
    newest = rows.groupBy("object_key").agg(F.max_by(F.struct(*rest), F.col("written")).alias("_e"))
    return newest.select("object_key", "_e.*").where(F.col("bytes").isNotNull())


def listed(spark: SparkSession, root: str, sources) -> DataFrame:
    """``object_key, source, file_time, length`` of the objects in the
    folders; a file-metadata scan, and names that are no object's are skipped."""
    out = spark.createDataFrame([], "object_key string, source string, file_time timestamp, length long")
    for source in sources:
        if not list_names(spark, f"{root}/{source}"):
            continue
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{root}/{source}/")
                 .select("path", "length").withColumn("file_time", key_time(F.col("path")))
                 .where(F.col("file_time").isNotNull()))
        key = F.concat(F.lit(f"{source}/"), F.substring_index("path", "/", -1))
        out = out.unionByName(files.select(key.alias("object_key"), F.lit(source).alias("source"), "file_time", "length"))
    return out


def records(spark: SparkSession, paths: list[str], source: str, lines: bool) -> DataFrame:
    """The records of some objects of one source: ``object_key``, ``event_ms``,
    ``raw`` (the text they stood in), ``pos`` and the decoded ``msg`` or ``el``.
    With ``lines`` every line holds whole records, between the array's marks."""
    rows = spark.read.text(paths, wholetext=not lines)
    value = F.col("value")
    if lines:
        inner = F.regexp_replace(F.regexp_replace(value, r"^\s*[\[,]", ""), r"\]\s*$", "")
        value = F.concat(F.lit("["), inner, F.lit("]"))
    key = F.concat(F.lit(f"{source}/"), F.col("_metadata.file_name"))
    rows = rows.select(value.alias("value"), key.alias("object_key"))
    if source == "binance":
        found, ms = D.parse_binance(rows), "el.event_time"
    else:
        found, ms = D.parse_kucoin(rows), "msg.data.time"
    return found.withColumn("event_ms", F.col(ms))


def touching(spark: SparkSession, root: str, source: str, start, end=None) -> DataFrame:
    """Manifest entries of a source whose records' span touches ``[start, end]``."""
    first, last = (F.unix_millis(F.lit(_ts(t)).cast("timestamp")) for t in (start, end))
    return read_manifest(spark, root).where(
        (F.col("source") == source) & (F.col("last_event_ms") >= first) & (F.col("first_event_ms") <= last))


def replay_objects(spark: SparkSession, root: str, source: str, start, end=None) -> DataFrame | None:
    """The records of a source with an event time within ``[start, end]`` (both
    inclusive), from the objects that can hold one; None if there is none."""
    root, out = root.rstrip("/"), None
    first, last = (F.unix_millis(F.lit(_ts(t)).cast("timestamp")) for t in (start, end))
    hits = [tuple(r) for r in touching(spark, root, source, start, end).select("object_key", "lines").collect()]
    for lines in (True, False):
        paths = [f"{root}/{k}" for k, own in hits if own == lines]
        if paths:
            found = records(spark, paths, source, lines)
            out = found if out is None else out.unionByName(found)
    return None if out is None else out.where(F.col("event_ms").between(first, last))
