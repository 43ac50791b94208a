"""Objects under the names the feeds' users know (K5, S9, S10): one JSON array
per flush at ``{source}/YYYY-MM-DDTHH-MM-SS.json`` (F7), and a manifest of them.

The array is never gathered. Each record is one line of the object, the first
with ``[`` before it, the others with ``,``, the last with ``]`` behind it; a
window numbers a flush's lines as a stream and Spark's text writer puts them into
one file per flush in a staging folder. When that job has committed, each file is
renamed to its public name: readers see whole objects only, and a write that
failed leaves none. An object of the same name is replaced (A9). The renames are
the driver's, by name alone (a task has no access to the store's rename); no
record passes through it.

The manifest, a Parquet table in ``manifest.parquet`` beside the objects, has one row
per object written: its key, its records' earliest and latest event time, how
many they are and the object's bytes. It is appended after the renames; the
newest row of a key counts. A crash in between, or objects put there or removed
by others, leave it behind the folder: :func:`repair_manifest` compares the two
and indexes only what differs.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.scalar import key_time
from tickloom.session import scratch_path
from tickloom.sources import files as FS
from tickloom.sources import objects as OB

RENAME_THREADS = 16


def write_objects(flushed: DataFrame, root: str, order=("ingest_ts",), event_ms: str = "event_ms") -> None:
    """Write envelope rows (``data, source, object_key`` from ``flush_groups``,
    the ``order`` columns and the records' event time in ms) as objects, and add
    them to the manifest. Records of equal key share an object. Rows without a
    key (no ingest time, or no source) cannot be named: they go to ``unnamed.parquet``."""
    spark, root = flushed.sparkSession, root.rstrip("/")
    by = [f"_o{i}" for i in range(len(order))]
    rows = flushed.select(
        "source", F.substring_index("object_key", "/", -1).alias("object"), F.coalesce("data", F.lit("null")).alias("data"),
        F.col(event_ms).cast("long").alias("event_ms"), *[F.col(o).alias(b) for o, b in zip(order, by)])
    staged = scratch_path(spark, "object-rows")
    rows.write.parquet(staged)              # read twice: for the objects and for their index
    rows = spark.read.schema(rows.schema).parquet(staged)
    named = rows.where(F.col("object").isNotNull())
    rows.where(F.col("object").isNull()).select("source", "data", "event_ms").write.mode("append").parquet(f"{root}/unnamed.parquet")

    # the writer's partition columns lead the window's sort, so the rows reach it in order
    place = Window.partitionBy("source", "object").orderBy(*by, "data")
    first, last = F.row_number().over(place) == 1, F.lead(F.lit(1)).over(place).isNull()
    line = F.concat(F.when(first, "[").otherwise(","), F.col("data"), F.when(last, "]").otherwise(""))
    parts = f"{root}/_staging-{uuid.uuid4().hex}"
    (named.select(line.alias("value"), "source", "object").write.partitionBy("source", "object")
     .option("compression", "none").option("maxRecordsPerFile", 0)
     # tasks may commit straight into the staging folder: nobody reads it before the job is done
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(parts))
    _publish(spark, parts, root)
    index = named.groupBy("source", "object").agg(
        F.min("event_ms").alias("first_event_ms"), F.max("event_ms").alias("last_event_ms"),
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("data") + 2).alias("_len"))
    _append(index.select(F.concat("source", F.lit("/"), "object").alias("object_key"), "source", "first_event_ms",
                         "last_event_ms", "rows", (F.col("_len") + 1).alias("bytes"), F.lit(True).alias("lines")), root)
    FS.hadoop_path(spark, parts)[1].delete(FS.hadoop_path(spark, parts)[0], True)


def _publish(spark: SparkSession, parts: str, root: str) -> None:
    moves = {}
    for path, _ in FS.list_files(spark, f"{parts}/source=*/object=*/part-*"):
        source, name = (unquote(p.split("=", 1)[1]) for p in path.split("/")[-3:-1])
        if (source, name) in moves:
            raise RuntimeError(f"{source}/{name} was written in two parts")
        moves[source, name] = path
    for source in {s for s, _ in moves}:
        FS.make_folder(spark, f"{root}/{source}")
    with ThreadPoolExecutor(RENAME_THREADS) as pool:
        list(pool.map(lambda m: FS.publish(spark, m[1], f"{root}/{m[0][0]}/{m[0][1]}"), moves.items()))


def _append(index: DataFrame, root: str) -> None:
    index = index.withColumn("object_ts", key_time(F.col("object_key"))).withColumn(
        "written", F.lit(time.time_ns() // 1000))
    (index.select(*OB.MANIFEST.fieldNames()).sortWithinPartitions("source", "first_event_ms")
     .write.mode("append").parquet(f"{root}/manifest.parquet"))


def repair_manifest(spark: SparkSession, root: str, sources=("kucoin", "binance")) -> DataFrame:
    """Bring the manifest up to the folder: objects it lacks, or that have other
    bytes than it says, are read and indexed; entries whose object is gone are
    closed. Returns ``object_key, change`` (``added`` or ``gone``)."""
    root = root.rstrip("/")
    there = OB.listed(spark, root, sources).select("object_key", "source", F.col("length").alias("_length"))
    known = OB.read_manifest(spark, root)
    same = known.select(F.col("object_key").alias("_key"), F.col("bytes").alias("_bytes"))
    new = there.join(same, (there["object_key"] == same["_key"]) & (there["_length"] == same["_bytes"]), "left_anti")
    gone = known.join(there.select("object_key"), "object_key", "left_anti")
    changes = new.select("object_key", F.lit("added").alias("change")).unionByName(
        gone.select("object_key", F.lit("gone").alias("change")))
    path = scratch_path(spark, "manifest-changes")
    changes.write.parquet(path)             # fixed before the manifest changes
    changes = spark.read.schema(changes.schema).parquet(path)
    for source in sources:
        mine = new.where(F.col("source") == source)
        names = [r[0] for r in mine.select("object_key").collect()]         # names of what differs only
        if not names:
            continue
        found = OB.records(spark, [f"{root}/{n}" for n in names], source, lines=False).groupBy("object_key").agg(
            F.min("event_ms").alias("first_event_ms"), F.max("event_ms").alias("last_event_ms"),
            F.count(F.lit(1)).alias("rows"))
        _append(mine.join(found, "object_key", "left").select(
            "object_key", "source", "first_event_ms", "last_event_ms",
            F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.col("_length").alias("bytes"),
            F.lit(False).alias("lines")), root)
    dead = changes.where(F.col("change") == "gone")
    none = F.lit(None).cast("long")
    _append(dead.select("object_key", F.substring_index("object_key", "/", 1).alias("source"),
                        none.alias("first_event_ms"), none.alias("last_event_ms"), F.lit(0).cast("long").alias("rows"),
                        none.alias("bytes"), F.lit(False).alias("lines")), root)
    return changes
