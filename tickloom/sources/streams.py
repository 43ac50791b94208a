"""Frame sources for bounded and streaming jobs.

Kafka (``readStream.format('kafka')``) is the production source; the connector
jar is not in this container, so the same jobs also accept a text/file source
whose rows carry the frame in a single ``value`` column, exactly like a Kafka
row's value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession



def kafka_options(bootstrap: str, topic: str, starting: str = "earliest",
                  max_offsets_per_trigger: int | None = None, extra: dict | None = None) -> dict:
    """Subscribe, start position (S4), bounded poll."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def kafka_stream(spark: SparkSession, options: dict) -> DataFrame:
    """Streaming Kafka rows (``value`` BINARY + metadata); decode with F15."""
    return spark.readStream.format("kafka").options(**options).load()


def kafka_arrival(rows: DataFrame) -> DataFrame:
    """Arrival columns of Kafka rows: ``ingest_ts``, and ``seq``, which orders by
    (partition, offset). Offsets alone repeat across partitions; 2^47 fit."""
    from pyspark.sql import functions as F
    return (rows.withColumn("ingest_ts", F.col("timestamp"))
            .withColumn("seq", F.shiftleft(F.col("partition").cast("long"), 47) + F.col("offset")))


def kafka_batch(spark: SparkSession, options: dict) -> DataFrame:
    """Bounded backfill over the same topic."""
    return spark.read.format("kafka").options(**options).load()


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S6/S7 re-aimed: one frame per line of text files dropped in ``path``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def text_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def frames_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Frames with arrival metadata (``value, ingest_ts, seq``) from a file
    folder; the stream twin of the derived feeds."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
