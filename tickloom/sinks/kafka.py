"""Kafka sinks (K1-K4). One message per batch: the JSON array in ``value``,
no key (as the reference produces). The Kafka connector jar is not part of
this container, so ``fmt`` can be switched to ``text`` for local runs: the
same single ``value`` column lands in text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import TICK_TIME_PATTERN

# Topic names of the reference deployment.
RAW_TOPICS = {"kucoin": "kucoin_raw_data", "binance": "binance_raw_data"}
TRANSFORMED_TOPICS = {"kucoin": "kucoin_transformed_data", "binance": "binance_transformed_data"}


def producer_options(bootstrap: str, topic: str, acks: str = "all", compression: str | None = "gzip",
                     extra: dict | None = None) -> dict:
    """K3 (full ack) and K4 (gzip) as Kafka sink options."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": acks}
    if compression:
        opts["kafka.compression.type"] = compression
    opts.update(extra or {})
    return opts


def messages(batches: DataFrame, message: str = "message") -> DataFrame:
    """Batch rows -> Kafka rows (``value`` only, no key)."""
    return batches.select(F.col(message).cast("string").alias("value"))


def tick_messages(arrays: DataFrame, ticks: str = "ticks") -> DataFrame:
    """K2 / hazard H6: one message per array of ticks, timestamps as ISO text.
    An array without ticks makes no message."""
    return arrays.where(F.size(ticks) > 0).select(tick_value(ticks).alias("value"))


def tick_value(ticks: str = "ticks") -> Column:
    return F.to_json(ticks, {"timestampFormat": TICK_TIME_PATTERN})


def write(df: DataFrame, options: dict, fmt: str = "kafka", path: str | None = None) -> None:
    """Batch write of Kafka rows; ``fmt='text'`` writes the values to ``path``."""
    if fmt == "kafka":
        df.select("value").write.format("kafka").options(**options).save()
    else:
        df.select("value").write.mode("append").text(path)


def write_stream(df: DataFrame, options: dict, checkpoint: str, fmt: str = "kafka",
                 path: str | None = None, trigger: dict | None = None):
    w = df.select("value").writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "1 second"}))
    if fmt == "kafka":
        return w.format("kafka").options(**options).start()
    return w.format("text").option("path", path).start()
