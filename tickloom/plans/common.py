"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import decode as D
from tickloom.operators import normalize as N
from tickloom.session import prepare
from tickloom.sources import feeds, tables


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return tables.events(spark, sf_dir)


def kucoin_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kucoin frames from events, parsed, control frames dropped."""
    return D.drop_control_frames(D.parse_kucoin(feeds.kucoin_frames(events(spark, sf_dir))))


def binance_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.parse_binance(feeds.binance_frames(events(spark, sf_dir)))


def kucoin_ticks(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    """Valid Kucoin ticks: model validation (P12), normalisation, not-null split."""
    valid = D.validate_kucoin(kucoin_decoded(spark, sf_dir)).valid
    return N.split_ticks(N.normalize(valid, N.KUCOIN, keep=keep)).valid


def binance_ticks(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    valid = D.validate_binance(binance_decoded(spark, sf_dir)).valid
    return N.split_ticks(N.normalize(valid, N.BINANCE, keep=keep)).valid


def ntz(c) -> F.Column:
    """Query outputs carry TIMESTAMP_NTZ so they compare with naive-UTC SQL."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def tick_out(df: DataFrame) -> DataFrame:
    """The oracle-comparable tick columns (created_at is wall clock: dropped)."""
    return df.select("symbol", "price", ntz("time").alias("time"), "source")


def kucoin_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated Kucoin ticker messages with their event ms and arrival order."""
    valid = D.validate_kucoin(kucoin_decoded(spark, sf_dir)).valid
    return valid.select("*", F.col("msg.subject").alias("subject"), F.col("msg.data.time").alias("ms"),
                        F.lit("kucoin").alias("source"))


def binance_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = D.validate_binance(binance_decoded(spark, sf_dir)).valid
    return valid.select("*", F.col("el.symbol").alias("subject"), F.col("el.event_time").alias("ms"),
                        F.lit("binance").alias("source"))


def unified_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = ("seq", "pos")
    k = N.normalize(kucoin_records(spark, sf_dir), N.KUCOIN, keep=keep)
    b = N.normalize(binance_records(spark, sf_dir), N.BINANCE, keep=keep)
    return N.split_ticks(N.unify(k, b)).valid
