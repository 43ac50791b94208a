"""K7 as keyed state: the current price per (source, symbol) of a tick stream.

One streaming aggregate keeps, per key, the tick with the greatest (event time,
arrival order). Ticks are combined in their task before the shuffle, so a hot key
sends one row per task. A trigger reads and writes the state of the keys it has
ticks of, and the rows it emits are those keys' prices: its cost follows the keys
it changes and not the size of the table, which ``sinks.current`` writes whole.
A late tick never replaces a newer price.

The table is read from the state of the newest finished trigger
(:func:`read_prices`). The emitted rows (:func:`changes`) are for tables kept
elsewhere: a trigger that runs again replaces its own folder (T6).

Defined results: a tick without a time is older than any with one; ticks equal in
time and arrival order are decided by the greater price; a null source or symbol
is a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.sources.files import list_names

KEYS = ("source", "symbol")
ORDER = ("time", "seq", "pos")
_LATEST = "latest"


def latest_ticks(ticks: DataFrame) -> DataFrame:
    """``source, symbol`` and the winning tick as a struct."""
    for c in ORDER[1:]:
        if c not in ticks.columns:
            ticks = ticks.withColumn(c, F.lit(None).cast("long"))
    return ticks.groupBy(*KEYS).agg(F.max(F.struct(*ORDER, "price")).alias(_LATEST))


def start_price_state(ticks: DataFrame, checkpoint: str, changes_root: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """Keep the prices of a tick stream; each trigger's changed keys go to
    ``changes_root/<trigger>``."""
    def emit(rows: DataFrame, number: int) -> None:
        _flat(rows).write.mode("overwrite").parquet(f"{changes_root}/{number}")

    return (latest_ticks(ticks).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).foreachBatch(emit).start())


def _flat(rows: DataFrame, latest: str = _LATEST) -> DataFrame:
    return rows.select(*KEYS, F.col(f"{latest}.price").alias("price"), *[F.col(f"{latest}.{c}").alias(c) for c in ORDER])


def read_prices(spark: SparkSession, checkpoint: str, trigger: int | None = None) -> DataFrame:
    """The whole table after the newest finished trigger, or after ``trigger``
    (as long as the checkpoint keeps it)."""
    reader = spark.read.format("statestore")
    if trigger is not None:
        reader = reader.option("batchId", trigger)
    state = reader.load(checkpoint)
    buffer = state.schema["value"].dataType.fieldNames()[-1]
    return _flat(state.select(*[F.col(f"key.{k}").alias(k) for k in KEYS], F.col("value")[buffer].alias(_LATEST)))


def changes(spark: SparkSession, changes_root: str, since: int = -1) -> DataFrame | None:
    """Changed keys of the triggers after ``since``, with the trigger's number;
    None if there is none."""
    numbers = sorted(int(n) for n in list_names(spark, changes_root) if n.isdigit() and int(n) > since)
    parts = [spark.read.parquet(f"{changes_root}/{n}").withColumn("trigger", F.lit(n).cast("long")) for n in numbers]
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
