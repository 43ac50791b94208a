"""Price history with intervals of validity, merged out of order.

The table is a log of change points, Parquet under ``source=/dt=`` of event time
and only ever appended to. A point's price holds from its time to that of the next
point of its key; the end is worked out on reading, so a late tick splits the
interval it falls into without any stored row being changed. Points of equal key
and time are one: the latest arrival counts, however often and in whatever order
they were merged, so a merge that runs again changes nothing.

No window holds a key's whole history: within a day it is the points of the day,
between days one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.latest import latest_by_key
from tickloom.sources.files import matches

KEY = ["source", "symbol"]
SCHEMA = "symbol string, price double, time timestamp, seq long, pos long, source string, dt string"


def merge_history(ticks: DataFrame, root: str) -> None:
    """Append ticks (``source, symbol, price, time`` and, for ties, ``seq, pos``);
    the cost is that of the new rows. Ticks without a time have no interval and
    are left out."""
    day = F.date_format("time", "yyyy-MM-dd").alias("dt")
    order = [(F.col(c).cast("long") if c in ticks.columns else F.lit(None).cast("long")).alias(c) for c in ("seq", "pos")]
    rows = ticks.where(F.col("time").isNotNull()).select("symbol", "price", "time", *order, "source", day)
    n = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartitionByRange(n, "source", "dt", "time").sortWithinPartitions("source", "dt", "time")
     .write.mode("append").partitionBy("source", "dt").parquet(root))


def points(spark: SparkSession, root: str) -> DataFrame:
    """One row per key and time: the change points."""
    if not matches(spark, f"{root.rstrip('/')}/source=*"):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(root)
    return latest_by_key(rows, [*KEY, "dt", "time"], ["seq", "pos"], ["price"])


def intervals(spark: SparkSession, root: str) -> DataFrame:
    """``source, symbol, price, valid_from, valid_to``; null: it still holds."""
    rows = points(spark, root)
    first = rows.groupBy(*KEY, "dt").agg(F.min("time").alias("_first"))
    days = first.withColumn("_next", F.lead("_first").over(Window.partitionBy(*KEY).orderBy("dt"))).drop("_first")
    inside = F.lead("time").over(Window.partitionBy(*KEY, "dt").orderBy("time"))
    rows = rows.withColumn("_inside", inside).join(days, [*KEY, "dt"])
    return rows.select(*KEY, "price", F.col("time").alias("valid_from"), F.coalesce("_inside", "_next").alias("valid_to"))


def price_at(spark: SparkSession, root: str, instants: DataFrame) -> DataFrame:
    """The price of every key at each instant (column ``at``): ``at, source, symbol,
    price, time``, the time being when that price came. Keys without an earlier
    point are left out."""
    at = instants.select("at").where(F.col("at").isNotNull()).distinct().withColumn("dt", F.date_format("at", "yyyy-MM-dd"))
    rows = points(spark, root)
    that_day = rows.join(at, "dt").where(F.col("time") <= F.col("at"))
    that_day = latest_by_key(that_day, ["at", *KEY], ["time"], ["price", "time"])
    # the last point of each earlier day, and the instants, in one row per day and key
    last = latest_by_key(rows, [*KEY, "dt"], ["time"], ["price", "time"])
    keys = last.select(*KEY).distinct()
    if at.count() > MAX_INSTANTS:
        raise ValueError(f"at most {MAX_INSTANTS} instants at once")
    listed = at.agg(F.collect_set(F.struct("at", "dt")).alias("_at"))          # one row, checked above
    asked = keys.withColumn("_one", F.lit(1)).join(F.broadcast(listed.withColumn("_one", F.lit(1))), "_one")
    asked = asked.select(*KEY, F.explode("_at").alias("_i")).select(*KEY, "_i.at", "_i.dt")
    point = F.struct("price", "time")
    both = last.select(*KEY, "dt", F.lit(None).cast("timestamp").alias("at"), point.alias("_p")).unionByName(
        asked.select(*KEY, "dt", "at", F.lit(None).cast("struct<price: double, time: timestamp>").alias("_p")))
    # by day, and of one day the instants first: they look at earlier days only
    order = Window.partitionBy(*KEY).orderBy("dt", F.col("_p").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("_p", F.last("_p", ignorenulls=True).over(order)).where(F.col("at").isNotNull())
    found = carried.join(that_day.select("at", *KEY, F.struct("price", "time").alias("_d")), ["at", *KEY], "left")
    found = found.withColumn("_p", F.coalesce("_d", "_p")).where(F.col("_p").isNotNull())
    return found.select("at", *KEY, "_p.price", "_p.time")


#: Instants asked for at once; each is a row per key in the last window.
MAX_INSTANTS = 10_000
