"""Messages that are counted once although a producer may send them twice.

Kafka's sink delivers at least once: a micro-batch that fails half-way is sent
again from its start. Here every message carries, as Kafka headers, who made it: the
query, the micro-batch, its digest and which of the equal messages of that batch it
is. Those four are the same in every try, whatever the partitioning, because they
come from the message alone: no order is imposed and no number is dealt out by one
task. Equal messages are counted before the shuffle, so a hot one is one row.

After its messages a micro-batch writes one ledger row: how many it has. Readers take
the batches in the ledger, each message once (:func:`read_once`); a batch without a
row is still being sent, or its producer died, and will be sent again.
:func:`audit` tells per batch what is expected, there, doubled and lost.

Defined results: a null message is not sent (it would delete a key in a compacted
topic); an empty text is a message; messages without the headers are not the
ledger's and are left out; equal messages of one batch all count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

IDENTITY = ("query", "batch", "digest", "copy")
MESSAGE_SCHEMA = "value string, headers array<struct<key: string, value: binary>>"
LEDGER_SCHEMA = "query string, batch long, messages long"


def stamped(messages: DataFrame, query: str, batch: int, value: str = "value") -> DataFrame:
    """``value, headers`` for Kafka's sink (``includeHeaders`` on the reading side)."""
    equal = (messages.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("string").alias("value"))
             .agg(F.count(F.lit(1)).alias("_n")))
    each = equal.select("value", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("copy"))
    stamp = {"query": F.lit(query), "batch": F.lit(batch), "digest": F.sha2("value", 256), "copy": F.col("copy")}
    return each.select("value", F.array(*(
        F.struct(F.lit(k).alias("key"), F.encode(stamp[k].cast("string"), "UTF-8").alias("value"))
        for k in IDENTITY)).alias("headers"))


def identified(messages: DataFrame) -> DataFrame:
    """Messages with their identity as columns; others have nulls there."""
    head = F.map_from_entries("headers")
    text = lambda k: F.decode(head[k], "UTF-8")
    return messages.select("value", text("query").alias("query"), text("batch").cast("long").alias("batch"),
                           text("digest").alias("digest"), text("copy").cast("long").alias("copy"))


def produce(messages: DataFrame, query: str, batch: int, send: Callable[[DataFrame], None], ledger_root: str) -> None:
    """One try of a micro-batch: all its messages, then its ledger row."""
    out = stamped(messages, query, batch)
    send(out)
    n = messages.where(F.col("value").isNotNull()).count()
    row = messages.sparkSession.createDataFrame([(query, batch, n)], LEDGER_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{ledger_root}/query={query}/number={batch}")


def start_producer(messages: DataFrame, query: str, send: Callable[[DataFrame], None], ledger_root: str,
                   checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Send a stream of messages (``value``). ``query`` names this producer and
    stays the same as long as its checkpoint does."""
    return (messages.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .foreachBatch(lambda df, n: produce(df, query, n, send, ledger_root)).start())


def read_ledger(spark: SparkSession, ledger_root: str) -> DataFrame:
    return (spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(ledger_root)
            .groupBy("query", "batch").agg(F.max("messages").alias("messages")))


def read_once(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """``value`` of every message of the batches in the ledger, each once."""
    done = ledger.select("query", "batch")
    return identified(messages).join(done, ["query", "batch"], "left_semi").dropDuplicates(list(IDENTITY)).select("value")


def audit(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per micro-batch: ``expected`` (null: not in the ledger), ``seen`` different
    messages, how many came ``doubled`` and how many are ``lost``."""
    one = identified(messages).where("digest is not null").groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("n"))
    seen = one.groupBy("query", "batch").agg(F.count(F.lit(1)).alias("seen"), F.sum(F.col("n") - 1).alias("doubled"))
    both = ledger.withColumnRenamed("messages", "expected").join(seen, ["query", "batch"], "full")
    return both.select("query", "batch", "expected", F.coalesce("seen", F.lit(0)).alias("seen"),
                       F.coalesce("doubled", F.lit(0)).alias("doubled"),
                       (F.col("expected") - F.coalesce("seen", F.lit(0))).alias("lost"))
