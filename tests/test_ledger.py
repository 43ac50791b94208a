"""Messages sent twice are read once; messages that are equal are not lost."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickloom.sinks import ledger as L


def _values(df):
    return sorted(r.value for r in df.collect())


def _topic(spark, root):
    return spark.read.schema(L.MESSAGE_SCHEMA).parquet(f"{root}/topic")


def _producer(spark, root, send, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").repartition(3).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("value string").parquet(f"{root}/in")
    return L.start_producer(stream, "raw", send, f"{root}/ledger", f"{root}/ckpt", trigger={"availableNow": True})


def test_a_retried_batch_is_read_once(spark, tmp_dir):
    def send(df):
        df.write.mode("append").parquet(f"{tmp_dir}/topic")

    def half(df):
        send(df.where(F.pmod(F.xxhash64("value"), F.lit(2)) == 0))
        raise OSError("broker lost")

    first = ["a", "b", "b", "", None, "c"]
    _producer(spark, tmp_dir, send, first).awaitTermination()
    second = [f"m{i % 40}" for i in range(100)] + ["a"]
    with pytest.raises(StreamingQueryException):
        _producer(spark, tmp_dir, half, second).awaitTermination()
    ledger = lambda: L.read_ledger(spark, f"{tmp_dir}/ledger")
    # what the failed try has sent is held back
    assert _values(L.read_once(_topic(spark, tmp_dir), ledger())) == sorted(r for r in first if r is not None)
    _producer(spark, tmp_dir, send, []).awaitTermination()
    want = sorted(r for r in first + second if r is not None)
    assert _topic(spark, tmp_dir).count() > len(want)
    assert _values(L.read_once(_topic(spark, tmp_dir), ledger())) == want
    got = {r.batch: r for r in L.audit(_topic(spark, tmp_dir), ledger()).collect()}
    assert (got[0].expected, got[0].seen, got[0].doubled, got[0].lost) == (5, 5, 0, 0)
    assert (got[1].expected, got[1].seen, got[1].lost) == (101, 101, 0) and got[1].doubled > 0


def test_losses_and_strangers_show(spark, tmp_dir):
    rows = spark.createDataFrame([("x",), ("x",), ("y",)], "value string")
    L.produce(rows, "raw", 7, lambda df: df.where("value = 'x'").write.parquet(f"{tmp_dir}/topic"), f"{tmp_dir}/ledger")
    spark.createDataFrame([("z", None)], L.MESSAGE_SCHEMA).write.mode("append").parquet(f"{tmp_dir}/topic")
    got = L.audit(_topic(spark, tmp_dir), L.read_ledger(spark, f"{tmp_dir}/ledger")).collect()
    assert [(r["query"], r.batch, r.expected, r.seen, r.doubled, r.lost) for r in got] == [("raw", 7, 3, 2, 0, 1)]
    assert _values(L.read_once(_topic(spark, tmp_dir), L.read_ledger(spark, f"{tmp_dir}/ledger"))) == ["x", "x"]


def test_the_stamp_does_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(f"m{i % 7}",) for i in range(50)], "value string")
    stamps = [sorted(map(str, L.identified(L.stamped(rows.repartition(n), "q", 3)).collect())) for n in (1, 6)]
    assert stamps[0] == stamps[1] and len(set(stamps[0])) == 50
    assert L.stamped(rows.where("false"), "q", 3).count() == 0
