"""Helpers shared by the operators: staged tables, the word rule, and the
fixed-size membership bitmap that keeps texts out of shuffles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import scratch_path

#: A word is a run of anything but ASCII white space (Java and Python agree).
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a membership bitmap: 1 MB however large the table is.
BITMAP_BITS = 1 << 23
_PAGE = 32768       # bits in one value of bitmap_construct_agg


#: Texts handed to a Python worker at once; Spark's own bound is 64 MB, of which
#: the worker then holds copies.
BATCH_BYTES = 8 << 20
_DEFAULT_BATCH = "67108864b"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, where the session says nothing else."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == _DEFAULT_BATCH:
        spark.conf.set(name, str(BATCH_BYTES))


def giving_back(run):
    """``run`` of a mapInArrow; at the end of its task the worker, which Spark keeps
    for later tasks, returns what it no longer needs to the system."""
    def whole(batches):
        import ctypes

        import pyarrow as pa
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
        if trim is not None:
            trim(0)
    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors and fixes row ids once assigned."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replacing(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` without columns that an operator's results replace by name."""
    return docs.drop(*names)


def text_of(name: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def bitmap(keys: DataFrame, key: Column, bits: int = BITMAP_BITS) -> DataFrame:
    """Fixed-size bitmap of the hashed ``key`` values: at most ``bits / 32768``
    rows of 4 KB, so it may be broadcast at any input size."""
    slot = F.pmod(key, F.lit(bits)).cast("long")
    return (keys.select((slot / _PAGE).cast("long").alias("_page"), (slot % _PAGE).alias("_bit"))
            .groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def in_bitmap(rows: DataFrame, key: Column, bm: DataFrame, flag: str, bits: int = BITMAP_BITS) -> DataFrame:
    """``rows`` plus boolean ``flag``: true for every key in the bitmap, and by
    chance for a few others; callers treat it as a filter that only ever lets
    too much through. Map-side only, the rows are not shuffled."""
    rows = rows.withColumn("_slot", F.pmod(key, F.lit(bits)).cast("long"))
    rows = rows.withColumn("_page", (F.col("_slot") / _PAGE).cast("long"))
    hit = F.expr("shiftright(cast(conv(hex(substring(_bits, cast((_slot % 32768) div 8 as int) + 1, 1)), 16, 10) "
                 "as int), cast(_slot % 8 as int)) % 2 = 1")
    return (rows.join(F.broadcast(bm), "_page", "left")
            .withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_page", "_slot", "_bits"))


def drop_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped`` (column ``_drop``).
    Only rows that the bitmap lets through are shuffled."""
    cols, key = docs.columns, F.xxhash64(F.col(id_col))
    rows = in_bitmap(docs, key, bitmap(dropped, F.xxhash64("_drop")), "_maybe")
    checked = rows.where("_maybe").join(dropped, rows[id_col] == dropped["_drop"], "left_anti")
    return rows.where(~F.col("_maybe")).select(*cols).unionByName(checked.select(*cols))


def groups_of(batches, keys: int):
    """Over Arrow batches sorted by their first ``keys`` columns: one pyarrow
    table per group, holding no more than a batch and the group."""
    import pyarrow as pa
    held: list = []

    def same(a, i, b, j):
        return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in range(keys))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        change[0] = bool(held) and not same(held[-1], held[-1].num_rows - 1, batch, 0)
        for k in range(keys):
            col = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= col[1:] != col[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n] if not change[0] else [*np.flatnonzero(change).tolist(), n]
        if change[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and a:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
