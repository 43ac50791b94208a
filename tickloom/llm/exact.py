"""Exact dedup by progressive refinement: length, then prefix hash, then full
hash. Each level looks only at rows whose group at the level before holds two
or more; which rows those are travels as a fixed-size bitmap, so no text is
shuffled to find out, and only surviving rows are hashed in full.

Defined results: null text counts as empty, and all empty texts are equal. The
row with the largest id of a group stays; a null id sorts below any other.
Repeated rows (same id, same text) count in ``group_size``; the report marks
each of them by the id, the filter keeps one. An empty table gives an empty
result. Extra columns pass through, but for those the report replaces by name;
helper columns start with ``_x_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import bitmap, in_bitmap, replacing, staged, text_of

PREFIX_CHARS = 64
_KEY = ["_x_len", "_x_head", "_x_sha"]


def _survivors(docs: DataFrame, text: str, prefix_chars: int) -> DataFrame:
    """``docs`` plus ``_x_len``, ``_x_head`` and ``_x_hit`` (may have a twin)."""
    t = text_of(text)
    rows = docs.withColumn("_x_len", F.octet_length(t).cast("long"))
    lengths = rows.groupBy("_x_len").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = in_bitmap(rows, F.col("_x_len"), bitmap(lengths, F.col("_x_len")), "_x_twin")
    # the prefix is hashed only where the length is shared
    rows = rows.withColumn("_x_head", F.when(F.col("_x_twin"), F.xxhash64(F.substring(t, 1, prefix_chars))))
    heads = (rows.where("_x_twin").groupBy("_x_len", "_x_head").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    key = F.xxhash64("_x_len", "_x_head")
    rows = in_bitmap(rows, key, bitmap(heads, key), "_x_head_twin")
    return rows.withColumn("_x_hit", F.col("_x_twin") & F.col("_x_head_twin")).drop("_x_twin", "_x_head_twin")


def exact_groups(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                 prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Report: every row without its text, plus ``keep_id``, ``group_size``, ``kept``."""
    rows = _survivors(replacing(docs, "keep_id", "group_size", "kept"), text, prefix_chars)
    rows = rows.withColumn("_x_sha", F.when(F.col("_x_hit"), F.sha2(text_of(text), 256))).drop(text)
    rows = staged(rows, "exact-rows")
    alone = (rows.where(~F.col("_x_hit")).withColumn("keep_id", F.col(id_col))
             .withColumn("group_size", F.lit(1).cast("long")))
    hit = rows.where("_x_hit")
    groups = hit.groupBy(*_KEY).agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    joined = hit.join(groups, _KEY)
    out = joined.select(*alone.columns).unionByName(alone)
    return (out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
            .drop("_x_len", "_x_head", "_x_sha", "_x_hit"))


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Filter: the columns of ``docs``, one row of each group of equal texts.
    Rows that cannot have a twin pass without a shuffle; of the others one
    partial aggregate keeps the largest, whatever a group's size."""
    cols = docs.columns
    rows = _survivors(docs, text, prefix_chars)
    alone = rows.where(~F.col("_x_hit")).select(*cols)
    best = F.max(F.struct(F.col(id_col).alias("_x_id"), F.struct(*cols).alias("_x_row"))).alias("_x_best")
    kept = (rows.where("_x_hit").withColumn("_x_sha", F.sha2(text_of(text), 256))
            .groupBy(*_KEY).agg(best).select("_x_best._x_row.*"))
    return alone.unionByName(kept)
