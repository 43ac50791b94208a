"""Message-atomic validation (P11): an array message counts whole or not at all.

Two levels, both inside the row. The message must be JSON and an array; then each
element is decoded by itself and must be an object that fits the model. The first
element that does not decides: the message is rejected with that element's
position and reason, and none of its records go on. A poll of several messages
can be taken the same way, as the consumer does that drops a whole poll for one
bad record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas as S
from tickloom.operators.decode import Split, as_text


def starts(text: Column, mark: str) -> Column:
    """Whether a JSON text's first character, after white space, is ``mark``."""
    return F.coalesce(F.ltrim(text, F.lit(" \t\r\n")).startswith(mark), F.lit(False))


def _element_reason(text: Column, record: Column, required: Sequence[str]) -> Column:
    def field(path: str) -> Column:
        c = record
        for name in path.split("."):
            c = c[name]
        return c

    reason = F.lit(None).cast("string")
    for path in reversed(list(required)):
        reason = F.when(field(path).isNull(), F.lit(f"missing:{path}")).otherwise(reason)
    is_object = starts(text, "{")
    return F.when(~is_object, F.lit("not an object")).when(record.isNull(), F.lit("malformed")).otherwise(reason)


def _once(rows: DataFrame, keep: Sequence[str], **made: Column) -> DataFrame:
    """``keep`` and the columns ``made``, each worked out once: inside a generator
    of one row each, expressions and filters above bring no copy of them."""
    one = F.struct(*[c.alias(name) for name, c in made.items()])
    rows = rows.select(*keep, F.explode_outer(F.array(one)).alias("_made"))
    return rows.select(*keep, *[F.col(f"_made.{name}").alias(name) for name in made])


def check_messages(frames: DataFrame, schema: T.StructType = S.KUCOIN, required: Sequence[str] = S.KUCOIN_REQUIRED,
                   value: str = "value") -> DataFrame:
    """``frames`` with ``raw`` for its text, ``texts`` (the elements' JSON, null in
    a rejected message), ``bad_pos`` (from 0; null if the message itself is bad)
    and ``reason`` (null: the message is valid). A message and its elements are
    parsed once each."""
    frames = as_text(frames, value)
    rest = [c for c in frames.columns if c != value]
    rows = frames.select(*rest, F.col(value).alias("raw"))
    kept, text = [*rest, "raw"], F.col("raw")
    is_array = starts(text, "[")
    rows = _once(rows, kept, _array=is_array, _texts=F.from_json(text, "array<string>"),
                 _object=F.from_json(F.when(~is_array, text), "map<string,string>").isNotNull())
    records = F.when(F.col("_array"), F.transform("_texts", lambda x: F.from_json(x, schema)))
    kept += ["_array", "_texts", "_object"]
    rows = _once(rows, kept, _records=records)
    rows = _once(rows, kept, _reasons=F.zip_with("_texts", "_records", lambda x, r: _element_reason(x, r, required)))
    bad = F.array_position(F.transform("_reasons", lambda r: r.isNotNull()), True)
    rows = _once(rows, [*kept, "_reasons"], _bad=F.nullif(bad, F.lit(0)).cast("int"))
    reason = (F.when(~F.col("_array"), F.when(F.col("_object"), F.lit("not an array")).otherwise(F.lit("malformed")))
              .when(F.col("_texts").isNull(), F.lit("malformed"))
              .when(F.col("_bad").isNotNull(), F.try_element_at("_reasons", F.col("_bad"))))
    rows = rows.withColumn("reason", reason)
    return rows.select(*rest, "raw", F.when(F.col("reason").isNull(), F.col("_texts")).alias("texts"),
                       (F.col("_bad") - 1).alias("bad_pos"), "reason")


def split_messages(checked: DataFrame, schema: T.StructType = S.KUCOIN, name: str = "msg") -> Split:
    """Records of the valid messages (decoded in ``name``, with ``pos``), and the
    rejected messages with position and reason."""
    rest = [c for c in checked.columns if c not in ("raw", "texts", "bad_pos", "reason")]
    good = checked.where(F.col("reason").isNull())
    # decoded inside the generator: filters on the record bring no copy of the parse
    decoded = F.transform("texts", lambda x: F.from_json(x, schema))
    records = good.select(*rest, "raw", F.posexplode(decoded).alias("pos", name))
    return Split(records, checked.where(F.col("reason").isNotNull()).drop("texts"))


def reject_polls(checked: DataFrame, poll: Sequence[str]) -> DataFrame:
    """One bad message rejects its whole poll (``poll`` columns): the others get
    ``reason`` 'poll' and no records. Polls are judged by a partial aggregate that
    is joined back, so a poll of any size is never in one place."""
    poll = list(poll)
    bad = checked.where(F.col("reason").isNotNull()).select(*[F.col(p).alias(f"_{p}") for p in poll]).distinct()
    same = F.lit(True)
    for p in poll:
        same = same & F.col(p).eqNullSafe(F.col(f"_{p}"))
    rows = checked.join(bad.withColumn("_hit", F.lit(True)), same, "left")
    lost = F.col("_hit").isNotNull() & F.col("reason").isNull()
    rows = rows.withColumn("texts", F.when(F.col("_hit").isNull(), F.col("texts"))).withColumn(
        "reason", F.when(lost, F.lit("poll")).otherwise(F.col("reason")))
    return rows.select(*checked.columns)
