"""Frame decoding and validation.

Decoding is ``from_json`` with a fixed schema, which also drops unknown keys
(P13). Validation never throws in the default *permissive* mode: every row
gets a ``reason`` (null: valid), and :func:`validate_kucoin` /
:func:`validate_binance` split on it into ``valid`` and ``rejects(raw,
reason)`` DataFrames (P12). *Strict*
mode reproduces the reference's fail-fast consumer: malformed JSON raises via
FAILFAST parsing and a failed rule raises via ``raise_error`` (P11).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import ArrayType

from tickloom import schemas as S
from tickloom.functions.scalar import present, utf8_decode


class Split(NamedTuple):
    valid: DataFrame
    rejects: DataFrame


def as_text(frames: DataFrame, value: str = "value") -> DataFrame:
    """Kafka rows carry BINARY values; text sources carry STRING."""
    dt = dict(frames.dtypes)[value]
    if dt == "binary":
        return frames.withColumn(value, utf8_decode(value))
    return frames


def parse_kucoin(frames: DataFrame, value: str = "value", strict: bool = False,
                 schema: T.StructType = S.KUCOIN) -> DataFrame:
    """F14 (+ A7): Kucoin frames -> one row per message in ``msg``.

    A WebSocket frame is one JSON object and a Kafka raw message is a JSON
    array of them (K1); both decode with the array schema (a lone object
    becomes a one-element array, hazard H14) and are exploded, ``pos`` being
    the position in the frame. The parse runs once, inside the generator:
    predicates on ``msg`` stay above it instead of being pushed down with a
    copy of ``from_json`` each. A frame that is not JSON yields one row with
    a null ``msg`` (rejected as malformed); ``[]`` yields none.
    Passthrough columns (``ingest_ts``, ``seq`` ...) are kept; ``raw`` keeps the text.
    ``schema`` narrows the decode (P1): ``schemas.KUCOIN_TICK_SOURCE`` reads
    only what the tick transform selects, as the reference's transformer does.
    """
    frames = as_text(frames, value)
    rest = [c for c in frames.columns if c != value]
    opts = {"mode": "FAILFAST"} if strict else {}
    msgs = F.from_json(F.col(value), ArrayType(schema), opts)
    return _explode_frames(frames.select(*rest, F.col(value).alias("raw"), msgs.alias("els")), rest, "msg")


def _explode_frames(parsed: DataFrame, rest: list[str], name: str) -> DataFrame:
    # explode_outer also emits a row for an empty array; keep only the null
    # array case (garbage) so it can be rejected, and drop the empty frames.
    return (parsed.select(*rest, "raw", F.col("els").isNull().alias("_garbage"),
                          F.posexplode_outer("els").alias("pos", name))
            .where(F.col(name).isNotNull() | F.col("_garbage"))
            .drop("_garbage"))


def is_ticker_frame(msg: str = "msg") -> Column:
    """Keep iff ``subject`` and ``data`` are present (drops welcome/ack)."""
    return present(F.col(f"{msg}.subject")) & present(F.col(f"{msg}.data"))


def is_message(msg: str = "msg") -> Column:
    """P5: keep iff ``type == 'message'`` and ``subject`` is present."""
    return (F.col(f"{msg}.type") == "message") & present(F.col(f"{msg}.subject"))


def drop_control_frames(parsed: DataFrame, msg: str = "msg") -> DataFrame:
    """P4. A frame that did not parse is no control frame: it stays, with a
    null message, so that validation rejects it as malformed."""
    return parsed.where(is_ticker_frame(msg) | F.col(msg).isNull())


def keep_messages(parsed: DataFrame, msg: str = "msg") -> DataFrame:
    return parsed.where(F.coalesce(is_message(msg), F.lit(False)))


def _first_failure(checks: list[tuple[Column, str]]) -> Column:
    """The reason of the first failing check, null when all pass."""
    expr = F.lit(None).cast("string")
    for ok, reason in reversed(checks):
        expr = F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)).otherwise(expr)
    return expr


def _split(df: DataFrame, reason: Column, strict: bool) -> Split:
    if strict:
        checked = df.withColumn("_reason", reason).withColumn(
            "_ok", F.when(F.col("_reason").isNull(), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("invalid record: "), F.col("_reason"))).cast("boolean")))
        return Split(checked.where("_ok").drop("_reason", "_ok"), df.limit(0).select(
            F.col("raw"), F.lit(None).cast("string").alias("reason")))
    tagged = df.withColumn("_reason", reason)
    valid = tagged.where(F.col("_reason").isNull()).drop("_reason")
    # rejects keep the raw text, the reason and the arrival columns (not the decoded struct)
    keep = [c for c in df.columns if c not in ("msg", "el", "pos")]
    rejects = tagged.where(F.col("_reason").isNotNull()).select(*keep, F.col("_reason").alias("reason"))
    return Split(valid, rejects)


def _has_field(schema: T.DataType, path: str) -> bool:
    for name in path.split("."):
        if not isinstance(schema, T.StructType) or name not in schema.names:
            return False
        schema = schema[name].dataType
    return True


def model_reason(rows: DataFrame, record: str, required) -> Column:
    """Why a decoded record breaks its model, null if it does not: JSON that did
    not parse is ``malformed``; otherwise every required field that the decode's
    schema holds (P1 may have narrowed it) must be present."""
    checks: list[tuple[Column, str]] = [(F.col(record).isNotNull(), "malformed")]
    schema = rows.schema[record].dataType
    checks += [(present(F.col(f"{record}.{f}")), f"missing:{f}") for f in required if _has_field(schema, f)]
    return _first_failure(checks)


def validate_kucoin(parsed: DataFrame, msg: str = "msg", strict: bool = False) -> Split:
    """P11/P12 for Kucoin ticker frames (control frames must be dropped first)."""
    return _split(parsed, model_reason(parsed, msg, S.KUCOIN_REQUIRED), strict)


def binance_elements(value: str = "value", strict: bool = False) -> Column:
    """F12 for Binance: the frame's elements as ARRAY<STRUCT> with friendly
    names. One parse with the wire schema (``e`` and ``E`` match
    case-sensitively, hazard H1), then a positional cast to the friendly
    names, so nothing resolves the two fields by name."""
    opts = {"mode": "FAILFAST"} if strict else {}
    return F.from_json(F.col(value), S.BINANCE_WIRE, opts).cast(S.BINANCE_NAMED)


def parse_binance(frames: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """F12 + A7: one JSON array per frame -> one row per element in ``el``;
    ``pos`` is the element position inside its frame. A frame that is not
    JSON yields one row with a null ``el`` (so it can be rejected); ``[]``
    yields no rows."""
    frames = as_text(frames, value)
    rest = [c for c in frames.columns if c != value]
    parsed = frames.select(*rest, F.col(value).alias("raw"), binance_elements(value, strict).alias("els"))
    return _explode_frames(parsed, rest, "el")


def binance_valid_frame(frames: DataFrame, value: str = "value") -> DataFrame:
    """K1 for Binance: a frame is already a batch; keep its valid elements and
    re-encode them with the wire names, one message per frame (no grouping,
    no state). Frames with no valid element are dropped."""
    frames = as_text(frames, value)
    rest = [c for c in frames.columns if c != value]
    els = binance_elements(value)
    ok = F.filter(els, lambda x: _all_present(x, S.BINANCE_REQUIRED))
    wire = F.transform(ok, lambda x: F.struct(*[x[dst].alias(src) for src, dst in S.BINANCE_RENAMES]))
    return (frames.select(*rest, wire.alias("_els"))
            .where(F.size("_els") > 0)
            .select(*rest, F.to_json("_els").alias("message"), F.size("_els").alias("n")))


def _all_present(x: Column, fields) -> Column:
    cond = F.lit(True)
    for f in fields:
        cond = cond & x[f].isNotNull()
    return cond


def validate_binance(rows: DataFrame, el: str = "el", strict: bool = False) -> Split:
    return _split(rows, model_reason(rows, el, S.BINANCE_REQUIRED), strict)


def parse_ticks(frames: DataFrame, value: str = "value") -> DataFrame:
    """S3: messages of a transformed topic, each a JSON array of ticks, -> one
    row per tick; ``pos`` is the place in its message. A message that is not
    JSON gives one row of nulls with ``raw``."""
    frames = as_text(frames, value)
    rest = [c for c in frames.columns if c != value]
    ticks = F.from_json(F.col(value), ArrayType(S.TICK), {"timestampFormat": S.TICK_TIME_PATTERN})
    rows = _explode_frames(frames.select(*rest, F.col(value).alias("raw"), ticks.alias("els")), rest, "tick")
    return rows.select("tick.*", *rest, "raw", "pos")
