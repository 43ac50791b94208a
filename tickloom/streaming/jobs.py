"""Streaming jobs.

The transforms are the bounded ones applied to a streaming DataFrame; the
only streaming-specific pieces are sources, sinks, triggers and checkpoints.
Every query gets its own ``checkpointLocation`` (T1: offsets and state live
there, so a restarted query resumes where it stopped).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType

from tickloom import schemas as SCH
from tickloom.operators import decode as D
from tickloom.operators import normalize as N
from tickloom.operators.envelope import binance_record_json, kucoin_record_json
from tickloom.sinks import current as CUR
from tickloom.sinks.files import tee


def kucoin_outcomes(frames: DataFrame, keep=("seq", "pos")) -> DataFrame:
    """S7 + decode + validate + normalise for a (streaming) frame DataFrame:
    ticks and rejects in one pass, told apart by ``reason``."""
    parsed = D.drop_control_frames(D.parse_kucoin(frames))
    return N.outcomes(parsed, N.KUCOIN, D.model_reason(parsed, "msg", SCH.KUCOIN_REQUIRED), tuple(keep))


def binance_outcomes(frames: DataFrame, keep=("seq", "pos")) -> DataFrame:
    rows = D.parse_binance(frames)
    return N.outcomes(rows, N.BINANCE, D.model_reason(rows, "el", SCH.BINANCE_REQUIRED), tuple(keep))


OUTCOMES = {"kucoin": kucoin_outcomes, "binance": binance_outcomes}


def kucoin_ticks(frames: DataFrame, keep=("seq", "pos")) -> DataFrame:
    return N.split_outcomes(kucoin_outcomes(frames, keep)).valid


def binance_ticks(frames: DataFrame, keep=("seq", "pos")) -> DataFrame:
    return N.split_outcomes(binance_outcomes(frames, keep)).valid


def start_rejects(source: str, frames: DataFrame, rejects_root: str, checkpoint_root: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """The records of a feed that are no ticks, with raw text and reason,
    as JSON lines under ``rejects_root/source=``. The file sink commits each
    micro-batch once (T6)."""
    if "seq" not in frames.columns:
        frames = frames.withColumn("seq", F.lit(None).cast("long"))
    rejects = N.split_outcomes(OUTCOMES[source](frames)).rejects
    return start(rejects, f"{checkpoint_root}/{source}-rejects", fmt="json", path=f"{rejects_root}/{source}",
                 trigger=trigger)


def kucoin_records(frames: DataFrame) -> DataFrame:
    """Validated Kucoin messages as batcher input: key, time, arrival order
    (``seq`` of the frame, ``pos`` inside it: a Kafka raw message is an array
    of records), JSON."""
    parsed = D.drop_control_frames(D.parse_kucoin(frames))
    valid = D.validate_kucoin(parsed).valid
    return valid.select(F.col("msg.subject").alias("subject"), F.col("msg.data.time").alias("ms"),
                        "seq", "pos", kucoin_record_json().alias("record"), "ingest_ts")


def binance_records(frames: DataFrame) -> DataFrame:
    valid = D.validate_binance(D.parse_binance(frames)).valid
    return valid.select(F.col("el.symbol").alias("subject"), F.col("el.event_time").alias("ms"),
                        "seq", "pos", binance_record_json().alias("record"), "ingest_ts")


def start(df: DataFrame, checkpoint: str, fmt: str = "parquet", path: str | None = None,
          trigger: dict | None = None, mode: str = "append", partition_by=(),
          name: str | None = None) -> StreamingQuery:
    """Start a file/Kafka sink query (T5: trigger; ``availableNow`` in tests)."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "1 second"}))
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    return w.format(fmt).start()


def start_current_price(ticks: DataFrame, snapshot_root: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """K7: fold every micro-batch into the keyed snapshot (the fold is
    idempotent, T6)."""
    return (ticks.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .foreachBatch(lambda df, bid: CUR.upsert_batch(df, bid, snapshot_root))
            .start())


def start_tee(df: DataFrame, writers: list[Callable[[DataFrame, int], None]], checkpoint: str,
              trigger: dict | None = None) -> StreamingQuery:
    """One micro-batch, several sinks, computed once."""
    def body(batch: DataFrame, bid: int) -> None:
        tee(batch, *[(lambda d, w=w: w(d, bid)) for w in writers])
    return (df.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .foreachBatch(body).start())


def run_all(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Several independent queries, until any of *these* stops (or timeout);
    then the others are stopped, and a failure is raised."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        while all(q.isActive for q in queries) and (deadline is None or time.monotonic() < deadline):
            time.sleep(0.2)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def start_ingestion(spark: SparkSession, kucoin_frames: DataFrame, binance_frames: DataFrame,
                    landing_root: str, checkpoint_root: str, kafka: dict | None = None,
                    text_root: str | None = None, size: int = 50, timeout_ms: int = 1000,
                    batch_keys=("source", "subject"), flush_seconds: int = 60,
                    trigger: dict | None = None, landing_trigger: dict | None = None,
                    rejects_root: str | None = None, idle_ms: int | None = 1000) -> list[StreamingQuery]:
    """Entry 1 of the reference (live ingestion), as streaming queries:

    - Kucoin ticker messages -> count-or-timeout batches (A1, default 50 / 1 s
      per symbol, A10; ``batch_keys=("source",)`` batches the whole feed, in
      one task) -> one JSON-array message per closed batch to the raw topic (K1).
    - Binance frames are batches already: each frame's valid elements are
      re-encoded and produced as one message (K1).
    - Both feeds' records land in the zone with their ingest envelope,
      flushed per ``flush_seconds`` and named after the first item (K5, P15).
      Landing has a trigger of its own, by default as long as a flush, and a
      micro-batch that runs again replaces its own files (T6).
    - With ``rejects_root``, what is neither a record nor a control frame goes
      there with its reason (P12).

    ``kafka`` maps source -> producer options (``sinks.kafka.producer_options``);
    without a Kafka connector, ``text_root`` receives the same messages as text.
    ``idle_ms`` flushes an idle key's open batch (the reference's 1 s poll).
    It makes Spark plan no-data micro-batches forever, so use ``idle_ms=None``
    with an ``availableNow`` trigger.
    """
    from tickloom.operators.envelope import envelope
    from tickloom.sinks import kafka as KS
    from tickloom.streaming.batcher import stream_batches

    trig = trigger or {"processingTime": "1 second"}
    k_recs = kucoin_records(kucoin_frames).withColumn("source", F.lit("kucoin"))
    b_recs = binance_records(binance_frames).withColumn("source", F.lit("binance"))

    k_msgs = stream_batches(k_recs, list(batch_keys), "ms", ["seq", "pos"], "record", size, timeout_ms, idle_ms)
    b_msgs = D.binance_valid_frame(binance_frames)

    def sink(msgs: DataFrame, source: str) -> StreamingQuery:
        rows = KS.messages(msgs)
        ck = f"{checkpoint_root}/{source}-raw"
        if kafka and source in kafka:
            return KS.write_stream(rows, kafka[source], ck, trigger=trig)
        return KS.write_stream(rows, {}, ck, fmt="text", path=f"{text_root}/{source}", trigger=trig)

    landed = envelope(k_recs, "record", "source", "ingest_ts").unionByName(
        envelope(b_recs, "record", "source", "ingest_ts"))
    land = start_landing(landed, landing_root, f"{checkpoint_root}/landing", flush_seconds,
                         landing_trigger or (trigger if trigger and "availableNow" in trigger else None))
    queries = [sink(k_msgs, "kucoin"), sink(b_msgs, "binance"), land]
    if rejects_root:
        queries += [start_rejects(s, f, rejects_root, checkpoint_root, trig)
                    for s, f in (("kucoin", kucoin_frames), ("binance", binance_frames))]
    return queries


def start_landing(envelopes: DataFrame, landing_root: str, checkpoint: str, flush_seconds: int = 60,
                  trigger: dict | None = None) -> StreamingQuery:
    """K5: envelopes to the landing zone, one write per micro-batch; a
    micro-batch that runs again replaces what it wrote (T6)."""
    from tickloom.sinks import landing as LZ

    def land(batch: DataFrame, bid: int) -> None:
        # flushes are found in one pass and joined back in another
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            LZ.write_landing(LZ.flush_groups(batch, flush_seconds), landing_root,
                             batch=LZ.micro_batch_name(batch.sparkSession, checkpoint, bid))
        finally:
            batch.unpersist()

    return (envelopes.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{flush_seconds} seconds"}))
            .foreachBatch(land).start())


def start_routing(envelopes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Landed records to one folder per outcome (``tick``, ``other``,
    ``reject``, ``unknown``), in one query; an unknown source does not stop it."""
    from tickloom.operators.routing import route
    return start(route(envelopes), checkpoint, path=root, trigger=trigger, partition_by=("outcome",))


def tick_arrays(source: str, frames: DataFrame) -> DataFrame:
    """Raw messages -> ``ticks``, the array of each message's valid ticks."""
    frames = D.as_text(frames)
    rest = [c for c in frames.columns if c != "value"]
    if source == "binance":
        els, record, spec, required = D.binance_elements("value"), "el", N.BINANCE, SCH.BINANCE_REQUIRED
    else:
        els = F.from_json(F.col("value"), ArrayType(SCH.KUCOIN))
        record, spec, required = "msg", N.KUCOIN, SCH.KUCOIN_REQUIRED
    return (frames.select(*rest, els.alias("_els"))
            .select(*rest, N.tick_array(F.col("_els"), record, spec, required).alias("ticks")))


def start_loader(transformed: DataFrame, snapshot_root: str, checkpoint: str, rejects_root: str | None = None,
                 trigger: dict | None = None) -> list[StreamingQuery]:
    """The reference's last stage: transformed topics -> current-price table
    (S3 -> K7). ``transformed`` has ``value`` and, from Kafka, ``seq``
    (:func:`tickloom.sources.streams.kafka_arrival`): ties at the same event
    time go to the later arrival. What is no tick goes to ``rejects_root``."""
    if "seq" not in transformed.columns:
        transformed = transformed.withColumn("seq", F.lit(None).cast("long"))
    rows = D.parse_ticks(transformed.select("value", "seq"))
    split = N.split_ticks(rows)
    queries = [start_current_price(split.valid.drop("raw"), snapshot_root, checkpoint, trigger)]
    if rejects_root:
        queries.append(start(split.rejects.select("raw", "reason", "seq", "pos"), f"{checkpoint}-rejects", fmt="json",
                             path=rejects_root, trigger=trigger))
    return queries


def start_normalization(spark: SparkSession, raw: dict[str, DataFrame], checkpoint_root: str,
                        kafka: dict | None = None, text_root: str | None = None,
                        trigger: dict | None = None, rejects_root: str | None = None) -> list[StreamingQuery]:
    """Entry 2 of the reference (normalisation): each raw topic (Kucoin
    batches as JSON arrays, Binance frames) -> decode, validate, normalise ->
    one JSON array of ticks per raw message on the transformed topic (K2; S3
    reads it, :func:`start_loader`).

    ``raw`` maps source -> streaming DataFrame with a ``value`` column (Kafka
    rows, or text rows locally). Rejected records stay out of the topic and go
    to ``rejects_root`` if given.
    """
    from tickloom.sinks import kafka as KS

    trig = trigger or {"processingTime": "1 second"}
    queries = []
    for source, frames in raw.items():
        rows = KS.tick_messages(tick_arrays(source, frames))
        if rejects_root:
            queries.append(start_rejects(source, frames, rejects_root, checkpoint_root, trig))
        ck = f"{checkpoint_root}/{source}-transformed"
        if kafka and source in kafka:
            queries.append(KS.write_stream(rows, kafka[source], ck, trigger=trig))
        else:
            queries.append(KS.write_stream(rows, {}, ck, fmt="text", path=f"{text_root}/{source}", trigger=trig))
    return queries
