"""Streaming twins of the bounded queries.

Frames derived from ``events`` are staged as files in weekly slices of event
time; each slice is one micro-batch (the feed arriving over time). The
queries use their own checkpoint folders under the session's checkpoint dir.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import envelope as E
from tickloom.plans import common as C
from tickloom.session import scratch_path
from tickloom.sinks import kafka as KS
from tickloom.sinks import landing as LZ
from tickloom.sinks.current import backfill, read_snapshot
from tickloom.sources import feeds
from tickloom.sources.files import hadoop_path, list_names
from tickloom.sources.landing import landed_reader
from tickloom.sources.streams import frames_stream
from tickloom.streaming import jobs as J
from tickloom.streaming.batcher import open_batches, stream_batches

FRAME_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])
WEEK_MS = 7 * 86400 * 1000
# Back-to-back micro-batches: each slice is processed as soon as it lands.
TRIGGER = {"processingTime": "0 seconds"}


def _stage(spark: SparkSession, root: str, frames: dict[str, DataFrame]) -> list[int]:
    """Write every feed once, in folders by week of arrival; returns the weeks
    (small metadata: one number per week of data)."""
    weeks: set[int] = set()
    for name, df in frames.items():
        (df.withColumn("_week", F.floor(F.unix_millis("ingest_ts") / WEEK_MS).cast("long"))
         .write.mode("overwrite").partitionBy("_week").parquet(f"{root}/stage/{name}"))
        weeks |= {int(n.removeprefix("_week=")) for n in list_names(spark, f"{root}/stage/{name}") if n.startswith("_week=")}
        spark.createDataFrame([], FRAME_SCHEMA).write.mode("append").parquet(f"{root}/in/{name}")
    return sorted(weeks)


def _arrive(spark: SparkSession, root: str, names, week: int) -> None:
    """One weekly slice of each feed arrives in the stream inputs. The staged
    files are renamed, not written again."""
    for name in names:
        _move_parts(spark, f"{root}/stage/{name}/_week={week}", f"{root}/in/{name}", f"week-{week}")


def _move_parts(spark: SparkSession, folder: str, to: str, prefix: str) -> None:
    src, fs = hadoop_path(spark, folder)
    if fs.exists(src):
        for status in fs.listStatus(src):
            file = status.getPath()
            if file.getName().startswith("part-"):
                fs.rename(file, hadoop_path(spark, f"{to}/{prefix}-{file.getName()}")[0])


def _in_slices(spark: SparkSession, root: str, rows: DataFrame, number, slices: int):
    """Write ``rows`` once, in folders by the number of their slice, and let one
    after the other arrive in ``root/in`` (renamed, not written again)."""
    rows.withColumn("_slice", number).write.partitionBy("_slice").parquet(f"{root}/stage")
    spark.createDataFrame([], rows.schema).write.parquet(f"{root}/in")
    for i in range(slices):
        _move_parts(spark, f"{root}/stage/_slice={i}", f"{root}/in", f"slice-{i}")
        yield i


def _feed_in_order(spark: SparkSession, root: str, frames: dict[str, DataFrame], each_slice) -> None:
    """Let the feeds arrive week by week; the queries consume each slice."""
    for week in _stage(spark, root, frames):
        _arrive(spark, root, frames, week)
        each_slice()


def stream_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds through the streaming transforms into a Parquet tick sink."""
    root = scratch_path(spark, "stream-normalize")
    ev = C.events(spark, sf_dir)
    frames = {"kucoin": feeds.kucoin_frames(ev), "binance": feeds.binance_frames(ev)}
    weeks = _stage(spark, root, frames)
    k = J.kucoin_ticks(frames_stream(spark, f"{root}/in/kucoin", FRAME_SCHEMA))
    b = J.binance_ticks(frames_stream(spark, f"{root}/in/binance", FRAME_SCHEMA))
    qs = [J.start(k, f"{root}/ckpt/kucoin", path=f"{root}/out/kucoin", trigger=TRIGGER),
          J.start(b, f"{root}/ckpt/binance", path=f"{root}/out/binance", trigger=TRIGGER)]
    try:
        for week in weeks:
            _arrive(spark, root, frames, week)
            for q in qs:
                q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    out = spark.read.parquet(f"{root}/out/kucoin").unionByName(spark.read.parquet(f"{root}/out/binance"))
    return C.tick_out(out)


def stream_current_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified tick stream folded into the current-price snapshot by foreachBatch."""
    root = scratch_path(spark, "stream-current")
    ev = C.events(spark, sf_dir)
    frames = {"kucoin": feeds.kucoin_frames(ev), "binance": feeds.binance_frames(ev)}
    weeks = _stage(spark, root, frames)
    ticks = (J.kucoin_ticks(frames_stream(spark, f"{root}/in/kucoin", FRAME_SCHEMA))
             .unionByName(J.binance_ticks(frames_stream(spark, f"{root}/in/binance", FRAME_SCHEMA))))
    q = J.start_current_price(ticks, f"{root}/snapshot", f"{root}/ckpt", trigger=TRIGGER)
    try:
        for week in weeks:
            _arrive(spark, root, frames, week)
            q.processAllAvailable()
    finally:
        q.stop()
    return _snapshot(spark, root)


def _snapshot(spark: SparkSession, root: str) -> DataFrame:
    snap = read_snapshot(spark, f"{root}/snapshot")
    return snap.select("source", "symbol", "price", C.ntz("time").alias("time"))


def stream_current_price_backfill(spark: SparkSession, sf_dir: str, start, end) -> DataFrame:
    """The stream sees only what lies outside ``[start, end]``; the tick lake has
    all. Backfills run before the stream's first commit, between two of its
    triggers and after a restart with an empty checkpoint."""
    root = scratch_path(spark, "stream-backfill")
    ticks = C.unified_ticks(spark, sf_dir)
    LZ.write_ticks(ticks, f"{root}/lake")
    seen = ticks.where(~F.col("time").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    half = F.pmod(F.xxhash64("symbol", "time"), F.lit(2))
    for i in (0, 1):
        seen.where(half == i).write.parquet(f"{root}/seen/{i}")
    middle = "2024-01-12 00:00:00"
    backfill(spark, f"{root}/lake", f"{root}/snapshot", start, middle)
    for i in (0, 1):        # the second half arrives under a new checkpoint: batch ids start again
        stream = spark.readStream.schema(seen.schema).parquet(f"{root}/seen/{i}")
        q = J.start_current_price(stream, f"{root}/snapshot", f"{root}/ckpt-{i}", trigger={"availableNow": True})
        try:
            q.awaitTermination()
        finally:
            q.stop()
        backfill(spark, f"{root}/lake", f"{root}/snapshot", middle, end)
    return _snapshot(spark, root)


def stream_load_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages of both feeds -> transformed messages in text files (in
    place of the topics) -> loader -> snapshot. The order of arrival stands in
    the file's ``seq``, as a Kafka offset would."""
    root = scratch_path(spark, "stream-load")
    ev = C.events(spark, sf_dir)
    for source, frames in {"kucoin": feeds.kucoin_frames(ev), "binance": feeds.binance_frames(ev)}.items():
        arrays = J.tick_arrays(source, frames).where(F.size("ticks") > 0)
        arrays.select(KS.tick_value().alias("value"), "seq").write.json(f"{root}/{source}")
    read = lambda s: spark.readStream.schema("value string, seq long").json(f"{root}/{s}")
    qs = J.start_loader(read("kucoin").unionByName(read("binance")), f"{root}/snapshot", f"{root}/ckpt",
                        rejects_root=f"{root}/rejects", trigger={"availableNow": True})
    try:
        for q in qs:
            q.awaitTermination()
    finally:
        for q in qs:
            q.stop()
    return _snapshot(spark, root)


def stream_landing(spark: SparkSession, sf_dir: str, flush_seconds: int) -> DataFrame:
    """Both feeds' envelopes through the landing job, in two slices of arrival;
    the last micro-batch is then written again, as after a crash before the
    commit."""
    root = scratch_path(spark, "stream-landing")
    k = E.envelope(C.kucoin_records(spark, sf_dir), E.kucoin_record_json(), "kucoin", "ingest_ts")
    b = E.envelope(C.binance_records(spark, sf_dir), E.binance_record_json(), "binance", "ingest_ts")
    env = k.unionByName(b)
    late = F.col("ingest_ts") >= F.lit("2024-01-29").cast("timestamp")
    for part in (~late, late):
        env.where(part).write.mode("append").parquet(f"{root}/env")
        stream = spark.readStream.schema(env.schema).parquet(f"{root}/env")
        q = J.start_landing(stream, f"{root}/landing", f"{root}/ckpt", flush_seconds, trigger={"availableNow": True})
        try:
            q.awaitTermination()
        finally:
            q.stop()
    again = LZ.flush_groups(spark.read.schema(env.schema).parquet(f"{root}/env").where(late), flush_seconds)
    LZ.write_landing(again, f"{root}/landing", batch=LZ.micro_batch_name(spark, f"{root}/ckpt", 1))
    landed = landed_reader(spark.read, f"{root}/landing")
    return landed.select("source", "object_key", C.ntz("ingest_ts").alias("ingest_ts"))


def stream_micro_batch(spark: SparkSession, sf_dir: str, size: int, timeout_ms: int) -> DataFrame:
    """Stateful A1 over the Kucoin stream; closed batches come from the sink,
    the batches still open at the end of the input from the operator's state
    (read back with the state data source)."""
    root = scratch_path(spark, "stream-batcher")
    frames = {"kucoin": feeds.kucoin_frames(C.events(spark, sf_dir))}
    spark.createDataFrame([], FRAME_SCHEMA).write.mode("append").parquet(f"{root}/in/kucoin")
    recs = J.kucoin_records(frames_stream(spark, f"{root}/in/kucoin", FRAME_SCHEMA))
    batches = stream_batches(recs, ["subject"], "ms", ["seq", "pos"], "record", size, timeout_ms,
                             idle_ms=None)

    def one_slice():
        # The batcher folds in arrival order, so a slice must arrive whole:
        # the query runs (availableNow) only after the slice is written, and
        # resumes from its checkpoint every time.
        q = J.start(batches, f"{root}/ckpt", path=f"{root}/out", trigger={"availableNow": True})
        try:
            q.awaitTermination()
        finally:
            q.stop()

    _feed_in_order(spark, root, frames, one_slice)
    closed = (spark.read.schema(batches.schema).parquet(f"{root}/out")
              .select("subject", "batch_id", "n", "first_ms", "last_ms"))
    open_ = open_batches(spark, f"{root}/ckpt", ["subject"])
    return closed.unionByName(open_)


def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records in two slices of arrival through the routing job; then the
    dead letters of one unknown source are routed again under a new rule."""
    from tickloom.operators import routing as RT
    from tickloom.plans.queries import _mixed_envelopes
    root = scratch_path(spark, "stream-routes")
    env = _mixed_envelopes(spark, sf_dir)
    late = F.col("ingest_ts") >= F.lit("2024-01-20").cast("timestamp")
    for _ in _in_slices(spark, root, env, late.cast("int"), 2):
        stream = spark.readStream.schema(env.schema).parquet(f"{root}/in")
        q = J.start_routing(stream, f"{root}/routes", f"{root}/ckpt", trigger={"availableNow": True})
        try:
            q.awaitTermination()
        finally:
            q.stop()
    routed = spark.read.schema(RT.route(env).schema).parquet(f"{root}/routes")
    letters = routed.where(F.col("outcome") == RT.UNKNOWN)
    again = RT.route(letters.where(F.col("feed") == "kucoin"), {**RT.ROUTES, "kraken": RT.ROUTES["kucoin"]})
    cols = ["feed", F.col("seq").alias("event_id"), "outcome", "source", "symbol", "price", "reason"]
    return routed.select(F.lit(1).alias("pass"), *cols).unionByName(again.select(F.lit(2).alias("pass"), *cols))


def stream_micro_batch_hot(spark: SparkSession, sf_dir: str, size: int, timeout_ms: int) -> DataFrame:
    """Both feeds, one key each, in three slices of time; the last trigger is then
    folded again, as after a crash before the commit."""
    from tickloom.streaming import hot_batcher as HB
    root = scratch_path(spark, "stream-hot")
    cols = ["source", "ms", "seq", "pos"]
    recs = C.kucoin_records(spark, sf_dir).select(*cols).unionByName(C.binance_records(spark, sf_dir).select(*cols))
    cuts = [F.unix_millis(F.lit(t).cast("timestamp")) for t in ("2024-01-09 12:00:00", "2024-01-21 07:30:00")]
    ms, keys, order = F.col("ms"), ["source"], ["seq", "pos"]
    number = (ms >= cuts[0]).cast("int") + (ms >= cuts[1]).cast("int")
    for last in _in_slices(spark, root, recs, number, 3):
        stream = spark.readStream.schema(recs.schema).parquet(f"{root}/in")
        q = HB.start_hot_batches(stream, f"{root}/out", f"{root}/ckpt", keys, "ms", order, size, timeout_ms,
                                 trigger={"availableNow": True})
        try:
            q.awaitTermination()
        finally:
            q.stop()
    again = spark.read.schema(recs.schema).parquet(f"{root}/in").where(number == last)
    HB.fold_trigger(again, last, f"{root}/out", keys, "ms", order, size, timeout_ms)
    return HB.closed_batches(spark, f"{root}/out").unionByName(HB.open_batches(spark, f"{root}/out", keys, "ms"))


def stream_idle_flush(spark: SparkSession, sf_dir: str, size: int, timeout_ms: int, idle_ms: int) -> DataFrame:
    """The Kucoin stream by week of arrival through the batcher whose clock is the
    time of arrival; the batches still open at its end have no ``closed_by``."""
    from tickloom.streaming import idle_batcher as IB
    root = scratch_path(spark, "stream-idle")
    frames = {"kucoin": feeds.kucoin_frames(C.events(spark, sf_dir))}
    spark.createDataFrame([], FRAME_SCHEMA).write.mode("append").parquet(f"{root}/in/kucoin")
    recs = J.kucoin_records(frames_stream(spark, f"{root}/in/kucoin", FRAME_SCHEMA))
    batches = IB.idle_batches(recs, ["subject"], "ingest_ts", ["seq", "pos"], "record", size, timeout_ms, idle_ms)

    def one_slice():
        q = J.start(batches, f"{root}/ckpt", path=f"{root}/out", trigger={"availableNow": True})
        try:
            q.awaitTermination()
        finally:
            q.stop()

    _feed_in_order(spark, root, frames, one_slice)
    cols = ["subject", "batch_id", "n", "first_ms", "last_ms"]
    closed = spark.read.schema(batches.schema).parquet(f"{root}/out").select(*cols, "closed_by")
    still = IB.open_batches(spark, f"{root}/ckpt", ["subject"])
    return closed.unionByName(still.select(*cols, F.lit(None).cast("string").alias("closed_by")))


def stream_price_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds by week of arrival into the keyed state; the table as read from it."""
    from tickloom.streaming import price_state as PS
    root = scratch_path(spark, "stream-price-state")
    ev = C.events(spark, sf_dir)
    frames = {"kucoin": feeds.kucoin_frames(ev), "binance": feeds.binance_frames(ev)}
    weeks = _stage(spark, root, frames)
    ticks = (J.kucoin_ticks(frames_stream(spark, f"{root}/in/kucoin", FRAME_SCHEMA))
             .unionByName(J.binance_ticks(frames_stream(spark, f"{root}/in/binance", FRAME_SCHEMA))))
    q = PS.start_price_state(ticks, f"{root}/ckpt", f"{root}/changes", trigger=TRIGGER)
    try:
        for week in weeks:
            _arrive(spark, root, frames, week)
            q.processAllAvailable()
    finally:
        q.stop()
    return PS.read_prices(spark, f"{root}/ckpt").select("source", "symbol", "price", C.ntz("time").alias("time"))


def stream_produce_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kucoin frames as messages in two slices of arrival. The second slice's first
    try breaks off after about half of its messages; the query is started again from
    its checkpoint. What readers get is decoded to ticks."""
    from tickloom.sinks import ledger as L
    root = scratch_path(spark, "stream-produce")
    frames = feeds.kucoin_frames(C.events(spark, sf_dir))

    def send(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{root}/topic")

    def send_half(rows: DataFrame) -> None:
        send(rows.where(F.pmod(F.xxhash64("value"), F.lit(2)) == 0))
        raise _BrokenOff("producer lost")

    late = F.col("ingest_ts") >= F.lit("2024-01-16").cast("timestamp")
    for part, tries in ((~late, [send]), (late, [send_half, send])):
        frames.where(part).select("value").write.mode("append").parquet(f"{root}/in")
        for attempt in tries:
            stream = spark.readStream.schema("value string").parquet(f"{root}/in")
            q = L.start_producer(stream, "kucoin-raw", attempt, f"{root}/ledger", f"{root}/ckpt", trigger={"availableNow": True})
            try:
                q.awaitTermination()
            except StreamingQueryException as e:
                if _BrokenOff.__name__ not in str(e):
                    raise
            finally:
                q.stop()
    topic = spark.read.schema(L.MESSAGE_SCHEMA).parquet(f"{root}/topic")
    once = L.read_once(topic, L.read_ledger(spark, f"{root}/ledger"))
    arrived = once.select("value", F.lit(None).cast("timestamp").alias("ingest_ts"), F.lit(None).cast("long").alias("seq"))
    return C.tick_out(J.kucoin_ticks(arrived))


class _BrokenOff(RuntimeError):
    """The failure that ``stream_produce_once`` makes."""
