"""Session settings the engine relies on, and the shared scratch location."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job assumes. UTC matters for correctness: epoch milliseconds
# become timestamps and object keys are rendered from them (hazard H5).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of collected (unreferenced) DataFrames are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # streaming state (the batcher's open batches) off the JVM heap; not set
    # by prepare(): a checkpoint keeps the provider it was created with
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", app: str = "tickloom",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    Cluster jobs should get their session from the platform and call
    :func:`prepare` instead; this helper only exists for local work.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine needs to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one gets a fresh
    temporary folder; a cluster session without one is a configuration error,
    because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    d = None
    try:
        d = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        d = None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running tickloom jobs")
        d = tempfile.mkdtemp(prefix="tickloom-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one job's tables. It
    lives until :func:`clear_scratch` or the end of the driver process, because
    a returned DataFrame may still read it."""
    path = f"{checkpoint_root(spark).rstrip('/')}/tickloom/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder of this driver process. DataFrames that read
    them can no longer be evaluated."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):        # the session may be going down
            clear_scratch(spark)
