"""Session helpers: a tuned local session for tests/bench and lineage cutting.

Library functions never build a session themselves; callers pass one in.
``local_session`` exists for tests, the bench and ``__spark_entry__``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app_name: str = "cohortlens") -> SparkSession:
    """Local session with AQE on and the web UI off (tests and bench only)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster configured, if any."""
    sc = _context(spark)
    configured = sc.getCheckpointDir() if sc is not None else None
    if configured:
        return configured
    return spark.conf.get(CHECKPOINT_CONF, None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Keep a configured checkpoint folder; invent one only in local mode.

    On a cluster the folder must be shared storage named by the operator
    (``spark.checkpoint.dir``), so nothing is invented there.
    """
    existing = checkpoint_dir(spark)
    sc = _context(spark)
    if existing:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(existing)
        return existing
    if sc is None or not sc.master.startswith("local"):
        return None
    path = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    sc.setCheckpointDir(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` by a reliable checkpoint in the shared folder."""
    shared_path(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables, models)."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder")
    return "/".join([base.rstrip("/"), *parts])


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this call under the shared folder, removed when the application ends."""
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path
