"""Session helpers: build a session for tests/bench and find the shared staging folder.

Staged tables (write + read back) and checkpoints go below the folder the cluster names in
``spark.checkpoint.dir``. That setting is read from the session; only where it is unset
(local tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours gets. AQE re-plans joins and shuffle widths from measured
# sizes, splits skewed join partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "portmart",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark. On a cluster, pass your own session instead."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only where none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; use the session setting as is
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and sc is not None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="portmart-ckpt-")  # tests / local runs only
        if sc is None:
            try:
                spark.conf.set("spark.checkpoint.dir", configured)
            except Exception:  # a static setting on some servers: the path is still returned
                pass
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ensure_importable(spark: SparkSession) -> None:
    """Put this package's folder on the Python path of workers started from here on. That is all
    a local session needs; on a cluster ship the package with ``--py-files``."""
    try:
        env = spark.sparkContext.environment
    except Exception:  # Spark Connect: the server ships it
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder for a staged table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/portmart-stage/{name}-{uuid.uuid4().hex}"


def stable_path(spark: SparkSession, name: str, *parts: str) -> str:
    """The same path below the shared checkpoint folder for the same ``name`` and ``parts``
    (e.g. a stream's checkpoint, so a restarted job finds its progress again)."""
    import hashlib
    base = ensure_checkpoint_dir(spark).rstrip("/")
    digest = hashlib.sha1("\0".join(parts).encode()).hexdigest()[:16]
    return f"{base}/portmart-state/{name}-{digest}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a cluster run over ``input_bytes`` of input with ``total_cores`` cores.

    Shuffle partitions start high (about one per ``target_partition_bytes`` of input, at least
    three waves of tasks) so no reducer has to hold more than it can sort in memory; AQE
    coalesces them down to the advisory size at run time and splits skewed join partitions
    (one key may hold a third of the rows). Scans are split at the same target size.
    """
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = max(3 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
