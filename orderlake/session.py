"""Session construction and shared scratch locations.

Jobs never invent machine-local folders: anything they persist (staging,
checkpoints, scratch tables) goes below the shared folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is missing *and* Spark runs in
local mode (tests, laptops) does this module create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the package relies on; everything else stays at Spark's defaults.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "orderlake", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect has no SparkContext
        return False


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set only if unset, locally)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:
            root = None
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")
        root = tempfile.mkdtemp(prefix="orderlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared root for one job or test run."""
    return f"{shared_root(spark)}/orderlake/{name}-{uuid.uuid4().hex[:12]}"
