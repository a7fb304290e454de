"""Session construction and shared scratch storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on: AQE (runtime coalescing and skew-join splitting)
# and session time zone. Partition counts are left to the caller's cluster size.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # index tables and loop state are reliable checkpoints; delete their files once
    # nothing references them (a context-level setting, applied when the context starts)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "townpull",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment (a path every executor can reach).
    Only a local-mode session without it gets a private folder, as in tests.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        conf_dir = tempfile.mkdtemp(prefix="townpull-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint root for written intermediates."""
    root = checkpoint_root(spark)
    return os.path.join(root, "scratch", f"{label}-{uuid.uuid4().hex[:12]}")
