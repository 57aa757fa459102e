"""Session construction and shared scratch space.

Scratch data (stream checkpoints, landing folders, written layers) always
lives under the cluster's shared checkpoint folder (``spark.checkpoint.dir``)
so that it survives the loss of any executor. Only when the session names
no such folder (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; each is a Spark default in 4.x except where
# noted, but we pin them so that a cluster-wide override cannot silently turn
# them off for these jobs.
SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, turn sort-merge
    # joins into broadcast joins when the measured side is small, split
    # skewed partitions of hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Keep nested / wide projections inside whole-stage codegen.
    "spark.sql.codegen.wholeStage": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(
    app: str = "racelake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Return (or create) a SparkSession with the settings this library expects.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset so that the submitter's values win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    running = SparkSession.getActiveSession()
    return running if running is not None else builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Read from ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir);
    only when neither is set — local tests — create one and register it.
    """
    sc = spark.sparkContext
    path = None
    try:
        path = sc.getCheckpointDir()
    except Exception:
        path = None
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="racelake-ckpt-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return _join(base, f"racelake-{name}-{uuid.uuid4().hex[:12]}")


def _join(base: str, leaf: str) -> str:
    if "://" in base:
        return base.rstrip("/") + "/" + leaf
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, leaf)
