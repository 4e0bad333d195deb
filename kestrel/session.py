"""Session helpers: building a session for tests/bench and locating the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "kestrel", extra: dict | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench. On a cluster the caller's
    session is used instead and nothing here is called."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory  # local mode: the only heap
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint root: the folder named in ``spark.checkpoint.dir``,
    else the one given to ``setCheckpointDir``. Only a local master (one machine,
    as in tests) gets a folder of its own when neither is set; a cluster without
    one is an error, because a machine-local folder would lose data there."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    root = sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = os.path.join(tempfile.gettempdir(), "kestrel-checkpoints")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root (never machine-local
    on a cluster, because the root comes from the session)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/kestrel/{name}-{uuid.uuid4().hex[:12]}"
