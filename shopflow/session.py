"""Session construction and the few session-level settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "shopflow", extra: dict | None = None) -> SparkSession:
    """Local / test session. On a cluster, pass the cluster's own session to the library instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("SHOPFLOW_DRIVER_MEMORY", "8g"),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every query depends on for its results (not for its speed).

    All day / minute / hour labels are rendered in UTC (the reference used the JVM zone,
    which made results depend on the machine). The setting stays on the caller's session, because
    frames are evaluated after this returns.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def state_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and written snapshots.

    Taken from the session (``spark.checkpoint.dir`` / ``SparkContext.setCheckpointDir``),
    which on a cluster names shared storage. Only when nothing is configured (local tests)
    a fresh temporary folder is created and registered.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and the executors")
        root = tempfile.mkdtemp(prefix="shopflow-state-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared state root (one per run)."""
    return f"{state_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
