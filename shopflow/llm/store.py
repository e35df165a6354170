"""Intermediate tables in the shared folder the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


# Rows and bytes of an Arrow batch between Spark and a Python worker. Whole texts travel in them, so
# the defaults (10000 rows) would let a few long documents fill a worker's memory.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
PAUSE = 0.5  # seconds in which Spark's cleaner works off what a collection found


def small_batches(spark: SparkSession, unset: bool = False) -> None:
    """Bound the session's Arrow batches, where they are larger. A setting that the session leaves at Spark's
    default (10000 rows) reads as None here and is bounded only if ``unset``."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if unset if now is None else not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def shared_root(spark: SparkSession) -> str:
    """The shared folder. A local session that names none gets a folder of its own (tests); on a
    cluster a missing setting is an error, as executors do not share local folders."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) \
        or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and the executors")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:16]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there, so a lost
    executor costs a re-read, not a re-run of what came before."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete written tables that no later plan reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = shared_root(spark).removeprefix("file:")
    for f in frames:
        for folder in {p.rsplit("/", 1)[0] for p in f.inputFiles()}:
            if root.lstrip("/") in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def collected(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more: it does so when the
    driver collects garbage, which a driver with a large heap may not do for hours. On a cluster the last
    plan is still referred to in a first collection, so its files only go with a second one."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(PAUSE)
