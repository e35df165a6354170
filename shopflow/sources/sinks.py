"""Result sinks.

* ``overwrite_table``  - drop and recreate a managed table (S5).
* ``append_jdbc``      - append a result to a JDBC table (S6); the driver jar and database are the
                         caller's (none is started here).
* ``SnapshotStore``    - keyed results written by streaming micro-batches (S7 upsert, S8 replace).
* ``preview``          - opt-in ``show`` (S9); costs a job, so nothing calls it implicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_table(df: DataFrame, name: str, database: str | None = None) -> None:
    """Replace a managed table with ``df`` (the reference dropped and re-created it)."""
    full = f"{database}.{name}" if database else name
    df.write.mode("overwrite").saveAsTable(full)


def append_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
                password: str | None = None, options: dict | None = None) -> None:
    """Append rows to a JDBC table; one connection per task, batched inserts."""
    w = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()


def preview(df: DataFrame, n: int = 100, truncate: bool = False) -> None:
    df.show(n, truncate)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Ids of the committed ``batch_id=N`` folders under ``path`` (a listing, no Spark job). A folder is
    committed once Spark's job commit has put ``_SUCCESS`` into it; what an unfinished or running
    write leaves is not seen."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    ids = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("batch_id=") and \
                fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            ids.append(int(name.split("=", 1)[1]))
    return sorted(ids)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class SnapshotStore:
    """Keyed result table fed by ``foreachBatch``.

    Each micro-batch writes only its changed rows to ``{path}/batch_id={id}`` with
    ``mode("overwrite")`` on that folder, so a batch that Spark runs again after a failure
    replaces its own output instead of adding to it (idempotent by batch id). Readers see the
    newest row per key (``upsert``, S7) or only the newest batch (``replace``, S8). Reads made
    while processing batch ``b`` pass ``before=b`` and so never see a half-written attempt of b.
    ``compact`` folds the history into one full snapshot; later reads start from it. Only committed
    folders are read, and a committed full snapshot is never written again.

    ``partition_by`` (e.g. the day) lays each batch folder out by that key, so a reader that
    passes ``where`` on it (the days a micro-batch touches) scans only those partitions.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: str | None = None,
                 partition_by: list[str] | None = None, rows_per_file: int = 1_000_000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.schema = schema
        self.partition_by = list(partition_by or [])
        self.rows_per_file = int(rows_per_file)

    # -- writing
    def _write(self, df: DataFrame, folder: str) -> None:
        w = df.write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(folder)

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Write a batch's changed rows (pass a persisted frame to a partitioned store: it is counted
        first). Rows are laid out by partition value and key hash, one file for every
        ``rows_per_file`` rows, so a batch of one day is written by many tasks."""
        if self.partition_by:
            pieces = -(-max(df.count(), 1) // self.rows_per_file)
            df = df.repartition(*self.partition_by, F.pmod(F.xxhash64(*self.keys), F.lit(pieces)))
        self._write(df, f"{self.path}/batch_id={int(batch_id)}")

    # -- reading
    @property
    def full_path(self) -> str:
        return f"{self.path}_full"

    def _reader(self):
        # With a declared schema, partition columns (batch_id, day) keep their declared types
        # instead of being inferred from folder names (a day would become a DATE).
        r = self.spark.read
        return r.schema(f"{self.schema}, batch_id long") if self.schema else r

    def _folders(self, path: str, ids: list[int]) -> DataFrame | None:
        if not ids:
            return None
        return self._reader().option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in ids])

    def _deltas(self, after: int = -1, before: int | None = None) -> DataFrame | None:
        """Committed batches with ``after`` < id < ``before``."""
        return self._folders(self.path, [b for b in batch_ids(self.spark, self.path)
                                         if b > after and (before is None or b < before)])

    def _history(self, before: int | None, where=None, full_before: int | None = None,
                 only: DataFrame | None = None) -> DataFrame | None:
        """Newest full snapshot older than ``before`` (and ``full_before``) plus the deltas after it."""
        fulls = [b for b in batch_ids(self.spark, self.full_path)
                 if (before is None or b < before) and (full_before is None or b < full_before)]
        m = fulls[-1] if fulls else -1
        parts = [p if where is None else p.filter(where)
                 for p in (self._folders(self.full_path, fulls[-1:]), self._deltas(m, before)) if p is not None]
        if only is not None:
            parts = [p.join(only, only.columns, "left_semi") for p in parts]
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0] if parts else None

    def _empty(self) -> DataFrame:
        if self.schema is None:
            raise ValueError(f"no data under {self.path} and no schema given")
        return self.spark.createDataFrame([], self.schema)

    def read(self, before: int | None = None, where=None, full_before: int | None = None,
             only: DataFrame | None = None) -> DataFrame:
        """Newest row per key (upsert semantics); ``where`` filters before the merge (use it on
        ``partition_by`` columns for partition pruning), ``only`` keeps the key values it lists."""
        df = self._history(before, where, full_before, only)
        if df is None:
            return self._empty()
        values = [c for c in df.columns if c not in self.keys and c != "batch_id"]
        if not values:
            return df.select(*self.keys).distinct()
        newest = df.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
        return newest.select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in values])

    def read_all(self) -> DataFrame:
        """Every row of every batch (append semantics), without the batch id."""
        df = self._deltas()
        return self._empty() if df is None else df.drop("batch_id")

    def read_latest(self, before: int | None = None) -> DataFrame:
        """Rows of the newest batch (below ``before``) only (replace semantics)."""
        ids = [b for b in batch_ids(self.spark, self.path) if before is None or b < before]
        if not ids:
            return self._empty()
        return self._folders(self.path, ids[-1:]).drop("batch_id")

    def compact(self, batch_id: int, keep=None) -> None:
        """Fold everything up to and including ``batch_id`` into one full snapshot; later reads
        start from it. Call from the batch function after the batch's own write, e.g. every
        N batches, so reads stay proportional to the live keys instead of the history.
        ``keep`` (a Column predicate) drops rows no reader needs any more.

        The base is a full snapshot strictly older than ``batch_id``; if this one is committed already
        (the batch runs again) nothing is written. Folders that the previous full snapshot already
        covers are removed, so readers of the last compaction are not disturbed and the listing
        stays as long as two compaction intervals."""
        batch_id = int(batch_id)
        fulls = batch_ids(self.spark, self.full_path)
        if batch_id not in fulls:
            current = self.read(before=batch_id + 1, full_before=batch_id)
            if keep is not None:
                current = current.filter(keep)
            self._write(current, f"{self.full_path}/batch_id={batch_id}")
        older = [b for b in fulls if b < batch_id]
        if older:
            for b in older[:-1]:
                remove(self.spark, f"{self.full_path}/batch_id={b}")
            for b in batch_ids(self.spark, self.path):
                if b <= older[-1]:
                    remove(self.spark, f"{self.path}/batch_id={b}")
