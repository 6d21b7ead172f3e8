"""Shared folder for written intermediate tables, and scoped session settings."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session (tests) gets a private one when the setting is missing;
    a cluster session without it is an error, because executors could not see it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings (dots written as ``__``) for the eager jobs inside the block."""
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Scratch:
    """Intermediate tables of one operator run, as Parquet in the shared folder.

    A written table survives lost executors and cuts the lineage; ``drop`` removes
    one that later steps no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        #: Tasks, and so files, of tables written by ``write_few`` (None: as many as a table has partitions).
        self.tasks: int | None = None

    def write(self, df: DataFrame, name: str, codec: str = "zstd", batch_rows: int | None = None) -> DataFrame:
        path, rows = f"{self.at}/{name}", {}
        if batch_rows:
            rows = {"spark__sql__execution__arrow__maxRecordsPerBatch": str(batch_rows)}
        with settings(self.spark, **rows):
            df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(_nullable(df.schema)).parquet(path)
        self.paths[id(out)] = path
        self.__dict__.setdefault("kept", []).append(out)
        return out

    def write_few(self, df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
        """``write`` for a table of a few bytes for each document, by ``tasks`` (or the run's) tasks if the session has more partitions.

        The rows are dealt anew for that: a task that took many partitions of a join, one after the
        other, would hold the memory of all their sorts.
        """
        tasks = tasks or self.tasks
        few = tasks is not None and tasks < int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.write(df.repartition(tasks) if few else df, name)

    def write_bucketed(self, df: DataFrame, name: str, key: str, batch_rows: int) -> DataFrame:
        """Like ``write``, with one shuffle by ``key``; later groupings by it need no more of them.

        Written uncompressed (packed rows are compressed already), in as many buckets as the
        session has shuffle partitions.  The catalog's entry is dropped at once: the files
        stay, and the returned DataFrame knows their buckets.
        """
        n, table = int(self.spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
        with settings(self.spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(batch_rows)):
            df.repartition(n, key).write.option("compression", "uncompressed").option("path", f"{self.at}/{name}").bucketBy(n, key).saveAsTable(table)
        out = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(t)))
            path.getFileSystem(conf).delete(path, True)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def free_name(taken, base: str) -> str:
    """``base``, or ``base_2``... if the table already has a column of that name (in any case)."""
    low, name, i = {c.lower() for c in taken}, base, 2
    while name.lower() in low:
        name, i = f"{base}_{i}", i + 1
    return name


def pow2_at_least(x: float, least: int = 1) -> int:
    n = least
    while n < x:
        n *= 2
    return n


def words_count(text) -> "F.Column":
    """Number of ``[^\\x20\\x09-\\x0D]+`` words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
