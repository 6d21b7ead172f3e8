"""Clustered Parquet tables: bucketed by a key and sorted, on a path of any file system.

A bucket holds all rows of its keys, so a filter on the key reads one bucket's files, the sort lets
Parquet skip row groups, and two tables bucketed alike by their join key are joined without an exchange.

The files are the table.  The catalog entry that Spark needs to know the buckets is made from the path,
the schema and the layout whenever a session first uses the table, so nothing depends on a
lasting metastore; ``forget`` removes the entry and leaves the files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of a bucket that a task can sort and join in memory.
BUCKET_BYTES = 256 << 20


def buckets_for(n_bytes: float, least: int = 8) -> int:
    """Buckets for a table that will grow to ``n_bytes``: a power of two, so that layouts of different sizes nest."""
    n = least
    while n * BUCKET_BYTES < n_bytes:
        n *= 2
    return n


class ClusteredTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, sort: Sequence[str] = (),
                 buckets: int = 8, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.sort, self.buckets, self.partition_by = key, list(sort) or [key], buckets, list(partition_by)
        layout = f"{self.path}|{schema.simpleString()}|{key}|{self.sort}|{buckets}|{self.partition_by}"
        self.name = f"clustered_{hashlib.sha256(layout.encode()).hexdigest()[:20]}"

    def _register(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in self.partition_by)}) " if self.partition_by else ""
        quoted = self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet {parts}"
                       f"CLUSTERED BY (`{self.key}`) SORTED BY ({', '.join(f'`{c}`' for c in self.sort)}) INTO {self.buckets} BUCKETS LOCATION '{quoted}'")

    def create(self) -> None:
        """An empty table, if there is none."""
        self._register()
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(at)

    def append(self, df: DataFrame, mode: str = "append") -> None:
        """One shuffle by the key, so that a task writes one bucket (one file for each partition of the table)."""
        self.create()
        rows = df.select(*[df[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in self.schema.fields])
        w = rows.repartition(self.buckets, self.key).write.format("parquet").mode(mode).option("path", self.path).bucketBy(self.buckets, self.key).sortBy(*self.sort)
        (w.partitionBy(*self.partition_by) if self.partition_by else w).saveAsTable(self.name)

    def read(self) -> DataFrame:
        """The rows as they are now, also those that other sessions have appended."""
        self._register()
        if self.partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Remove the session's catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
