"""Spark session and lineage helpers.

The session turns on adaptive query execution (runtime broadcast of sides that
turn out small, skew-join splitting, partition coalescing) and keeps the UI off.
A checkpoint folder is taken from ``spark.checkpoint.dir`` when the cluster
names one; only a local session (tests) gets a private one when it is unset.
"""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A grouped-map batch never holds more than one series (bounded by days).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "retailcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only when ``spark.checkpoint.dir`` is unset (a local test session) is a
    private scratch folder made and recorded in the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="retailcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def conf(spark: SparkSession, **values: str):
    """Session settings (dots written as ``__``) for the eager jobs inside the block."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut_lineage(df: DataFrame, arrow_rows: int | None = None) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    ``arrow_rows``: rows of an Arrow batch, where Python steps of the plan get wide rows.
    """
    checkpoint_dir(df.sparkSession)
    with conf(df.sparkSession, **({"spark__sql__execution__arrow__maxRecordsPerBatch": str(arrow_rows)} if arrow_rows else {})):
        return df.checkpoint(eager=True)
