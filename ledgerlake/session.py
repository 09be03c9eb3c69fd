"""Spark session defaults and shared-storage helpers.

Cluster settings (master, memory, checkpoint folder) come from the
environment that launches the job; the builder below only fills in what is
unset so that tests and the local benchmark run with sane values.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session defaults: AQE re-plans joins from runtime sizes (the only size check
# a broadcast needs), coalesces small shuffle partitions and splits skewed
# partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # GBK / GB18030 exports: Java charsets beyond the default CSV whitelist
    "spark.sql.legacy.javaCharsets": "true",
}


def sizing_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Split and shuffle sizes for a job reading ``input_bytes`` on ``cores``:
    aim for a few splits per core, capped at the usual 128 MB split and 64 MB
    post-shuffle partition (the cluster values), floored at 1 MB."""
    mb = 1 << 20
    split = max(mb, min(128 * mb, input_bytes // max(1, 3 * cores)))
    advisory = max(mb, min(64 * mb, split // 2))
    return {"spark.sql.files.maxPartitionBytes": str(split),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min(mb, advisory))}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "ledgerlake", extra_conf: dict[str, str] | None = None) -> SparkSession:
    running = SparkSession.getActiveSession()
    if running is not None:                 # a session that is set up already keeps its settings
        ensure_checkpoint_dir(running)
        return running
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is always used
    as is.  Only when it is unset on a local master (tests) a private scratch
    folder is created and registered; on a cluster that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ledgerlake-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def materialize(df):
    """Reliable checkpoint of a (small, reused) intermediate result.

    Written to the shared folder of ``spark.checkpoint.dir``: later stages
    read it instead of recomputing — and re-planning — its lineage, and it
    survives the loss of the executors that computed it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df):
    """Like ``materialize``, for results as large as the input: written as a
    compressed columnar table, a small part of a checkpoint's bytes."""
    path = scratch_path(df.sparkSession, f"stored/{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that write within it remove their shuffle files as they end;
    else these stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)
