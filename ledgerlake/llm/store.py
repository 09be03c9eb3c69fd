"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerlake
from ledgerlake.session import scratch_path

_SHIPPED: set[str] = set()
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, name: str, ids: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it
    back: later steps don't recompute it, and it outlives its executors.  The
    shuffle files of the write go as soon as it is done.  A table of ``ids``
    alone is written by an eighth of the tasks, in fewer files."""
    spark = df.sparkSession
    if ids:
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(rows: DataFrame, text: str = "text", part_bytes: int = 64 << 20) -> int:
    """Partitions for work that grows with the text: as the cluster is set,
    but one for each ``part_bytes`` of text at least."""
    total = rows.agg(F.sum(F.octet_length(text))).head()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // part_bytes))


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(ledgerlake.__file__).parent
        target = os.path.join(tempfile.mkdtemp(), "ledgerlake.zip")
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(target)
        _SHIPPED.add(app)
