"""The load ledger: which files were loaded, when, and with what content.

A ledger is a table with a row per loaded file: path, size, digest, target,
rows and load time.  A load takes the files whose path or content is not in
it, replaces the slices of those files, and then enters them; so a second load
of a file changes nothing, a changed file replaces its earlier rows, and a
load that stops half-way is done again in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .files import list_files
from .sinks import replace_partition
from .split_files import pieces

SCHEMA = "source_path string, bytes bigint, digest string, target string, rows bigint, load_time timestamp"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none before the first load."""
    p, fs = _path(spark, ledger)
    return spark.read.schema(SCHEMA).parquet(ledger) if fs.exists(p) else spark.createDataFrame([], SCHEMA)


def _bare(path: Column) -> Column:
    """A path without its scheme, which is written with one slash or three."""
    return F.regexp_replace(path, "^[A-Za-z0-9]+:/*", "/")


def _decoded(uri: Column) -> Column:
    """The path that a row's metadata give as a URI."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_id(path: Column) -> Column:
    """The slice of a file: a digest of its path."""
    return F.substring(F.sha2(_bare(path), 256), 1, 16)


def with_digest(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``files`` (path, bytes) with a digest of their content.

    A file is hashed line by line with each line's place in its byte range, by
    as many tasks as it has ranges; the hashes are summed.  An empty file has
    the digest 0.
    """
    paths = [r.path for r in files.select("path").distinct().collect()]          # the files of one load
    if not paths:
        return files.withColumn("digest", F.lit(None).cast("string"))
    lines = pieces(spark, paths, "\n")
    first = lines.groupBy("file", "block").agg(F.min("id").alias("_first"))
    place = lines.join(first, ["file", "block"]).withColumn("_place", F.col("id") - F.col("_first"))
    hashed = place.groupBy("file").agg(F.sum(F.xxhash64("block", "_place", F.col("value").cast("binary")).cast("decimal(38,0)")).cast("string").alias("_digest"))
    return (files.join(hashed, _bare(F.col("path")) == _bare(_decoded(F.col("file"))), "left")
            .withColumn("digest", F.coalesce("_digest", F.lit("0"))).drop("file", "_digest"))


def arrived(spark: SparkSession, folder: str, ledger: str, pattern: str = "*") -> DataFrame:
    """(path, file_name, bytes, digest) of the files under ``folder`` that are
    not in the ledger with the same path, size and content.

    A file whose path and size are known is still read for its digest: its
    content may have changed.  Files of size 0 don't count.
    """
    files = materialize(with_digest(spark, list_files(spark, folder, pattern).where(F.col("bytes") > 0)))
    known = read_ledger(spark, ledger).select(F.col("source_path").alias("path"), "bytes", "digest").distinct()
    return files.join(known, ["path", "bytes", "digest"], "left_anti")


def load(spark: SparkSession, folder: str, table: str, ledger: str, read: Callable[[list[str]], DataFrame], target: str,
         load_time: str | None = None, pattern: str = "*") -> DataFrame:
    """Load the files that are new under ``folder``; their ledger rows.

    ``read`` takes paths and returns rows with their file's path in ``_path``.
    The table gets ``_load_time`` (the load's, the present by default),
    ``source_path`` and ``source_id``, and is partitioned by the last.
    """
    new = materialize(arrived(spark, folder, ledger, pattern))
    paths = [r.path for r in new.select("path").collect()]                      # the files of one load
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    when = F.lit(load_time).cast("timestamp") if load_time else F.lit(spark.range(1).select(F.current_timestamp()).head()[0])
    rows = read(paths).withColumn("source_path", _decoded(F.col("_path"))).drop("_path")
    rows = rows.withColumns({"_load_time": when, "source_id": file_id(F.col("source_path"))})
    replace_partition(rows, table, "source_id")
    counted = spark.read.parquet(table).where(F.col("source_id").isin([r[0] for r in new.select(file_id(F.col("path"))).collect()]))
    counted = counted.groupBy(F.col("source_id").cast("string").alias("_id")).agg(F.count(F.lit(1)).alias("rows"))
    entry = new.join(counted, file_id(F.col("path")) == F.col("_id"), "left").select(
        F.col("path").alias("source_path"), "bytes", "digest", F.lit(target).alias("target"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), when.alias("load_time"))
    entry = materialize(entry)
    entry.coalesce(1).write.mode("append").parquet(ledger)      # one file, one commit: a row per loaded file
    return entry


def loaded(spark: SparkSession, table: str, ledger: str) -> DataFrame:
    """The table's rows of files whose load was finished."""
    rows, done = spark.read.parquet(table), read_ledger(spark, ledger)
    return rows.join(done.select(file_id(F.col("source_path")).alias("source_id")).distinct(), "source_id", "left_semi")


def current(ledger_rows: DataFrame) -> DataFrame:
    """The latest entry of each file."""
    best = F.max_by(F.struct("bytes", "digest", "target", "rows", "load_time"), F.struct("load_time", "digest")).alias("b")
    return ledger_rows.groupBy("source_path").agg(best).select("source_path", "b.*")
