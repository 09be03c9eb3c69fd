"""Late finance lines re-match pending orders when their day is recomputed.

The reference's only late-data notion is a batch one: finance lines that
arrive within the lookback window are picked up when a business day is
computed again.  Expressed with Structured Streaming: new export files are
consumed with an ``availableNow`` trigger (exactly-once via the checkpoint).
The raw table is partitioned by day and source path: a micro-batch replaces
only the slices of its own files, so a late file adds to its day, files of one
name in several folders keep apart, and a repeated batch changes nothing.
Then the caller recomputes the days that the batch touched: a late finance
line changes the day of its order, which may be long past.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C
from ..plans.settlement import LOOKBACK_DAYS
from ..sources.sinks import replace_partition


def order_days(lines: DataFrame, orders: DataFrame, key: str = "order_no", day: str = "dt",
               lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """The days of the orders that finance ``lines`` can change, one row per
    day: those of an order with a line's number, unless the line is dated
    more than ``lookback`` days before the order (it isn't looked at then).

    Lines are cut to an order's latest day first, so an order with very many
    lines is one row; numbers are compared without blanks and tabs."""
    touched = (lines.groupBy(C.clean_text(key).alias("_key")).agg(F.max(day).alias("_latest"))
               .where(F.col("_key").isNotNull()))
    placed = orders.select(C.clean_text(key).alias("_placed"), F.col(day).alias("_day"))
    hit = (F.col("_placed") == F.col("_key")) & (F.col("_day") <= F.date_add("_latest", lookback))
    return placed.join(touched, hit, "left_semi").select(F.col("_day").alias(day)).distinct()


def ingest_available(spark: SparkSession, source_dir: str, schema: T.StructType, table_path: str,
                     checkpoint: str, on_days: Callable[[list], None] | None = None,
                     fmt: str = "csv", options: dict | None = None,
                     orders: Callable[[], DataFrame] | None = None, key: str = "order_no") -> None:
    """Load all files that arrived since the last run, then stop.

    ``schema`` is the declared all-text schema of the export (no inference);
    ``dt`` comes from the row; the table gets the columns ``source_path`` and
    ``source_id`` (a digest of the path, its slice).  ``on_days`` receives the
    days to rebuild, in order: those of the batch's rows or, where ``orders``
    gives the order table, the days of the orders that the batch's lines
    belong to (``order_days``).  Days are dates, so the list is short.
    """
    stream = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true").options(**(options or {})).load(source_dir)
    path = F.col("_metadata.file_path")
    stream = stream.withColumns({"source_path": path, "source_id": F.substring(F.sha2(path, 256), 1, 16)})

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        replace_partition(batch, table_path, ["dt", "source_id"])
        if on_days is not None:
            touched = batch.select("dt").distinct() if orders is None else order_days(batch, orders(), key)
            on_days(sorted(r[0] for r in touched.collect()))

    (stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
     .foreachBatch(write_batch).start().awaitTermination())
