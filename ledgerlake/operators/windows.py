"""First-row-per-key operators (``DISTINCT ON``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key by ``order`` (``DISTINCT ON``).

    A null key forms one group, as in ``DISTINCT ON``.  ``order`` must be a
    total order within a key for a deterministic result; the caller appends
    tie-break columns.  ``row_number() = 1`` is planned as a partial
    WindowGroupLimit before the shuffle, so a hot key is cut to one row per
    map partition before it is exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def latest_by(df: DataFrame, keys: list[str], sort_cols: list[str],
              payload: list[str]) -> DataFrame:
    """Row with the greatest ``sort_cols`` (descending, nulls last) per key.

    Implemented as ``max(struct(sort..., payload...))`` — an ordinary
    aggregate with map-side partial aggregation, so a skewed key costs one
    row per partition in the shuffle.  Ties on ``sort_cols`` are broken by
    the payload columns themselves (a total order).
    """
    packed = F.max(F.struct(*[F.col(c) for c in sort_cols + payload])).alias("_best")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("_best")[c].alias(c) for c in sort_cols + payload])


def row_number_spread(df: DataFrame, keys: list[str], order: list[Column],
                      name: str = "row_seq", parts: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` without sending
    a whole key group through one task.

    Rows are range partitioned on (keys, order) — a hot key spans several
    partitions, each holding a contiguous slice of its order — and the
    assignment is checkpointed so every use sees the same partitions.  Rows
    are numbered inside each (partition, key) slice; a key's slices in
    earlier partitions add their row counts as an offset (a small table: one
    row per key and partition it spans beyond the first).  ``order`` must be
    a total order for a deterministic numbering.
    """
    from ..session import materialize
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
    r = materialize(r.withColumn("_pid", F.spark_partition_id()))
    local = r.withColumn("_local", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    counts = r.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_off", F.sum("_n").over(before))
               .where(F.col("_off") > 0).select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                                                 F.col("_pid").alias("_o_pid"), "_off"))
    cond = F.col("_pid") == F.col("_o_pid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    out = local.join(offsets, cond, "left")
    return (out.withColumn(name, F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)))
            .drop("_pid", "_local", "_off", "_o_pid", *[f"_o_{k}" for k in keys]))
