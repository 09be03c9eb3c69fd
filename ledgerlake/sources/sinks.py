"""Table writes of the loaders: partition replace, keyed upsert, reload, update."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def replace_partition(df: DataFrame, path: str, partition_cols: str | list[str] = "dt",
                      slices: list | None = None) -> None:
    """Idempotent daily load: the partitions present in ``df`` are replaced
    (dynamic overwrite); other days are untouched.

    ``slices`` names the values of the first partition column that this load
    stands for: those without a row in ``df`` are emptied, as a reload that
    deletes its slice first would leave them.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(path))
    if slices:
        # the loaded days that have rows: no more than the list given
        present = {r[0] for r in df.select(cols[0]).where(F.col(cols[0]).isin(slices)).distinct().collect()}
        spark = df.sparkSession
        for value in slices:
            if value not in present:
                slice_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{cols[0]}={value}")
                slice_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(slice_path, True)


def last_wins(src: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col`` (later wins)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order_col))
    return src.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_last_wins(target: DataFrame, src: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """INSERT … ON CONFLICT (keys) DO UPDATE: target rows without a source
    row are kept, source rows (latest per key) replace or add.

    The source is first reduced to its latest row per key with an aggregate
    (map-side partial, so a key repeated in a third of the source costs one
    row per partition); then one pass over target ∪ latest, one shuffle by
    key, no join: a target row is kept when its key has no source row."""
    cols = target.columns
    payload = [c for c in cols if c not in keys]
    best = src.groupBy(*keys).agg(F.max(F.struct(F.col(order_col).alias("_order"),
                                                 *[F.col(c) for c in payload])).alias("_b"))
    latest = best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in payload]).select(*cols)
    k = Window.partitionBy(*keys)
    u = (target.select(*cols, F.lit(0).alias("_side"))
         .unionByName(latest.select(*cols, F.lit(1).alias("_side")))
         .withColumn("_has_src", F.max("_side").over(k)))
    return u.where((F.col("_side") == 1) | (F.col("_has_src") == 0)).select(*cols)


def truncate_reload(df: DataFrame, path: str) -> None:
    """Replace a whole dimension."""
    df.write.mode("overwrite").parquet(path)


def update_from(dim: DataFrame, src: DataFrame, key: str, col: str,
                order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """UPDATE dim SET col = src.col WHERE key matches, only for positive
    values (rounded to cents).  Of several updates of a key the last by
    ``order_col`` counts (the greatest value without one).  Returns (updated
    dim, source keys not found)."""
    last = F.max_by("_new", order_col) if order_col else F.max("_new")
    s = (src.where(F.col(col) > 0).withColumn("_new", F.round(F.col(col), 2))
         .groupBy(key).agg(last.alias("_new")))
    updated = (dim.join(s, key, "left")
               .withColumn(col, F.coalesce(F.col("_new").cast(dim.schema[col].dataType), F.col(col)))
               .drop("_new"))
    missing = s.join(dim.select(key), key, "left_anti").select(key)
    return updated, missing


def materialize_table(df: DataFrame, path: str | None = None, view: str | None = None) -> DataFrame:
    """Mart as a table (parquet at ``path``) and/or a model as a temp view."""
    if path:
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df
