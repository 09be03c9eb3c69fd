"""Declared schemas of the raw tables: conform, drift report, discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = [T.StructField("dt", T.DateType()), T.StructField("_source_file", T.StringType()),
        T.StructField("_load_time", T.TimestampType())]


def text_schema(columns: list[str], typed: dict[str, T.DataType] | None = None) -> T.StructType:
    """Raw-table schema: every business column text unless declared typed,
    plus the load metadata columns."""
    typed = typed or {}
    return T.StructType([T.StructField(c, typed.get(c, T.StringType())) for c in columns] + META)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add declared columns missing from ``df`` as typed nulls, cast present
    ones, never drop undeclared columns (they are appended at the end)."""
    cols = []
    for f in schema.fields:
        cols.append((F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns
                     else F.lit(None).cast(f.dataType)).alias(f.name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols, *extra)


def observed(df: DataFrame) -> DataFrame:
    """Columns of a table in one pass over it: position, column_name, data_type
    and filled_rows (rows where the column is not null)."""
    fields = [f"named_struct('position', {i}, 'column_name', '{f.name}', 'data_type', "
              f"'{f.dataType.simpleString()}', 'filled_rows', count(`{f.name}`))"
              for i, f in enumerate(df.schema.fields)]
    return df.agg(F.expr(f"array({', '.join(fields)})").alias("c")).select(F.inline("c"))


def drift_report(df: DataFrame, declared: list[str]) -> DataFrame:
    """Declared vs existing columns: 'new' (declared only), 'extra' (existing
    only) or 'ok', with the existing column's filled rows."""
    names = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(c) for c in declared])).alias("declared_pos", "column_name"))
    j = names.join(observed(df).withColumnRenamed("position", "existing_pos").drop("data_type"),
                   "column_name", "full_outer")
    return j.withColumn("status", F.when(F.col("existing_pos").isNull(), "new")
                        .when(F.col("declared_pos").isNull(), "extra").otherwise("ok"))


def discover(df: DataFrame, exclude_prefix: str = "_", exclude: tuple = ("dt",)) -> DataFrame:
    """Observed business columns of a table (position, name, type, filled rows)."""
    name = F.col("column_name")
    return observed(df).where(~name.startswith(exclude_prefix) & ~name.isin(list(exclude)))
