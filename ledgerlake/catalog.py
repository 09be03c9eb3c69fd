"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per SURVEY §2 key.

Each query builds the raw export views it reads (``sources.testdata``) and
runs the library's job on them, over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sources.testdata import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Views(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco




def money_all(df: DataFrame) -> DataFrame:
    """Output convention: decimals as DECIMAL(18,2), integers as BIGINT."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DecimalType, IntegerType, LongType, ShortType

    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("decimal(18,2)").alias(f.name))
        elif isinstance(f.dataType, (IntegerType, LongType, ShortType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# Register all query modules (import for side effects).
from .queries import mart, settlement, vocabulary, recon, relational, quality, ingest  # noqa: E402,F401
