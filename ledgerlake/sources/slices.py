"""Tables whose slices are replaced by one commit.

A table is a folder with a subfolder per load and one per version.  A load
writes its rows aside, in a folder of its own, and then a version: which load
holds each slice (a day, a file, a bucket of keys), and the columns.  The
marker that Spark writes last makes the version valid, so a reader sees a
version as a whole: a reload replaces all its slices at once, those without
rows included, and one that is stopped before leaves the table as it was.
Versions only list slices, a few thousand rows at most.

Columns may be added, and numbers widened, from load to load: every file is
read under the newest version's columns, and none is rewritten for it.

One load of a table runs at a time.  Folders that only old versions name stay
until ``drop_unused``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import upsert_last_wins

BUCKET = "_bucket"
ENTRY = "slice string, load string, slice_column string, columns string"
_WIDER = {("int", "bigint"), ("float", "double"), ("smallint", "int"), ("smallint", "bigint")}


@dataclass(frozen=True)
class Version:
    """What a table holds: the load of each slice, and its columns."""

    number: int = 0
    slice_column: str | None = None
    columns: T.StructType = field(default_factory=T.StructType)
    loads: dict[str, str] = field(default_factory=dict)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _complete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, f"{path}/_SUCCESS")
    return bool(fs.exists(p))


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the valid versions, in order."""
    return [int(n) for n in _children(spark, f"{path}/_versions") if n.isdigit() and _complete(spark, f"{path}/_versions/{n}")]


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version of the table, the newest one unless named; an empty one for
    a table that has none."""
    valid = numbers(spark, path)
    if not valid:
        return Version()
    number = valid[-1] if number is None else number
    rows = spark.read.schema(ENTRY).parquet(f"{path}/_versions/{number:010d}").collect()     # a row per slice
    head = next(r for r in rows if r.columns is not None)
    return Version(number, head.slice_column, T.StructType.fromJson(json.loads(head.columns)), {r.slice: r.load for r in rows if r.load is not None})


def merged_columns(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both in order of appearance.  A column may come in a
    wider number type; any other change of type is an error."""
    out = {f.name: f.dataType for f in old}
    for f in new:
        was = out.setdefault(f.name, f.dataType)
        pair = (was.simpleString(), f.dataType.simpleString())
        if pair in _WIDER or (isinstance(was, T.DecimalType) and isinstance(f.dataType, T.DecimalType) and f.dataType.scale >= was.scale
                              and f.dataType.precision - f.dataType.scale >= was.precision - was.scale):
            out[f.name] = f.dataType
        elif was != f.dataType and (pair[1], pair[0]) not in _WIDER:
            raise ValueError(f"column {f.name}: {pair[1]} does not fit {pair[0]}")
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


def _slice(column: str) -> Column:
    """A slice's name; a null and an empty one are the same, as in folders."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def _name(value) -> str:
    return "" if value is None else str(value)


def replace(df: DataFrame, path: str, slice_column: str, slices: list | None = None) -> Version:
    """Replace the slices that ``df`` has rows of, and those named in
    ``slices`` (without rows they become empty); all others stay.

    The new version is valid at once for all of them."""
    spark = df.sparkSession
    before = version(spark, path)
    if before.slice_column not in (None, slice_column):
        raise ValueError(f"the table is sliced by {before.slice_column}")
    columns = merged_columns(before.columns, df.schema)
    load = uuid.uuid4().hex
    fitted = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in columns if f.name in df.columns])
    fitted.write.mode("errorifexists").partitionBy(slice_column).parquet(f"{path}/load={load}")
    present = [c.partition("=")[2] for c in _children(spark, f"{path}/load={load}") if "=" in c]
    loads = dict(before.loads)
    if present:
        written = spark.read.schema(T.StructType([columns[slice_column]])).parquet(f"{path}/load={load}")
        present = [r[0] for r in written.select(_slice(slice_column)).distinct().collect()]      # a load's slices
    for gone in slices or []:
        loads.pop(_name(gone), None)
    loads |= dict.fromkeys(present, load)
    return _commit(spark, path, Version(before.number + 1, slice_column, columns, loads))


def _commit(spark: SparkSession, path: str, new: Version) -> Version:
    rows = [(s, load, None, None) for s, load in sorted(new.loads.items())]
    rows.append((None, None, new.slice_column, new.columns.json()))
    target = f"{path}/_versions/{new.number:010d}"
    mode = "errorifexists" if _complete(spark, target) else "overwrite"         # a version that wasn't finished is none
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode(mode).parquet(target)
    return new


def read(spark: SparkSession, path: str, slices: list | None = None, number: int | None = None) -> DataFrame:
    """The table as of a version (the newest one), or some slices of it; only
    the folders of the slices asked for are read."""
    now = version(spark, path, number)
    wanted = now.loads if slices is None else {s: now.loads[s] for s in map(_name, slices) if s in now.loads}
    if not wanted:
        return spark.createDataFrame([], now.columns)
    schema = T.StructType([*now.columns.fields, T.StructField("load", T.StringType())])
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/load={x}" for x in sorted(set(wanted.values()))])
    valid = F.concat_ws("/", F.col("load"), _slice(now.slice_column)).isin([f"{load}/{s}" for s, load in wanted.items()])
    return rows.where(valid).select(*[F.col(f"`{c}`") for c in now.columns.names])


def history(spark: SparkSession, path: str) -> DataFrame:
    """(version, slices, columns): each valid version's slices and columns."""
    rows = [(n, len(v.loads), v.columns.names) for n in numbers(spark, path) for v in [version(spark, path, n)]]
    return spark.createDataFrame(rows, "version int, slices int, columns array<string>")


def drop_unused(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete loads that none of the last ``keep`` versions names, and the
    older versions; the names of the deleted loads."""
    valid = numbers(spark, path)
    used = {load for n in valid[-keep:] for load in version(spark, path, n).loads.values()}
    gone = [c for c in _children(spark, path) if c.startswith("load=") and c[5:] not in used]
    for child in [*[f"_versions/{n:010d}" for n in valid[:-keep]], *gone]:
        p, fs = _path(spark, f"{path}/{child}")
        fs.delete(p, True)
    return [c[5:] for c in gone]


# ---------------------------------------------------------------------------
# upserts by key
# ---------------------------------------------------------------------------
def bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_keyed(df: DataFrame, path: str, keys: list[str], buckets: int) -> Version:
    """Store ``df`` in buckets of its keys; choose so many that a bucket fits
    a task."""
    return replace(df.withColumn(BUCKET, bucket(keys, buckets)).repartition(buckets, BUCKET), path, BUCKET, list(range(buckets)))


def upsert(src: DataFrame, path: str, keys: list[str], order_col: str, buckets: int) -> Version:
    """Rows of ``src`` replace or add those of their key, the latest by
    ``order_col`` of several; only buckets that ``src`` has keys of are read
    and written."""
    spark = src.sparkSession
    placed = src.withColumn(BUCKET, bucket(keys, buckets))
    touched = [r[0] for r in placed.select(BUCKET).distinct().collect()]            # at most the number of buckets
    if not touched:
        return version(spark, path)
    after = upsert_last_wins(read(spark, path, touched), placed, [*keys, BUCKET], order_col)
    return replace(after.repartition(min(buckets, len(touched)), BUCKET), path, BUCKET, touched)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path).drop(BUCKET)
