"""Join operators of the settlement jobs, expressed as equi-joins.

* ``resolve_alias`` — the reference's OR-join (id = id OR name = name OR
  bracket-normalised name = name) becomes one equi-join on (probe kind,
  value), de-duplicated per (fact key, alias row); a plain OR condition would
  plan as a nested-loop join.
* ``prefix_join`` — "equal or prefix" (``= OR LIKE label || '%'``) becomes an
  equi-join on the generated prefixes of the longer name.
* ``match_split`` — one left join + flag instead of an inner join and a
  second outer-join-is-null pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import paren_normalize


def resolve_alias(keys: DataFrame, alias: DataFrame, platforms: list[str],
                  id_col: str = "platform_shop_id",
                  name_col: str = "platform_shop_name") -> DataFrame:
    """Left-join fact keys ``(id_col, name_col)`` to matching alias rows.

    Returns every ``keys`` row with ``store_short_name`` of each matching alias
    row (fan-out, like the OR join), or one row with null when none matches.
    The OR condition (id = id OR name = name OR bracket-normalised name =
    name) becomes one equi-join on a probe: each key row probes with its id
    and its normalised name (the exact-name arm is implied by the normalised
    one); an alias row matched by both probes counts once.  ``keys`` is
    scanned once, so a pre-aggregated fact (one row per shop key) is the
    intended input.
    """
    a = (alias.where(F.col("platform").isin(*platforms))
         .select(F.col("platform_store_id").cast("string").alias("_a_id"),
                 F.col("store_name").alias("_a_name"), F.col("platform").alias("_a_platform"),
                 F.col("store_short_name")))
    a_probe = a.select("*", F.explode(F.array(
        F.struct(F.lit("id").alias("kind"), F.col("_a_id").alias("val")),
        F.struct(F.lit("nm").alias("kind"), paren_normalize("_a_name").alias("val")))).alias("_p"))
    a_probe = a_probe.select(F.col("_p.kind").alias("_kind"), F.col("_p.val").alias("_val"),
                             F.struct("_a_id", "_a_name", "_a_platform", "store_short_name").alias("_hit"))
    cols = keys.columns
    k = keys.withColumn("_key", F.struct(*cols)).select("_key", F.explode(F.array(
        F.struct(F.lit("id").alias("kind"), F.col(id_col).alias("val")),
        F.struct(F.lit("nm").alias("kind"), paren_normalize(name_col).alias("val")))).alias("_p"))
    k = k.select("_key", F.col("_p.kind").alias("_kind"), F.col("_p.val").alias("_val"))
    j = k.join(a_probe, ["_kind", "_val"], "left")
    # one row per key with the set of distinct alias rows hit (bounded by the
    # alias dimension), then fanned out again; no hit → one null row
    g = j.groupBy("_key").agg(F.collect_set("_hit").alias("_hits"))
    out = g.select("_key", F.explode_outer("_hits").alias("_h"))
    return out.select(*[F.col(f"_key.{c}").alias(c) for c in cols],
                      F.col("_h.store_short_name").alias("store_short_name"))


def prefix_join(left: DataFrame, right: DataFrame, label_col: str, name_col: str,
                how: str = "left") -> DataFrame:
    """``left ⟕ right ON right.name = left.label OR right.name LIKE left.label || '%'``.

    Every prefix of ``right.name`` is generated (bounded by the name length)
    and equi-joined to ``left.label``; ``%``/``_`` in the label are literal.
    """
    r = right.withColumn(
        "_prefix",
        F.explode(F.expr(f"transform(sequence(1, greatest(length({name_col}), 1)), "
                         f"i -> substring({name_col}, 1, i))")))
    return left.join(r, left[label_col] == r["_prefix"], how).drop("_prefix")


def match_split(anchor: DataFrame, finance: DataFrame, key: str = "order_no") -> DataFrame:
    """Anchor rows with finance columns and a ``matched`` flag (single pass).

    ``finance`` must be unique on ``key``.  Anchors with a null key are never
    matched (plain ``=``) and land in pending, as in the reference.
    """
    f = finance.withColumn("_hit", F.lit(True))
    return (anchor.join(f, on=key, how="left")
            .withColumn("matched", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def with_scalar(df: DataFrame, name: str, scalar_df: DataFrame) -> DataFrame:
    """Attach the single value of a one-row, one-column aggregate to every row
    as an uncorrelated scalar subquery (evaluated once, no join)."""
    return df.withColumn(name, scalar_df.scalar())
