"""Rewritten joins and first-row operators against brute force."""

from pyspark.sql import functions as F

from ledgerlake.functions.cleaning import paren_normalize
from ledgerlake.operators.joins import match_split, prefix_join, resolve_alias
from ledgerlake.operators.windows import distinct_on, latest_by


def _alias(spark):
    return spark.createDataFrame([
        ("1", "Alias-A", "P", "A"), ("92", "Brand(B)", "P", "B"), ("93", "Brand（C）", "P", "C"),
        ("1", "Second", "P", "A2"), ("5", "Other", "Q", "Z")],
        "platform_store_id string, store_name string, platform string, store_short_name string")


def test_resolve_alias_equals_or_join(spark):
    keys = spark.createDataFrame([
        ("1", "x", 1), ("9", "Brand(B)", 2), ("8", "Brand(C)", 3), ("5", "nothing", 4), (None, None, 5),
        ("92", "Brand(B)", 6)], "platform_shop_id string, platform_shop_name string, n int")
    a = _alias(spark)
    got = sorted((tuple(r) for r in resolve_alias(keys, a, ["P"]).collect()), key=repr)
    o = a.where(F.col("platform") == "P")
    cond = ((o.platform_store_id == keys.platform_shop_id) | (o.store_name == keys.platform_shop_name)
            | (paren_normalize(o.store_name) == paren_normalize(keys.platform_shop_name)))
    ref = keys.join(o, cond, "left").select(*keys.columns, "store_short_name")
    want = sorted((tuple(r) for r in ref.collect()), key=repr)
    assert got == want
    assert ("1", "x", 1, "A2") in got and ("5", "nothing", 4, None) in got


def test_prefix_join_equals_like(spark):
    left = spark.createDataFrame([("N1",), ("N2",), ("Q",), ("N1%",)], "label string")
    right = spark.createDataFrame([("N1",), ("N10",), ("N2x",), ("N3",)], "name string")
    got = sorted((tuple(r) for r in prefix_join(left, right, "label", "name").collect()), key=repr)
    want = sorted((tuple(r) for r in left.join(
        right, (right.name == left.label) | right.name.startswith(left.label), "left").collect()), key=repr)
    assert got == want


def test_match_split(spark):
    anchor = spark.createDataFrame([("a",), ("b",), (None,)], "order_no string")
    fin = spark.createDataFrame([("a", 1), (None, 2)], "order_no string, amt int")
    got = {(r.order_no, r.matched) for r in match_split(anchor, fin).collect()}
    assert got == {("a", True), ("b", False), (None, False)}


def test_distinct_on_and_latest_by(spark):
    df = spark.createDataFrame([("k", "2026-01-02", 1), ("k", None, 9), ("k", "2026-01-03", 2),
                                (None, "x", 3), (None, "y", 4)], "k string, d string, v int")
    latest = {r.k: r.v for r in latest_by(df, ["k"], ["d"], ["v"]).collect()}
    assert latest == {"k": 2, None: 4}
    first = {r.k: r.v for r in distinct_on(df, ["k"], [F.desc_nulls_last("d"), F.asc("v")]).collect()}
    assert first == {"k": 2, None: 4}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ids = st.sampled_from(["1", "2", "3", None])
_names = st.sampled_from(["A(x)", "A（x）", "B", "B(y)", "C", None])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(_ids, _names), min_size=1, max_size=6, unique=True),
       st.lists(st.tuples(_ids, _names, st.sampled_from(["P", "Q"]), st.sampled_from(["s1", "s2", "s3"])),
                min_size=0, max_size=6, unique=True))
def test_resolve_alias_property(spark, keys, alias):
    kdf = spark.createDataFrame(keys, "platform_shop_id string, platform_shop_name string")
    adf = spark.createDataFrame(alias, "platform_store_id string, store_name string, platform string, "
                                       "store_short_name string")
    got = sorted((tuple(r) for r in resolve_alias(kdf, adf, ["P"]).collect()), key=repr)
    o = adf.where(F.col("platform") == "P")
    cond = ((o.platform_store_id == kdf.platform_shop_id) | (o.store_name == kdf.platform_shop_name)
            | (paren_normalize(o.store_name) == paren_normalize(kdf.platform_shop_name)))
    want = sorted((tuple(r) for r in kdf.join(o, cond, "left").select(*kdf.columns, "store_short_name")
                   .collect()), key=repr)
    assert got == want


def test_row_number_spread_matches_window(spark):
    from pyspark.sql import Window

    from ledgerlake.operators.windows import row_number_spread
    # one hot key with most rows, a few small keys, a null key
    rows = [("hot", i % 17, i) for i in range(400)] + [("a", 1, 1), ("a", 0, 2), ("b", 5, 3), (None, 2, 4), (None, 1, 5)]
    df = spark.createDataFrame(rows, "k string, d int, v int")
    order = [F.asc("d"), F.asc("v")]
    got = sorted((tuple(r) for r in row_number_spread(df, ["k"], order, "rn", parts=8)
                  .select("k", "d", "v", "rn").collect()), key=repr)
    want = sorted((tuple(r) for r in df.withColumn("rn", F.row_number().over(
        Window.partitionBy("k").orderBy(*order))).collect()), key=repr)
    assert got == want
