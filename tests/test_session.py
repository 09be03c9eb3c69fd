"""Shared checkpoint folder: the session's setting wins; materialise cuts lineage."""

from ledgerlake.session import ensure_checkpoint_dir, materialize, scratch_path, stored


def test_checkpoint_dir_from_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.conf.get("spark.checkpoint.dir") == d
    assert scratch_path(spark, "x/y").startswith(d.rstrip("/") + "/tables/")


def test_materialize_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id").groupBy("k").count()
    m = materialize(df)
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan            # reads the checkpoint, not the original lineage


def test_running_session_keeps_its_settings(spark):
    from ledgerlake.session import get_spark
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert get_spark("local[1]", shuffle_partitions=5).conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stored_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None, True), (None, "a (b)/c", None), (1, None, True)], "`n (x)` bigint, s string, b boolean")
    got = stored(df)
    assert got.schema == df.schema and sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
