import pytest
from pyspark.sql import functions as F

from lendscape.operators import lookup


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("s1", 1, False), ("s2", 1, True), ("s3", 2, False)],
        "sk string, id long, is_current boolean",
    )


def test_current_lookup_keeps_unmatched_facts(spark, dim):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "who long")
    out = lookup.lookup_current(fact, dim, "who", "id", ["sk"])
    assert {(r.who, r.sk) for r in out.collect()} == {(1, "s2"), (2, None), (None, None)}


def test_optional_lookup(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    right = spark.createDataFrame([(1, 9, 8)], "k long, x long, y long")
    out = lookup.left_lookup(left, right, ["k"], ["x"])
    assert out.columns == ["k", "v", "x"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", 9), (2, "b", None)]


def test_small_lookup_forces_a_broadcast_of_bounded_sides_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(100).select((F.col("id") % 3).alias("c"))
        small = spark.range(3).select("id", F.lit("n").alias("name"))
        large = spark.range(20_000).select("id", F.lit("n").alias("name"))
        bounded = lookup.lookup_small(fact, small, "c", "id", ["name"], bounded=True)
        assert "BroadcastHashJoin" in plan(bounded)
        out = lookup.lookup_small(fact, large, "c", "id", ["name"])
        assert "Broadcast" not in plan(out)
        assert out.count() == 100 and out.filter("name is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id long, fk long")
    parent = spark.createDataFrame([(10,), (10,)], "pk long")
    assert [r.id for r in lookup.orphans(child, "fk", parent, "pk").collect()] == [2]
    counted = lookup.orphan_count(child, "fk", parent, "pk").first()
    assert (counted.orphan_rows, counted.checked_rows) == (1, 2)


def test_orphan_count_of_empty_child(spark):
    child = spark.createDataFrame([], "fk long")
    parent = spark.createDataFrame([(1,)], "pk long")
    assert tuple(lookup.orphan_count(child, "fk", parent, "pk").first()) == (0, 0)


def test_orphan_count_shuffles_distinct_keys_only(spark):
    """The child is counted per key ahead of the exchange, so a hot key is one row per task."""
    child = spark.range(1000).select(F.lit(1).cast("long").alias("fk"))
    text = plan(lookup.orphan_count(child, "fk", spark.range(5).withColumnRenamed("id", "pk"), "pk"))
    assert "partial_count" in text


def test_hot_fact_key_is_split_at_run_time(spark):
    """One applicant with a third of the facts: the join partition is split, rows stay whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "20",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("who"),
            F.col("id").alias("amount"),
        )
        dim = spark.range(60_000).select(
            F.col("id").alias("id"), F.md5(F.col("id").cast("string")).alias("sk"), F.lit(True).alias("is_current")
        )
        out = lookup.lookup_current(fact, dim, "who", "id", ["sk"])
        rows = out.collect()
        assert len(rows) == 60_000 and sum(r.who == 7 for r in rows) >= 20_000
        assert all(r.sk is not None for r in rows)
        assert "SortMergeJoin(skew=true)" in plan(out)
    finally:
        for k in settings:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_star(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "zz")], "t long, c string")
    types = spark.createDataFrame([(1, "one")], "id long, type_name string")
    codes = spark.createDataFrame([("a", "alpha")], "code string, code_name string")
    out = lookup.star(
        fact, [(types, "t", "id", ["type_name"]), (codes, "c", "code", ["code_name"])]
    )
    assert sorted(map(tuple, out.collect())) == [(1, "a", "one", "alpha"), (2, "zz", None, None)]
