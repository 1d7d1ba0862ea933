from pyspark.sql import functions as F

from lendscape.operators.latest import latest_per_key


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_single_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, ts int, v string")
    out = latest_per_key(df, ["k"], "ts")
    assert {(r.k, r.v) for r in out.collect()} == {(1, "b"), (2, "c")}
    assert out.columns == df.columns


def test_latest_composite_key_with_null_part(spark):
    rows = [(1, 1, 1, "a"), (1, 1, 2, "b"), (1, None, 1, "c"), (1, None, 3, "d")]
    df = spark.createDataFrame(rows, "k int, n int, ts int, v string")
    out = latest_per_key(df, ["k", "n"], "ts")
    assert {(r.n, r.v) for r in out.collect()} == {(1, "b"), (None, "d")}


def test_ties_do_not_depend_on_distribution(spark):
    df = spark.range(400).select(
        (F.col("id") % 10).alias("k"), F.lit(1).alias("ts"), F.col("id").alias("v")
    )
    results = [
        sorted(latest_per_key(df.repartition(n), ["k"], "ts").collect()) for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 10


def test_null_order_value_loses(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 0, "b")], "k int, ts int, v string")
    assert latest_per_key(df, ["k"], "ts").first().v == "b"


def test_rows_are_limited_per_task_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("ts"))
    text = plan(latest_per_key(df, ["k"], "ts"))
    assert "Partial" in text[text.index("Exchange") :]


def test_hot_key_shuffles_one_row_per_task(spark):
    """A key with a third of the rows sends at most one row from each task."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"),
    )
    out = latest_per_key(df, ["k"], "ts")
    out.collect()
    executed = out._jdf.queryExecution().executedPlan()
    text = executed.toString()
    assert "WindowGroupLimit" in text
    hot = out.filter("k = -1").collect()
    assert len(hot) == 1 and hot[0].ts == 29_997
    assert out.count() == 20_001
