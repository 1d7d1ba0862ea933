import pytest

from lendscape.sources import store


def test_view_and_table(spark):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    assert store.materialise(df, "some_view").count() == 1
    stored = store.materialise(df, "some_table", "table")
    try:
        assert stored.collect() == df.collect()
        assert "FileScan" in stored._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP TABLE some_table")


def test_runs_are_independent_and_ordered(spark, tmp_path):
    root = str(tmp_path / "r")
    assert store.latest_run(spark, root, "build") is None
    store.write_run(spark.range(2), root, "build", "r2")
    store.write_run(spark.range(5), root, "build", "r1")
    assert store.run_labels(spark, root, "build") == ["r1", "r2"]
    assert store.latest_run(spark, root, "build", before="r2") == "r1"
    store.write_run(spark.range(1), root, "build", "r2")
    assert store.read_run(spark, root, "build", "r2").count() == 1
    assert store.read_run(spark, root, "build", "r1").count() == 5


def test_settle_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(10).groupBy("id").count()
    cut = store.settle(df)
    assert sorted(cut.collect()) == sorted(df.collect())
    assert "Aggregate" not in cut._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["a b", "x=y"])
def test_odd_labels_round_trip(spark, tmp_path, name):
    root = str(tmp_path / "odd")
    store.write_run(spark.range(1), root, "build", name)
    assert store.run_labels(spark, root, "build") == [name]
