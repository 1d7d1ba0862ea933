import pytest
from pyspark.sql import functions as F

from lendscape.operators import quality as q


@pytest.fixture
def people(spark):
    rows = [
        (1, "XNA", 5.0, None, 0),
        (2, "a", 0.0, "x", 1),
        (2, None, -1.0, None, 7),
        (None, "b", None, None, None),
    ]
    return spark.createDataFrame(rows, "id long, org string, amt double, job string, flag long")


def result(df, expectation):
    return q.check(df, "people", [expectation]).first()


@pytest.mark.parametrize(
    "make,failed,total,status",
    [
        (lambda: q.row_count_at_least(1), 0, 4, "PASS"),
        (lambda: q.row_count_at_least(9), 5, 4, "FAIL"),
        (lambda: q.row_count_equals(4), 0, 4, "PASS"),
        (lambda: q.row_count_equals(6), 2, 4, "FAIL"),
        (lambda: q.not_null("id"), 1, 4, "FAIL"),
        (lambda: q.not_null("id", q.WARN), 1, 4, "WARN"),
        (lambda: q.not_in_set("org", ["XNA"]), 1, 4, "FAIL"),
        (lambda: q.accepted_values("flag", [0, 1]), 1, 4, "FAIL"),
        (lambda: q.greater_than("amt", 0), 2, 4, "FAIL"),
        (lambda: q.null_rate_below("job", 0.75), 3, 4, "WARN"),
        (lambda: q.null_rate_below("job", 0.76), 3, 4, "PASS"),
        (lambda: q.unique("id"), 2, 3, "FAIL"),
        (lambda: q.unique("id", "org"), 0, 2, "PASS"),
    ],
)
def test_expectations(people, make, failed, total, status):
    row = result(people, make())
    assert (row.failed_rows, row.total_rows, row.status) == (failed, total, status)


def test_masking_expectations(spark):
    df = spark.createDataFrame([(365243,), (5,)], "d long").withColumn(
        "m", F.sha2(F.col("d").cast("string"), 256)
    )
    assert result(df, q.not_digest_of("m", "365243")).failed_rows == 1
    assert result(df, q.masked_differs("m", "d")).failed_rows == 0
    assert result(df, q.is_digest("m")).failed_rows == 0
    assert result(df, q.is_digest("d")).failed_rows == 2
    raw = df.withColumn("m", F.col("d").cast("string"))
    assert result(raw, q.masked_differs("m", "d")).failed_rows == 2


def test_relationship_and_custom_query(spark, people):
    parent = spark.createDataFrame([(1,)], "pk long")
    row = result(people, q.relationship("id", parent, "pk"))
    assert (row.failed_rows, row.total_rows) == (2, 3)
    row = result(people, q.no_rows("no_negative", people.filter("amt < 0"), "amt"))
    assert (row.check_name, row.failed_rows, row.status) == ("no_negative", 1, "FAIL")


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, job string")
    rows = q.check(
        df, "t", [q.row_count_at_least(1), q.not_null("id"), q.null_rate_below("job", 0.4), q.unique("id")]
    ).collect()
    assert [r.status for r in rows] == ["FAIL", "PASS", "PASS", "PASS"]


def test_row_checks_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("v", F.lit(1)).write.parquet(path)
    suite = [q.row_count_at_least(1), q.not_null("id"), q.greater_than("v", 0), q.null_rate_below("v", 0.4)]
    text = q.check(spark.read.parquet(path), "t", suite)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_gate_lists_every_failure_and_lets_warnings_pass(spark, people):
    suite = [q.not_null("id"), q.greater_than("amt", 0), q.accepted_values("flag", [0, 1], q.WARN)]
    with pytest.raises(q.QualityGateError) as error:
        q.gate(q.check(people, "people", suite))
    assert "people.id" in str(error.value) and "people.amt" in str(error.value)
    assert "people.flag" not in str(error.value)
    rows = q.gate(q.check(people, "people", [q.not_null("id", q.WARN)]))
    assert rows[0].status == "WARN"


def test_missing_table_is_skipped_unless_required(spark, people):
    suites = {"people": [q.not_null("org", q.WARN)], "gone": [q.not_null("id")]}
    results = q.evaluate(spark, {"people": people}, suites)
    assert {r.table_name: r.status for r in results.collect()} == {"people": "WARN", "gone": "SKIPPED"}
    q.gate(results)
    with pytest.raises(q.QualityGateError, match="gone is missing"):
        q.gate(results, require=["gone"])
