"""What the planner makes of every registered query."""

import pytest

import __spark_entry__ as contract
from lendscape.registry import QUERIES
from lendscape.session import TARGET_PARTITION_BYTES, shuffle_partitions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pairwise_joins(spark, sf_small, name):
    text = plan(QUERIES[name].run(spark, sf_small))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_filter_and_columns_reach_the_scan(spark, sf_small):
    text = plan(QUERIES["filter_then_latest"].run(spark, sf_small))
    assert "EqualTo(l_linestatus,O)" in text
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "l_extendedprice" not in schema and "l_tax" not in schema


@pytest.mark.parametrize(
    "name", ["silver_application", "silver_bureau", "latest_per_composite_key", "fact_bureau_credit"]
)
def test_dedup_limits_before_shuffling(spark, sf_small, name):
    text = plan(QUERIES[name].run(spark, sf_small))
    assert "row_number(), 1, Partial" in text


def test_static_dimension_is_broadcast(spark, sf_small):
    assert "BroadcastHashJoin [credit_active" in plan(
        QUERIES["fact_bureau_credit"].run(spark, sf_small)
    )


def test_aggregates_are_partial_before_shuffling(spark, sf_small):
    for name in ("kpi_default_rate", "kpi_exposure_per_applicant", "dq_suite"):
        text = plan(QUERIES[name].run(spark, sf_small))
        assert "partial_" in text


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.columns[0] == "name_contract_type" and df.count() > 0


def test_shuffle_partitions_follow_input_size():
    assert shuffle_partitions(0, 8) == 16
    assert shuffle_partitions(10 * TARGET_PARTITION_BYTES, 2) == 10
    assert shuffle_partitions(100 * 10**12, 8000) == 745_059
