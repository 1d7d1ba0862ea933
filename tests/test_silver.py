"""Cleaning rules per source table."""

import hashlib
from datetime import datetime

import pytest

from lendscape.plans import silver
from lendscape.specs import (
    APPLICATION,
    BUREAU,
    BUREAU_BALANCE,
    CREDIT_CARD,
    INSTALLMENTS,
    POS_CASH,
    PREVIOUS_APPLICATION,
)

T0, T1 = datetime(2026, 5, 12, 0), datetime(2026, 5, 12, 1)


def sha(value):
    return hashlib.sha256(str(value).encode()).hexdigest()


@pytest.fixture
def application(spark):
    rows = [
        (100001, 0, -12000, -3000, "Business Entity Type 3", T0, "x"),
        (100002, 1, -15000, 365243, "XNA", T0, "y"),
    ]
    return spark.createDataFrame(
        rows,
        "SK_ID_CURR long, TARGET long, DAYS_BIRTH long, DAYS_EMPLOYED long, "
        "ORGANIZATION_TYPE string, ingestion_ts timestamp, EXTRA string",
    )


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_xna_becomes_null(application):
    out = by_key(silver.clean(APPLICATION, application), "SK_ID_CURR")
    assert out[100002].ORGANIZATION_TYPE is None
    assert out[100001].ORGANIZATION_TYPE == "Business Entity Type 3"


def test_employment_sentinel_has_no_digest(application):
    out = by_key(silver.clean(APPLICATION, application), "SK_ID_CURR")
    assert out[100002].DAYS_EMPLOYED_MASKED is None
    assert out[100001].DAYS_EMPLOYED_MASKED == sha(-3000)


def test_birth_is_always_masked(application):
    out = by_key(silver.clean(APPLICATION, application), "SK_ID_CURR")
    assert out[100001].DAYS_BIRTH_MASKED == sha(-12000)
    assert all(len(r.DAYS_BIRTH_MASKED) == 64 for r in out.values())


def test_raw_personal_columns_are_gone(application):
    columns = silver.clean(APPLICATION, application).columns
    assert not {"DAYS_BIRTH", "DAYS_EMPLOYED", "EXTRA"} & set(columns)


def test_application_keeps_latest(spark, application):
    newer = application.replace(0, 1, subset=["TARGET"]).selectExpr(
        "* except (ingestion_ts)", "timestamp'2026-05-13 00:00:00' as ingestion_ts"
    )
    out = silver.clean(APPLICATION, application.unionByName(newer)).collect()
    assert len(out) == 2 and {r.ingestion_ts.day for r in out} == {13}


def test_bureau_keeps_latest(spark):
    df = spark.createDataFrame(
        [(1, 200001, "Active", T1), (1, 200001, "Closed", T0), (2, 200002, "Sold", T0)],
        "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, ingestion_ts timestamp",
    )
    out = by_key(silver.clean(BUREAU, df), "SK_ID_BUREAU")
    assert len(out) == 2 and out[200001].CREDIT_ACTIVE == "Active"


def test_balance_takes_most_recent_month(spark):
    df = spark.createDataFrame(
        [(200001, 0, "C", T0), (200001, -1, "0", T0), (200001, -2, "X", T0), (200002, 0, "1", T0)],
        "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string, ingestion_ts timestamp",
    )
    cleaned = silver.clean(BUREAU_BALANCE, df)
    assert cleaned.columns == ["SK_ID_BUREAU", "STATUS", "ingestion_ts"]
    assert {k: r.STATUS for k, r in by_key(cleaned, "SK_ID_BUREAU").items()} == {
        200001: "C",
        200002: "1",
    }


@pytest.mark.parametrize("spec", [PREVIOUS_APPLICATION, POS_CASH, CREDIT_CARD])
def test_unknown_columns_are_dropped_and_rows_kept(spark, spec):
    df = spark.createDataFrame([(1, "drop"), (1, "drop")], "SK_ID_PREV long, EXTRA string")
    out = silver.clean(spec, df)
    assert out.columns == ["SK_ID_PREV"] and out.count() == 2


def test_previous_application_keeps_xna(spark):
    df = spark.createDataFrame([(1, "XNA")], "SK_ID_PREV long, NAME_PRODUCT_TYPE string")
    assert silver.clean(PREVIOUS_APPLICATION, df).first().NAME_PRODUCT_TYPE == "XNA"


def test_installments_keep_latest_per_number(spark):
    df = spark.createDataFrame(
        [(300001, 1.0, 10.0, T1), (300001, 1.0, 20.0, T0), (300002, 2.0, 30.0, T0)],
        "SK_ID_PREV long, NUM_INSTALMENT_NUMBER double, AMT_PAYMENT double, ingestion_ts timestamp",
    )
    out = by_key(silver.clean(INSTALLMENTS, df), "SK_ID_PREV")
    assert len(out) == 2 and out[300001].AMT_PAYMENT == 10.0


def test_masking_is_native(spark, application):
    plan = silver.clean(APPLICATION, application)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "sha2" in plan
