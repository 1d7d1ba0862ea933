from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendscape.operators import shape


def test_select_existing_keeps_list_order_and_skips_absent(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.select_existing(df, ["c", "zz", "a"]).columns == ["c", "a"]


def test_sentinels_with_flag(spark):
    df = spark.createDataFrame([("XNA", 365243), ("School", -5), (None, None)], "o string, d long")
    out = shape.null_sentinels(df, {"o": "XNA", "d": 365243, "absent": 1}, "_anomaly").collect()
    assert [(r.o, r.d) for r in out] == [(None, None), ("School", -5), (None, None)]
    assert [(r.o_anomaly, r.d_anomaly) for r in out] == [(True, True), (False, False), (False, False)]


def test_mask_columns_drops_originals(spark):
    df = spark.createDataFrame([(1, 2)], "k long, p long")
    assert shape.mask_columns(df, ["p", "absent"]).columns == ["k", "p_MASKED"]


def test_conform_rejects_values_that_do_not_fit(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(PySparkException):
        shape.conform(df, [("v", "n", "bigint")]).collect()


def test_split_is_complete_and_names_reasons(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (2, 0.0), (3, None)], "k long, amt double")
    clean, bad = shape.split_quarantine(
        df, {"NULL_KEY": F.col("k").isNull(), "NON_POSITIVE": F.col("amt") <= 0}
    )
    assert sorted(r.k for r in clean.collect()) == [1, 3]
    assert {(r.k, tuple(r.reasons)) for r in bad.collect()} == {
        (None, ("NULL_KEY", "NON_POSITIVE")),
        (2, ("NON_POSITIVE",)),
    }
    assert "reasons" not in clean.columns


def test_stamp_uses_the_given_time(spark):
    at = datetime(2026, 5, 12, 8)
    row = shape.stamp(spark.range(1), at, date(2026, 5, 12), "b", "dev").first()
    assert (row.ingestion_ts, row.ingestion_date, row.batch_id, row.env) == (
        at,
        date(2026, 5, 12),
        "b",
        "dev",
    )


def test_sample_first_is_by_key_not_by_file_order(spark):
    df = spark.range(100).repartition(5)
    assert [r.id for r in shape.sample_first(df, 3, ["id"]).collect()] == [0, 1, 2]
