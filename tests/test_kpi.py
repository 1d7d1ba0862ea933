import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendscape.operators import kpi


@pytest.fixture
def loans(spark):
    rows = [
        (1, "cash", "north", 1, 100.0, 50.0),
        (2, "cash", "south", 0, 200.0, 50.0),
        (3, "card", "north", 0, 0.0, 10.0),
        (4, None, "south", 1, 300.0, None),
    ]
    return spark.createDataFrame(
        rows,
        "sk_id_curr long, loan string, area string, target_flag long, amt_credit double, "
        "amt_income_total double",
    )


def test_default_rate_with_totals_distinguishes_null_segment_from_total(loans):
    out = {
        (r.loan, r.grouping_level): (r.applications, r.defaults, r.default_rate_pct)
        for r in kpi.default_rate(loans, ["loan"]).collect()
    }
    assert out == {
        ("cash", 0): (2, 1, 50.0),
        ("card", 0): (1, 0, 0.0),
        (None, 0): (1, 1, 100.0),
        (None, 1): (4, 2, 50.0),
    }


def test_segment_rates(loans):
    out = kpi.segment_default_rates(loans, ["loan", "area"]).collect()
    by_area = {r.area: r.default_rate_pct for r in out if r.grouping_level == 2}
    assert by_area == {"north": 50.0, "south": 50.0}
    assert len(out) == 3 + 2 + 1


def test_totals_are_built_from_aggregated_rows(loans):
    text = kpi.default_rate(loans, ["loan"])._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Expand") < text.rindex("Aggregate")


def test_ratio_skips_zero_credit(loans):
    out = {r.loan: r.income_to_credit_ratio for r in kpi.income_credit_ratio(loans, ["loan"]).collect()}
    assert out["card"] is None and out["cash"] == pytest.approx((0.5 + 0.25) / 2)


def test_amount_totals_do_not_depend_on_row_order(spark):
    rng = random.Random(1)
    rows = [(1, round(rng.uniform(0, 1e7), 2)) for _ in range(5_000)]
    df = spark.createDataFrame(rows, "sk_id_curr long, amt_credit_sum double")
    totals = {
        kpi.exposure(df.repartition(n).sortWithinPartitions(F.rand(n))).first().bureau_exposure
        for n in (1, 2, 5)
    }
    assert totals == {round(sum(round(a * 100) for _, a in rows) / 100, 2)}


def test_average_credit(loans):
    out = {r.loan: r.avg_credit_amount for r in kpi.average_credit(loans, ["loan"]).collect()}
    assert out == {"cash": 150.0, "card": 0.0, None: 300.0}


def test_overdue_rate_and_punctuality(spark):
    df = spark.createDataFrame([(0, 1.0), (5, None), (None, -4.0)], "credit_day_overdue long, days_payment_diff double")
    row = kpi.overdue_rate(df).first()
    assert (row.bureau_records, row.overdue) == (3, 1)
    assert row.overdue_rate_pct == pytest.approx(100 / 3)
    assert kpi.punctuality(df).first().avg_days_payment_diff == -1.5


def test_masked_presence(spark):
    df = spark.createDataFrame([("h", 5.0), (None, 7.0), ("h", 50.0), (None, None)], "m string, inc double")
    out = {r.income_bracket: r.masked_presence_pct for r in kpi.masked_presence(df, "m", "inc", [10.0]).collect()}
    assert out == {0: 50.0, 1: 100.0, None: 0.0}


@pytest.mark.parametrize("width", [0.5, 10.0, 10_000.0])
def test_quantiles_equal_numpy(spark, width):
    rng = random.Random(4)
    rows = [("hot", round(rng.choice([7.0, rng.uniform(-50, 50)]), 3)) for _ in range(700)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "seg string, v double")
    probabilities = [0.0, 0.1, 0.5, 0.75, 0.99, 1.0]
    out = kpi.exact_quantiles(df, "v", ["seg"], probabilities, width).collect()
    got = {(r.seg, r.quantile): r.v for r in out}
    for seg in ("hot", "one", "two"):
        values = [v for s, v in rows if s == seg]
        for p in probabilities:
            assert got[(seg, p)] == pytest.approx(np.quantile(values, p))
    assert len(got) == 18


def test_quantiles_without_segments(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert kpi.exact_quantiles(df, "v", [], [0.5], 7.0).first().v == 50.0


def test_histogram_handles_negative_values(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,), (None,)], "v double")
    out = {r.slot_from: r.rows_in_slot for r in kpi.histogram(df, "v", [], 10.0).collect()}
    assert out == {-10.0: 1, 0.0: 2, 10.0: 1}


def test_trend(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 2, 1), ("b", 2, 4)], "s string, m int, v int")
    out = {(r.s, r.m): (r.total, r.total_change) for r in kpi.trend(df, "m", {"total": F.sum("v")}, ["s"]).collect()}
    assert out == {("a", 1): (5, None), ("a", 2): (8, 3), ("b", 2): (4, None)}


def test_periods(spark):
    df = spark.createDataFrame([("2026-05-13",)], "d string").select(F.col("d").cast("date").alias("d"))
    for unit, first in (("day", "2026-05-13"), ("week", "2026-05-11"), ("month", "2026-05-01")):
        assert str(kpi.per_period(df, "d", unit).first().period) == first


def test_features_have_one_row_per_applicant(spark):
    base = spark.createDataFrame([(1,), (2,)], "id long")
    facts = spark.createDataFrame([(1, 5), (1, 6), (3, 1)], "id long, v long")
    parts = [kpi.count_per(facts, "id", "n"), facts.groupBy("id").agg(F.sum("v").alias("total"))]
    out = sorted(map(tuple, kpi.applicant_features(base, "id", parts).collect()))
    assert out == [(1, 2, 11), (2, None, None)]


def test_small_amounts_keep_their_digits(spark):
    fact = spark.createDataFrame([(1, 0.00004), (1, 0.00004), (2, None)], "k long, a double")
    got = {r.k: r.bureau_exposure for r in kpi.exposure(fact, ["k"], "a").collect()}
    assert got == {1: 0.00008, 2: None}


def test_amounts_beyond_64_bits_raise(spark):
    for amount in (1e19, -1e19, float("nan")):
        with pytest.raises(PySparkException):
            kpi.exposure(spark.createDataFrame([(1, amount)], "k long, a double"), ["k"], "a").collect()
    large = spark.createDataFrame([(1, 1e17)], "k long, a double")
    assert kpi.exposure(large, ["k"], "a").first().bureau_exposure == 1e17
    tiny = spark.createDataFrame([(1, 1e-13)], "k long, a double")
    assert kpi.exposure(tiny, ["k"], "a").first().bureau_exposure == 0


def test_quantiles_without_segments(spark):
    values = [(float(v % 997) + v / 3,) for v in range(3000)] + [(None,)]
    df = spark.createDataFrame(values, "v double")
    got = {r.quantile: r.v for r in kpi.exact_quantiles(df, "v", [], [0.0, 0.3, 1.0], 0.5).collect()}
    ranked = sorted(v for (v,) in values if v is not None)
    for q, value in got.items():
        at = q * (len(ranked) - 1)
        low, high = ranked[int(at)], ranked[min(int(at) + 1, len(ranked) - 1)]
        assert value == pytest.approx(low + (high - low) * (at - int(at)))
    assert len(got) == 3


def test_exact_sums_of_any_order_and_size(spark):
    import random
    from decimal import Decimal

    from lendscape.operators.kpi import exact_avg, exact_sum

    rng = random.Random(9)
    texts = [f"{rng.choice(['-', ''])}{rng.randrange(10**rng.randrange(1, 15))}" for _ in range(300)]
    texts = [t if len(t) > 13 else f"{t}.{rng.randrange(10 ** min(12, 15 - len(t.strip('-')))):d}" for t in texts]
    values = [(float(t),) for t in texts]
    want = sum((Decimal(repr(v)) for (v,) in values), Decimal(0))
    for n in (1, 7):
        df = spark.createDataFrame(rng.sample(values, len(values)) + [(None,)], "v double").repartition(n)
        row = df.agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).first()
        assert row.s == want and row.a == float(want) / len(values)
    cents = spark.createDataFrame([(123456789.1,)] * 1000 + [(-0.1,)] * 1000, "v double")
    assert cents.agg(exact_sum("v")).first()[0] == Decimal("123456789000")
    # More digits than fifteen: rounded the same way in every run.
    assert spark.createDataFrame([(0.1 * 0.7,)], "v double").agg(exact_sum("v")).first()[0] == Decimal("0.07")
    assert spark.createDataFrame([(None,)], "v double").agg(exact_sum("v")).first()[0] is None
