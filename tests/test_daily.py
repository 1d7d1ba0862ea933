"""The whole batch on generated sources, over two days."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lendscape.operators import quality as q
from lendscape.plans import daily
from lendscape.plans.silver import read_silver
from lendscape.sources import store
from lendscape.sources.synth import PROFILE, all_sources
from lendscape.specs import APPLICATION, POS_CASH, SOURCES

FIRST = PROFILE.applicant_base
DAY1, DAY2 = date(2026, 5, 12), date(2026, 5, 13)
TS1, TS2 = datetime(2026, 5, 12, 1), datetime(2026, 5, 13, 1)


def land_csv(tables, folder):
    for name, df in tables.items():
        df.coalesce(2).write.mode("overwrite").option("header", True).csv(
            f"{folder}/{SOURCES[name].files[-1]}"
        )


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    lake = daily.Lake(str(folder / "lake"))
    tables = all_sources(spark, 0.3)
    land_csv(tables, folder / "day1")
    first = daily.run_day(spark, str(folder / "day1"), lake, DAY1, TS1)
    counts1 = {n: df.count() for n, df in first.items()}

    app = tables["application_train"]
    moved = app.filter(F.col("SK_ID_CURR") < FIRST + 10).withColumn("NAME_FAMILY_STATUS", F.lit("Changed"))
    kept = app.filter(F.col("SK_ID_CURR") >= FIRST + 20)
    day2 = dict(tables, application_train=moved.unionByName(kept))
    land_csv(day2, folder / "day2")
    second = daily.run_day(spark, str(folder / "day2"), lake, DAY2, TS2)
    return lake, counts1, second, str(folder / "day2")


def test_first_day_counts(two_days):
    _, counts, _, _ = two_days
    assert counts["fact_loan_application"] == counts["dim_applicant"] == 300
    assert counts["fact_bureau_credit"] == PROFILE.bureau_rows * 0.3
    assert counts["dim_loan_type"] == 2
    assert counts["dim_credit_status"] == 4


def test_history_after_second_day(two_days):
    _, _, marts, _ = two_days
    dim = marts["dim_applicant"]
    assert dim.count() == 310
    assert dim.filter("is_current").count() == 300
    changed = dim.filter(F.col("applicant_id") < FIRST + 10)
    assert changed.filter("is_current").select("name_family_status").distinct().collect()[0][
        0
    ] == "Changed"
    assert changed.filter("not is_current").filter(
        (F.col("end_date") == DAY2) & (F.col("start_date") == DAY1)
    ).count() == 10


def test_absent_rows_stay_in_silver(spark, two_days):
    lake, _, _, _ = two_days
    silver = read_silver(spark, APPLICATION, lake.silver)
    assert silver.count() == 300
    assert silver.filter(F.col("ingestion_date") == DAY1).count() == 10


def test_keyless_table_keeps_one_partition_per_day(spark, two_days):
    lake, _, _, _ = two_days
    days = read_silver(spark, POS_CASH, lake.silver).groupBy("ingestion_date").count().collect()
    assert len(days) == 2 and days[0]["count"] == days[1]["count"]


def test_summary_matches_facts(two_days):
    _, _, marts, _ = two_days
    got = {(r.kpi, r.segment): r.value for r in marts["risk_summary"].collect()}
    loans = marts["fact_loan_application"]
    bad, n = loans.filter("target_flag = 1").count(), loans.count()
    assert got[("default_rate_pct", "ALL")] == pytest.approx(100.0 * bad / n)
    assert {s for k, s in got if k == "default_rate_pct"} == {
        "ALL",
        "instalment loan",
        "credit line",
    }


def test_no_raw_personal_data_in_silver(spark, two_days):
    lake, _, _, _ = two_days
    columns = read_silver(spark, APPLICATION, lake.silver).columns
    assert "DAYS_BIRTH" not in columns and "DAYS_EMPLOYED" not in columns
    assert "DAYS_BIRTH_MASKED" in columns


def test_gate_stops_on_bad_silver(spark, two_days):
    lake, _, _, _ = two_days
    silver = read_silver(spark, APPLICATION, lake.silver)
    from lendscape.plans.suites import silver_suites

    broken = {"silver_application": silver.unionByName(silver)}
    results = q.evaluate(spark, broken, silver_suites(broken))
    with pytest.raises(q.QualityGateError, match="unique"):
        q.gate(results)


def test_later_history_run_is_protected(spark, two_days):
    lake, _, marts, _ = two_days
    source = store.read_history(spark, lake.history, "applicant_id").drop("valid_from", "valid_to")
    with pytest.raises(ValueError, match="later run"):
        store.publish_history(
            spark, lake.history, source, "applicant_id", ["cnt_children"], TS1
        )


def test_history_as_of_first_run(spark, two_days):
    lake, _, _, _ = two_days
    past = store.read_history(spark, lake.history, "applicant_id", TS1)
    assert past.count() == 300 and past.filter("valid_to is not null").count() == 0


def test_repeating_a_day_changes_nothing(spark, two_days):
    lake, _, marts, source = two_days
    before = {n: sorted(map(str, df.collect())) for n, df in marts.items()}
    again = daily.run_day(spark, source, lake, DAY2, TS2)
    after = {n: sorted(map(str, df.collect())) for n, df in again.items()}
    assert after == before
