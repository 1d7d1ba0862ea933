from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lendscape.plans.silver import business_rules
from lendscape.sources import landing, store
from lendscape.specs import APPLICATION, BUREAU, BUREAU_BALANCE

DAY, TS = date(2026, 5, 12), datetime(2026, 5, 12, 3)


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", str(tmp_path / "bronze")


def put(folder, name, text):
    (folder / name).write_text(text)


def run(spark, folders, spec=APPLICATION, day=DAY, **kw):
    return landing.ingest(spark, spec, str(folders[0]), folders[1], day, TS, **kw)


HEADER = "SK_ID_CURR,AMT_CREDIT,NAME_CONTRACT_TYPE\n"


def test_clean_file(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1,5.5,Cash loans\n2,6,Cash loans\n")
    assert run(spark, folders) == landing.IngestResult("application_train", 2, 0)
    rows = landing.read_day(spark, folders[1], APPLICATION, DAY).orderBy("SK_ID_CURR").collect()
    assert [(r.SK_ID_CURR, r.AMT_CREDIT) for r in rows] == [(1, 5.5), (2, 6.0)]


def test_null_key_is_quarantined(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1.0,5,a\n2.0,5,a\n3.0,5,a\n,5,a\n,5,a\n")
    result = run(spark, folders)
    assert (result.rows_written, result.quarantine_rows, result.rows_read) == (3, 2, 5)
    bad = landing.read_day(spark, folders[1], APPLICATION, DAY, landing.QUARANTINE).collect()
    assert [r.reasons for r in bad] == [["NULL_KEY:SK_ID_CURR"]] * 2


def test_writes_day_directory(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1,5,a\n")
    run(spark, folders)
    root = f"{folders[1]}/application_train/ingestion_date=2026-05-12"
    assert store.exists(spark, f"{root}/zone=clean")
    assert not store.exists(spark, f"{root}/zone=quarantine")


def test_missing_source_is_zero_rows(spark, folders):
    result = run(spark, folders, BUREAU)
    assert (result.rows_written, result.quarantine_rows) == (0, 0)
    assert landing.read_day(spark, folders[1], BUREAU, DAY) is None
    with pytest.raises(landing.NoRowsError):
        landing.require_rows(result)


def test_empty_frame_for_missing_source(spark):
    df = landing.read_source(spark, BUREAU, None)
    assert df.count() == 0 and "SK_ID_BUREAU" in df.columns and "reasons" in df.columns


def test_lineage_columns(spark, folders):
    put(
        folders[0],
        "application_train.csv",
        "SK_ID_CURR,ingestion_ts,ingestion_date\n1,old,old\n",
    )
    run(spark, folders, env="staging", batch_id="b7")
    row = landing.read_day(spark, folders[1], APPLICATION, DAY).first()
    assert (row.ingestion_ts, row.ingestion_date, row.env, row.batch_id) == (TS, DAY, "staging", "b7")
    assert row.source_file.endswith("application_train.csv")


def test_sample_file_is_preferred(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1,5,a\n2,5,a\n")
    put(folders[0], "application_train_dev_1000rows.csv", HEADER + "1,5,a\n")
    assert run(spark, folders).rows_written == 1


def test_columns_are_matched_by_name_and_extras_kept(spark, folders):
    put(folders[0], "application_train.csv", "EXTRA,AMT_CREDIT,SK_ID_CURR\nzz,5,1\n")
    run(spark, folders)
    row = landing.read_day(spark, folders[1], APPLICATION, DAY).first()
    assert (row.SK_ID_CURR, row.AMT_CREDIT, row.TARGET) == (1, 5.0, None)
    stored = spark.read.parquet(f"{folders[1]}/application_train")
    assert stored.first().EXTRA == "zz"


def test_bad_values_and_lines_keep_their_text(spark, folders):
    put(
        folders[0],
        "application_train.csv",
        HEADER + "1,abc,a\n2,5,a\n3,5,a,surplus,more\n4.5,5,a\n",
    )
    result = run(spark, folders)
    assert (result.rows_written, result.quarantine_rows) == (1, 3)
    bad = landing.read_day(spark, folders[1], APPLICATION, DAY, landing.QUARANTINE).collect()
    reasons = {tuple(r.reasons): r.raw for r in bad}
    lines = {r.raw for r in bad if r.reasons == ["MALFORMED_ROW"]}
    assert lines == {"1,abc,a", "3,5,a,surplus,more"}
    assert "4.5" in reasons[("BAD_VALUE:SK_ID_CURR",)]


def test_null_token(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1,NA,a\n")
    assert run(spark, folders).quarantine_rows == 1
    assert run(spark, folders, null_token="NA").rows_written == 1


def test_repeating_a_day_replaces_it_including_quarantine(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1,5,a\n,5,a\n")
    run(spark, folders)
    put(folders[0], "application_train.csv", HEADER + "1,5,a\n2,5,a\n")
    run(spark, folders)
    assert landing.read_day(spark, folders[1], APPLICATION, DAY).count() == 2
    assert landing.read_day(spark, folders[1], APPLICATION, DAY, landing.QUARANTINE).count() == 0


def test_days_are_separate_and_pruned(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1,5,a\n")
    run(spark, folders)
    run(spark, folders, day=date(2026, 5, 13))
    assert landing.read_day(spark, folders[1], APPLICATION, DAY).count() == 1
    assert landing.last_day(spark, folders[1], APPLICATION) == "2026-05-13"
    plan = landing.read_day(spark, folders[1], APPLICATION, DAY)._jdf.queryExecution()
    filters = plan.executedPlan().toString().split("PartitionFilters: [")[1]
    assert "zone" in filters.split("]")[0]


def test_business_rules_are_optional(spark, folders):
    put(folders[0], "application_train.csv", "SK_ID_CURR,TARGET,AMT_CREDIT\n1,,5\n2,0,0\n3,1,9\n")
    assert run(spark, folders).rows_written == 3
    result = run(spark, folders, rules=business_rules(APPLICATION))
    assert (result.rows_written, result.quarantine_rows) == (1, 2)


def test_balance_files_are_clustered_by_month(spark, folders):
    lines = "".join(f"{i},{-(i % 5)},C\n" for i in range(200))
    put(folders[0], "bureau_balance.csv", "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n" + lines)
    run(spark, folders, BUREAU_BALANCE)
    day = landing.read_day(spark, folders[1], BUREAU_BALANCE, DAY)
    months = [r.MONTHS_BALANCE for r in day.select("MONTHS_BALANCE").collect()]
    assert months == sorted(months)
    plan = day.filter(F.col("MONTHS_BALANCE") == 0)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(MONTHS_BALANCE,0)" in plan


def test_observed_counts_cover_every_row(spark, folders):
    lines = "".join(f"{i if i % 7 else ''},5,a\n" for i in range(5_000))
    put(folders[0], "application_train.csv", HEADER + lines)
    result = run(spark, folders)
    assert result.rows_read == 5_000
    assert result.quarantine_rows == len(range(0, 5_000, 7))


def test_null_token_of_the_table(spark, folders):
    put(folders[0], "application_train.csv", HEADER + "1,NA,a\n")
    result = run(spark, folders, replace(APPLICATION, null_token="NA"))
    assert (result.rows_written, result.quarantine_rows) == (1, 0)
    assert landing.read_day(spark, folders[1], APPLICATION, DAY).first().AMT_CREDIT is None


def test_quoted_line_break(spark, folders):
    put(folders[0], "application_train.csv", HEADER + '1,5,"a\nb"\n2,6,c\n')
    result = run(spark, folders, replace(APPLICATION, multi_line=True))
    assert (result.rows_written, result.quarantine_rows) == (2, 0)
