from datetime import date

import pytest

from lendscape.__main__ import parse, run
from lendscape.plans.silver import read_silver
from lendscape.sources import landing
from lendscape.specs import APPLICATION


def test_date_defaults_to_today():
    args = parse(["refine", "--lake", "/lake"])
    assert args.date == date.today() and args.env == "dev"


@pytest.mark.parametrize(
    "argv", [["land", "--lake", "/l"], ["refine"], ["refine", "--lake", "/l", "--table", "nope"]]
)
def test_wrong_arguments(argv):
    with pytest.raises(SystemExit):
        parse(argv)


def test_one_table_through_two_stages(spark, tmp_path):
    (tmp_path / "application_train.csv").write_text(
        "SK_ID_CURR,TARGET,AMT_CREDIT,DAYS_BIRTH\n1,0,5,-10\n2,1,0,-20\n"
    )
    common = ["--lake", str(tmp_path / "lake"), "--date", "2026-05-12", "--table", "application_train"]
    landed = run(spark, parse(["land", "--landing", str(tmp_path), *common]))
    assert landed["application_train"] == landing.IngestResult("application_train", 1, 1)
    assert run(spark, parse(["refine", *common])) is True
    rows = read_silver(spark, APPLICATION, f"{tmp_path}/lake/silver").collect()
    assert [r.SK_ID_CURR for r in rows] == [1]
    gated = run(spark, parse(["bronze-gate", *common]))
    statuses = {(r.table_name, r.status) for r in gated}
    assert ("application_train", "PASS") in statuses and ("bureau", "SKIPPED") in statuses
