import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lendscape.operators import partials
from lendscape.sources import store

SCHEMA = "day date, kind string, sk_id_curr long, target_flag long, amt_credit double"


def facts(n, seed):
    rng = random.Random(seed)
    start = date(2026, 1, 28)
    return [
        (start + timedelta(days=rng.randrange(10)), rng.choice(["a", "b", None]), rng.randrange(4000),
         rng.choice([0, 0, 1, None]), rng.choice([None, 0.1, rng.lognormvariate(10, 1)]))
        for _ in range(n)
    ]


def test_rolled_up_days_equal_the_whole(spark):
    rows = facts(6000, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    parts = partials.daily_partials(df, "day", ["kind"])
    months = partials.indicators(partials.rolled_up(parts, ["kind"], "month")).collect()
    assert len(months) == 6
    for r in months:
        own = [x for x in rows if x[1] == r.kind and x[0].month == r.period.month]
        assert (r.applications, r.defaults) == (len(own), sum(x[3] == 1 for x in own))
        assert r.applicants == pytest.approx(len({x[2] for x in own}), rel=0.03)


def test_error_of_merged_quantiles(spark):
    df = spark.createDataFrame(facts(8000, 2), SCHEMA).repartition(7)
    whole = partials.rolled_up(partials.daily_partials(df, "day", []), []).select(
        "amounts", *[partials.quantile("distribution", p).alias(f"q{int(p * 100)}") for p in (0.05, 0.5, 0.95)]
    ).first()
    values = sorted(r[0] for r in df.select("amt_credit").collect() if r[0] is not None)
    assert whole.amounts == len(values)
    for p in (0.05, 0.5, 0.95):
        q = whole[f"q{int(p * 100)}"]
        low, high = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
        assert low - 0.015 <= p <= high + 0.015


def test_a_day_stored_again_replaces_its_partials(spark, tmp_path):
    root = str(tmp_path / "p")
    one = spark.createDataFrame([(date(2026, 1, 1), "a", 1, 1, 5.0)], SCHEMA)
    two = spark.createDataFrame([(date(2026, 1, 2), "a", k, 0, None) for k in (1, 2)], SCHEMA)
    for df in (one, two, two, one.withColumn("target_flag", F.lit(0).cast("long"))):
        parts = partials.daily_partials(df, "day", ["kind"])
        label = df.first().day.isoformat()
        store.write_run(parts.drop(partials.DAY), root, partials.DAY, label)
    stored = store.read_runs(spark, root, partials.DAY, store.run_labels(spark, root, partials.DAY))
    row = partials.indicators(partials.rolled_up(stored, ["kind"])).first()
    assert (row.applications, row.defaults, row.applicants, row.avg_credit_amount) == (3, 0, 2, 5.0)


def test_no_amounts_and_no_rows(spark):
    none = spark.createDataFrame([(date(2026, 1, 1), "a", None, None, None)], SCHEMA)
    rolled = partials.rolled_up(partials.daily_partials(none, "day", ["kind"]), ["kind"])
    row = rolled.select("applications", partials.quantile("distribution", 0.5).alias("q")).first()
    assert (row.applications, row.q) == (1, None)
    assert partials.rolled_up(partials.daily_partials(none.limit(0), "day", ["kind"]), ["kind"]).count() == 0
