import random
from datetime import datetime, timedelta

import pytest

from lendscape.operators.lookup import lookup_as_of

START = datetime(2026, 1, 1)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def plain(facts, versions):
    out = []
    for i, k, t in facts:
        valid = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] <= t and (v[2] is None or t < v[2])]
        out.append((i, k, t, valid[-1][3] if valid else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("stretch", ["HOUR", "DAY", "YEAR"])
def test_equals_an_interval_join(spark, stretch):
    rng = random.Random(4)
    versions = []
    for k in range(12):
        cuts = sorted(rng.sample(range(400), 6))
        for n, (a, b) in enumerate(zip(cuts, [*cuts[1:], None])):
            if rng.random() < 0.8:  # else a gap
                versions.append((k, at(a), at(b), f"{k}.{n}"))
        versions.append((k, at(cuts[3]), at(cuts[3]), "no time at all"))
    # Half of the facts are of one applicant.
    facts = [(i, rng.choice([3, rng.randrange(14)]), at(rng.randrange(-20, 450))) for i in range(600)]
    facts += [(900, None, at(5)), (901, None, at(5)), (902, 3, None)]
    f = spark.createDataFrame(facts, "id long, k long, t timestamp_ntz").repartition(4)
    v = spark.createDataFrame(versions, "k long, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    got = lookup_as_of(f, v, "k", "t", {"name": "state"}, stretch)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(facts, versions)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_empty_sides(spark):
    f = spark.createDataFrame([(1, 1, at(0))], "id long, k long, t timestamp_ntz")
    v = spark.createDataFrame([], "k long, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    assert [tuple(r) for r in lookup_as_of(f, v, "k", "t", ["name"]).collect()] == [(1, 1, at(0), None)]
    assert lookup_as_of(f.limit(0), v, "k", "t", ["name"]).count() == 0
