import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendscape.operators.history import (
    not_exactly_one_current,
    open_versions,
    scd2_apply,
    scd2_from_log,
    scd2_present,
    stretch_of,
)
from lendscape.sources import store

T = [datetime(2026, 1, d) for d in range(1, 10)]
SCHEMA = "id long, job string, kids long, secret string"


def snap(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def versions(df):
    return sorted(
        [(r.id, r.job, r.kids, r.secret, r.valid_from, r.valid_to) for r in df.collect()],
        key=lambda v: (v[0], v[4], str(v)),
    )


def fold(spark, snapshots, **kw):
    history = None
    for at, rows in zip(T, snapshots):
        source = snap(spark, rows)
        history = (
            open_versions(source, at)
            if history is None
            else scd2_apply(history, source, "id", ["job", "kids"], at, **kw)
        )
    return history


def test_new_changed_unchanged(spark):
    out = fold(spark, [[(1, "a", 0, "x"), (2, "a", 0, "x")], [(1, "a", 0, "x"), (2, "b", 0, "x"), (3, "c", 1, "x")]])
    assert versions(out) == [
        (1, "a", 0, "x", T[0], None),
        (2, "a", 0, "x", T[0], T[1]),
        (2, "b", 0, "x", T[1], None),
        (3, "c", 1, "x", T[1], None),
    ]


def test_null_against_value_is_a_change_both_ways(spark):
    out = fold(spark, [[(1, None, 0, "x")], [(1, "a", 0, "x")], [(1, None, 0, "x")], [(1, None, 0, "x")]])
    assert [(v[1], v[4], v[5]) for v in versions(out)] == [
        (None, T[0], T[1]),
        ("a", T[1], T[2]),
        (None, T[2], None),
    ]


def test_masked_only_change_is_not_a_version_and_not_refreshed(spark):
    out = fold(spark, [[(1, "a", 0, "x")], [(1, "a", 0, "y")]])
    assert versions(out) == [(1, "a", 0, "x", T[0], None)]


def test_absent_key_stays_open(spark):
    out = fold(spark, [[(1, "a", 0, "x"), (2, "a", 0, "x")], [(2, "a", 0, "x")]])
    assert versions(out)[0] == (1, "a", 0, "x", T[0], None)


def test_reappearing_unchanged_is_the_same_version(spark):
    out = fold(spark, [[(1, "a", 0, "x")], [(2, "a", 0, "x")], [(1, "a", 0, "x")]])
    assert [v for v in versions(out) if v[0] == 1] == [(1, "a", 0, "x", T[0], None)]


def test_close_deleted_and_reopen(spark):
    out = fold(
        spark, [[(1, "a", 0, "x")], [(2, "a", 0, "x")], [(1, "a", 0, "x"), (2, "a", 0, "x")]], close_deleted=True
    )
    assert [v[4:] for v in versions(out) if v[0] == 1] == [(T[0], T[1]), (T[2], None)]


def test_same_snapshot_again_changes_nothing(spark):
    rows = [(1, "a", 0, "x"), (2, None, None, None)]
    once = fold(spark, [rows])
    again = scd2_apply(once, snap(spark, rows), "id", ["job", "kids"], T[5])
    assert versions(again) == versions(once)


def brute(events):
    out = []
    for key in sorted({e[0] for e in events}):
        mine = sorted((e for e in events if e[0] == key), key=lambda e: (e[1], e[2]))
        kept = [e for i, e in enumerate(mine) if i == 0 or e[3] != mine[i - 1][3]]
        for i, e in enumerate(kept):
            out.append((key, e[3], e[4], e[1], kept[i + 1][1] if i + 1 < len(kept) else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,stretch", [(1, None), (2, "DAY"), (3, "HOUR"), (4, "YEAR")])
def test_log_folding_equals_brute_force(spark, seed, stretch):
    """Random logs with repeats across days, ties, NULL states and one hot key."""
    rng = random.Random(seed)
    events = []
    for i in range(400):
        key = 0 if rng.random() < 0.4 else rng.randint(1, 25)
        at = T[0] + timedelta(hours=rng.randint(0, 240))
        events.append((key, at, i, rng.choice(["a", "a", "b", None]), rng.random()))
    log = spark.createDataFrame(events, "k long, ts timestamp, seq long, state string, extra double")
    out = scd2_from_log(log, "k", "ts", ["state"], ["seq"], ["extra"], stretch)
    got = sorted(
        [(r.k, r.state, r.extra, r.valid_from, r.valid_to) for r in out.collect()], key=str
    )
    assert got == brute(events)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "long"])
def test_log_folding_does_not_depend_on_the_chunk(spark, kind):
    rng = random.Random(5)
    events = [
        (rng.randint(0, 3), T[0] + timedelta(minutes=rng.randint(0, 20_000)), i, rng.choice("abc"))
        for i in range(300)
    ]
    log = spark.createDataFrame(events, "k long, ts timestamp, seq long, state string")
    log = log.withColumn("ts", F.unix_seconds("ts") if kind == "long" else F.col("ts").cast(kind))
    results = [
        sorted(map(str, scd2_from_log(log, "k", "ts", ["state"], ["seq"], (), n).collect()))
        for n in ((10**9, 10**5, 3600) if kind == "long" else ("YEAR", "DAY", "HOUR"))
    ]
    assert results[0] == results[1] == results[2]


def test_stretches_do_not_move_with_outliers(spark):
    times = [datetime(2020, 1, 1) + timedelta(hours=h) for h in range(1000)]
    odd = [datetime(1, 1, 2), datetime(9999, 12, 31)]
    log = spark.createDataFrame([(t,) for t in times + odd], "ts timestamp_ntz")
    sizes = log.groupBy(stretch_of(log, "ts", "DAY").alias("s")).count().agg(F.max("count")).first()[0]
    assert sizes == 24


@pytest.mark.parametrize("kind", ["timestamp", "long"])
def test_null_order_comes_first(spark, kind):
    log = spark.createDataFrame([(1, "a", None), (1, "b", 5), (1, "a", 10**9)], "k long, s string, n long")
    log = log.withColumn("ts", F.timestamp_seconds("n") if kind == "timestamp" else F.col("n"))
    assert [r.s for r in scd2_from_log(log, "k", "ts", ["s"]).orderBy("valid_from").collect()] == ["a", "b", "a"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Singapore", "America/New_York"])
def test_presentation_does_not_depend_on_the_time_zone(spark, zone):
    history = fold(spark, [[(1, "a", 0, "x")], [(1, "b", 0, "x")]])
    def shown():
        return sorted(map(str, scd2_present(history, "id", "person_sk").collect()))
    before = shown()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert shown() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_key_is_refused(spark):
    bad = snap(spark, [(None, "a", 0, "x")])
    with pytest.raises(PySparkException, match="NULL id"):
        open_versions(bad, T[0], "id").collect()
    with pytest.raises(PySparkException, match="NULL id"):
        scd2_apply(open_versions(snap(spark, [(1, "a", 0, "x")]), T[0]), bad, "id", ["job"], T[1]).collect()


def test_log_folding_equals_folding_snapshots(spark):
    rng = random.Random(11)
    state, snapshots, log = {}, [], []
    for day, at in enumerate(T):
        for key in range(12):
            if key not in state or rng.random() < 0.4:
                state[key] = rng.choice("abc")
            log.append((key, at, state[key]))
        snapshots.append([(k, v, 0, None) for k, v in state.items()])
    folded = fold(spark, snapshots)
    direct = scd2_from_log(
        spark.createDataFrame(log, "id long, ts timestamp, job string"), "id", "ts", ["job"]
    )
    assert sorted(map(str, direct.collect())) == sorted(
        map(str, folded.select("id", "job", "valid_from", "valid_to").collect())
    )


def test_raw_log_is_never_windowed_by_key_alone(spark):
    log = spark.createDataFrame([(1, T[0], "a"), (2, T[1], "a")], "k long, ts timestamp, s string")
    text = scd2_from_log(log, "k", "ts", ["s"])._jdf.queryExecution().optimizedPlan().toString()
    for line in text.splitlines():
        if "Window" in line and "_chunk" not in line.split("],")[-2]:
            assert any(summary in line for summary in ("_last_state", "_opens_at", "_slot"))


def test_presentation(spark):
    history = fold(spark, [[(1, "a", 0, "x")], [(1, "b", 0, "x")]])
    rows = scd2_present(history, "id", "person_sk").orderBy("start_date").collect()
    assert [(str(r.start_date), str(r.end_date), r.is_current) for r in rows] == [
        ("2026-01-01", "2026-01-02", False),
        ("2026-01-02", "None", True),
    ]
    assert len({r.person_sk for r in rows}) == 2


def test_exactly_one_current_and_no_overlap_after_random_folds(spark):
    rng = random.Random(3)
    snapshots = [
        [(k, rng.choice("ab"), rng.randint(0, 1), "x") for k in rng.sample(range(15), 10)]
        for _ in range(5)
    ]
    out = fold(spark, snapshots)
    assert not_exactly_one_current(scd2_present(out, "id", "sk"), "id").count() == 0
    by_key = {}
    for v in versions(out):
        by_key.setdefault(v[0], []).append(v[4:])
    for spans in by_key.values():
        for (_, end), (start, _) in zip(spans, spans[1:]):
            assert end is not None and end <= start


def test_violations_are_found(spark):
    dim = spark.createDataFrame(
        [(1, True), (1, True), (2, False), (3, True)], "id long, is_current boolean"
    )
    out = {(r.id, r.current_count) for r in not_exactly_one_current(dim, "id").collect()}
    assert out == {(1, 2), (2, 0)}


def test_published_history_equals_pure_folding(spark, tmp_path):
    rng = random.Random(9)
    snapshots = [
        [(k, rng.choice("ab"), 0, "x") for k in rng.sample(range(10), 7)] for _ in range(4)
    ]
    root = str(tmp_path / "h")
    for at, rows in zip(T, snapshots):
        store.publish_history(spark, root, snap(spark, rows), "id", ["job", "kids"], at)
    expected = versions(fold(spark, snapshots))
    assert versions(store.read_history(spark, root, "id")) == expected
    # A repeated run replaces its own output only.
    store.publish_history(spark, root, snap(spark, snapshots[-1]), "id", ["job", "kids"], T[3])
    assert versions(store.read_history(spark, root, "id")) == expected
    assert versions(store.read_history(spark, root, "id", T[1])) == versions(fold(spark, snapshots[:2]))


def test_published_history_may_start_empty(spark, tmp_path):
    root = str(tmp_path / "h")
    store.publish_history(spark, root, snap(spark, []), "id", ["job", "kids"], T[0])
    store.publish_history(spark, root, snap(spark, [(1, "a", 0, "x")]), "id", ["job", "kids"], T[1])
    assert versions(store.read_history(spark, root, "id")) == [(1, "a", 0, "x", T[1], None)]


def test_history_step_avoids_interpreted_expressions(spark):
    history = fold(spark, [[(1, "a", 0, "x")], [(1, "b", 0, "x")]])
    text = history._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in text
