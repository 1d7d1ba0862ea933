import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendscape.operators.upsert import upsert
from lendscape.registry import QUERIES
from lendscape.sources import store

SCHEMA = "k long, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_new_changed_unchanged_absent(spark):
    target = frame(spark, [(1, "same"), (2, "old"), (3, "absent")])
    source = frame(spark, [(1, "same"), (2, "new"), (4, "added")])
    assert rows(upsert(target, source, ["k"])) == [
        (1, "same"),
        (2, "new"),
        (3, "absent"),
        (4, "added"),
    ]


def test_no_target(spark):
    source = frame(spark, [(1, "a")])
    assert rows(upsert(None, source, ["k"])) == [(1, "a")]


def test_repeated_source_key_fails(spark):
    with pytest.raises(PySparkException, match="repeats a key"):
        upsert(frame(spark, [(9, "x")]), frame(spark, [(1, "a"), (1, "b")]), ["k"]).collect()


def test_repeated_source_key_fails_on_the_first_day_too(spark, tmp_path):
    twice = frame(spark, [(5, "a"), (5, "b")])
    with pytest.raises(PySparkException, match="repeats a key"):
        upsert(None, twice, ["k"]).count()
    with pytest.raises(PySparkException, match="repeats a key"):
        store.publish_upsert(spark, str(tmp_path / "t"), twice, ["k"], "2026-05-12")
    assert store.read_keyed(spark, str(tmp_path / "t"), ["k"]) is None


def test_null_keys_match_nothing(spark):
    out = upsert(frame(spark, [(None, "t"), (1, "t")]), frame(spark, [(None, "s")] * 2), ["k"])
    assert rows(out) == [(1, "t"), (None, "s"), (None, "s"), (None, "t")]


def test_composite_key(spark):
    schema = "a long, b long, v string"
    target = spark.createDataFrame([(1, 1, "t"), (1, 2, "t")], schema)
    source = spark.createDataFrame([(1, 2, "s"), (2, 1, "s")], schema)
    assert rows(upsert(target, source, ["a", "b"])) == [(1, 1, "t"), (1, 2, "s"), (2, 1, "s")]


def test_different_columns_are_an_error(spark):
    source = spark.createDataFrame([(1, 2)], "k long, other long")
    with pytest.raises(PySparkException):
        upsert(frame(spark, [(1, "a")]), source, ["k"]).collect()


def test_applying_twice_changes_nothing(spark):
    rng = random.Random(7)
    for _ in range(5):
        target = frame(spark, [(k, f"t{k}") for k in rng.sample(range(30), 12)])
        source = frame(spark, [(k, f"s{rng.random()}") for k in rng.sample(range(30), 9)])
        once = upsert(target, source, ["k"])
        assert rows(upsert(once, source, ["k"])) == rows(once)


def test_each_side_is_shuffled_once(spark):
    target = spark.range(10_000).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    text = upsert(target, frame(spark, [(5, "s")]), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


DAYS = ("2026-05-10", "2026-05-11", "2026-05-12")


def publish(spark, root, label, *pairs, fold_after=100):
    store.publish_upsert(spark, root, frame(spark, list(pairs)), ["k"], label, fold_after)


def test_published_days(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark, root, DAYS[0], (1, "a"), (2, "a"))
    publish(spark, root, DAYS[1], (2, "b"), (3, "b"), (None, "n"))
    expected = [(1, "a"), (2, "b"), (3, "b"), (None, "n")]
    assert rows(store.read_keyed(spark, root, ["k"])) == expected
    publish(spark, root, DAYS[1], (2, "b"), (3, "b"), (None, "n"))
    assert rows(store.read_keyed(spark, root, ["k"])) == expected
    assert rows(store.read_keyed(spark, root, ["k"], DAYS[0])) == [(1, "a"), (2, "a")]
    assert store.read_keyed(spark, root, ["k"], "2026-05-09") is None


def test_random_order_of_days_gives_the_state_of_the_right_order(spark, tmp_path):
    rng = random.Random(3)
    for fold_after in (1, 2, 100):
        root, days = str(tmp_path / f"t{fold_after}"), {}
        for label in rng.sample([*DAYS, *DAYS[:2]], 5):
            days[label] = [(k, f"{label}/{rng.random():.3f}") for k in rng.sample(range(12), 5)]
            publish(spark, root, label, *days[label], fold_after=fold_after)
            want = {k: v for day in sorted(days) for k, v in days[day]}
            assert dict(rows(store.read_keyed(spark, root, ["k"]))) == want


def test_a_day_writes_only_its_own_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark, root, DAYS[0], *[(k, "a") for k in range(40)])
    before = sorted((tmp_path / "t").rglob("*.parquet"))
    publish(spark, root, DAYS[1], (7, "b"))
    new = set((tmp_path / "t").rglob("*.parquet")) - set(before)
    assert {p.parent.name for p in new} == {f"label={DAYS[1]}"}
    assert sum(spark.read.parquet(str(p)).count() for p in new) == 1


def test_folded_deltas_are_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark, root, DAYS[0], *[(k, "a") for k in range(9)], (None, "n"))
    publish(spark, root, DAYS[1], (7, "b"), (None, "n"), fold_after=2)
    publish(spark, root, DAYS[2], (8, "c"), (None, "m"))
    state = store.read_keyed(spark, root, ["k"])
    assert not [f for f in state.inputFiles() if f"/delta/label={DAYS[0]}" in f]
    want = [(k, "a") for k in range(7)] + [(7, "b"), (8, "c"), (None, "m"), (None, "n"), (None, "n")]
    assert rows(state) == want
    text = state._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text  # one delta: nothing to rank, and the base is not shuffled
    # A back-dated day takes the bases away that were made without it.
    publish(spark, root, DAYS[0], *[(k, "x") for k in range(3)])
    assert rows(store.read_keyed(spark, root, ["k"])) == [(0, "x"), (1, "x"), (2, "x"), (7, "b"), (8, "c"), (None, "m"), (None, "n")]


def test_failed_repetition_leaves_the_state(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark, root, DAYS[0], (1, "a"))
    publish(spark, root, DAYS[1], (1, "b"))
    broken = frame(spark, [(1, "x")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    for label in DAYS[:2]:
        with pytest.raises(PySparkException, match="lost"):
            store.publish_upsert(spark, root, broken, ["k"], label)
        assert rows(store.read_keyed(spark, root, ["k"])) == [(1, "b")]
        assert rows(store.read_keyed(spark, root, ["k"], DAYS[0])) == [(1, "a")]


def test_a_failing_or_repeated_run_leaves_others_alone(spark, tmp_path):
    root = str(tmp_path / "r")
    for label in DAYS:
        assert store.write_run(frame(spark, [(1, label), (2, label)]), root, "day", label) == {None: 2}
    others = {p: p.stat().st_mtime_ns for p in (tmp_path / "r").rglob("*.parquet") if DAYS[1] not in str(p)}
    broken = frame(spark, [(1, "x")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(PySparkException, match="lost"):
        store.write_run(broken, root, "day", DAYS[1])
    assert rows(store.read_run(spark, root, "day", DAYS[1])) == [(1, DAYS[1]), (2, DAYS[1])]
    store.write_run(frame(spark, [(3, "b")]), root, "day", DAYS[1])
    assert rows(store.read_run(spark, root, "day", DAYS[1])) == [(3, "b")]
    assert store.write_run(frame(spark, []), root, "day", DAYS[1]) == {None: 0}
    assert rows(store.read_run(spark, root, "day", DAYS[1])) == []
    assert {p: p.stat().st_mtime_ns for p in others} == others
    # Any reader of parquet sees the same rows.
    assert spark.read.parquet(root).groupBy("day").count().count() == 2


def test_split_runs(spark, tmp_path):
    root = str(tmp_path / "s")
    split = ("v", ("good", "bad"))
    write = lambda *pairs: store.write_run(frame(spark, list(pairs)), root, "day", DAYS[0], split)
    assert write((1, "good"), (2, "bad"), (3, "bad")) == {"good": 1, "bad": 2}
    assert write((4, "good")) == {"good": 1, "bad": 0}
    got = store.read_runs(spark, root, "day", [DAYS[0]])
    assert [(r.k, r.v) for r in got.collect()] == [(4, "good")]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_tells_how_many_buckets_a_second_day_rewrote(spark, sf):
    got = QUERIES["stored_upsert_buckets"].run(spark, sf)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert [tuple(r) for r in got.select("files_kept", "files_written").distinct().collect()] == [(7, 1)]
    assert got.count() == orders.count()


def merge(spark, root, *pairs, buckets=8):
    store.merge_buckets(spark, root, frame(spark, list(pairs)), ["k"], buckets)


def buckets_read(spark, root):
    return rows(store.read_buckets(spark, root, frame(spark, []).schema))


def test_a_merge_rewrites_only_its_own_buckets(spark, tmp_path):
    root, files = str(tmp_path / "t"), lambda: set((tmp_path / "t").rglob("*.parquet"))
    merge(spark, root, *[(k, "a") for k in range(60)])
    before = files()
    assert len(before) == 8
    merge(spark, root, (7, "b"))
    (new,), (gone,) = files() - before, before - files()
    assert new.parent == gone.parent
    assert buckets_read(spark, root) == sorted(((k, "b" if k == 7 else "a") for k in range(60)), key=str)


def test_merged_buckets_hold_the_state_of_any_days(spark, tmp_path):
    rng = random.Random(5)
    for buckets in (1, 3, 8):
        root, want = str(tmp_path / f"t{buckets}"), {}
        for day in range(4):
            pairs = [(k, f"{day}/{k}") for k in rng.sample(range(12), 4)]
            for _ in range(2):
                merge(spark, root, *pairs, buckets=buckets)
            want |= dict(pairs)
            assert dict(buckets_read(spark, root)) == want


def test_merged_buckets_on_odd_input(spark, tmp_path):
    root = str(tmp_path / "t")
    merge(spark, root)
    assert buckets_read(spark, root) == []
    merge(spark, root, (1, "a"), (None, "n"))
    merge(spark, root, (None, "n"), (2, "b"))
    want = [(1, "a"), (2, "b"), (None, "n"), (None, "n")]
    assert buckets_read(spark, root) == want
    broken = frame(spark, [(1, "x")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(PySparkException, match="lost"):
        store.merge_buckets(spark, root, broken, ["k"], 8)
    with pytest.raises(PySparkException, match="repeats a key"):
        merge(spark, root, (2, "x"), (2, "y"))
    with pytest.raises(PySparkException):
        store.merge_buckets(spark, root, frame(spark, [(1, "x")]).drop("v"), ["k"], 8)
    with pytest.raises(ValueError, match="4 buckets"):
        merge(spark, root, (1, "x"), buckets=4)
    assert buckets_read(spark, root) == want
