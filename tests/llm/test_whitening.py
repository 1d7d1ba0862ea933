"""Whitening against an eigendecomposition of the whole covariance."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscape.llm import whitening
from lendscape.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def plain(vectors):
    """Exact deviations, eigenvalues (falling), eigenvectors and centred rows."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    wide = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    y = np.array([[float(c) for c in r] for r in wide]) / n
    values, vs = np.linalg.eigh(y.T @ y / n)
    return [d if (d := sum(c * c for c in r)) < 1 << 63 else None for r in wide], values[::-1], vs[:, ::-1], y


def check(got, vectors, components=32, tolerance=1e-6):
    """``vectors``: (id, vector) of the rows that take part, ids without repetition."""
    deviation, values, vs, y = plain([v for _, v in vectors])
    k = min(components, int((values > 1e-12 * values[0]).sum())) if values[0] > 0 else 0
    rows = defaultdict(dict)
    for r in got.collect():
        rows[r.vec_id][r.component] = r
    assert len(rows) == (len(vectors) if k else 0)
    for i, (name, _) in enumerate(vectors if k else ()):
        assert sorted(rows[name]) == list(range(1, k + 1))
        assert {(r.n, r.deviation) for r in rows[name].values()} == {(len(vectors), deviation[i])}
    if not k:
        return
    white = np.array([[rows[name][c].whitened for c in range(1, k + 1)] for name, _ in vectors])
    some = rows[vectors[0][0]]
    shares = np.array([some[c].explained for c in range(1, k + 1)])
    assert np.allclose(shares, values[:k] / values.sum(), rtol=1e-6)
    error = np.abs(white.T @ white / len(vectors) - np.eye(k)).max()
    assert error < 1e-8 and all(r.identity_error < 1e-8 for r in some.values())
    # Components with distinct eigenvalues are those of the covariance but for the sign.
    gaps = np.abs(np.diff(values))
    for c in range(k):
        near = min(gaps[c - 1] if c else np.inf, gaps[c] if c < len(gaps) else np.inf)
        if near > 1e-3 * values[c]:
            want = y @ vs[:, c] / np.sqrt(values[c])
            assert min(np.abs(white[:, c] - want).max(), np.abs(white[:, c] + want).max()) < tolerance


def test_query_on_the_test_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(QUERIES["op12_whitening"](spark, SF), [(r.vec_id, list(r.embedding)) for r in rows])


@pytest.mark.parametrize("spread", [0, 3, 8])
def test_scales_of_dimensions(spark, spread):
    rng = np.random.default_rng(spread)
    x = rng.normal(size=(700, 9)) @ rng.normal(size=(9, 9)) * np.logspace(0, spread, 9)
    vectors = list(enumerate(x.tolist()))
    df = spark.createDataFrame(vectors, SCHEMA).repartition(5)
    check(whitening.whiten(df, components=5), vectors, 5)


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, size=(300, 4)) / 64.0
    x = np.column_stack([x, x[:, 0], x[:, 1] + x[:, 2], np.ones(300), np.zeros(300)])
    vectors = list(enumerate(x.tolist()))
    check(whitening.whiten(spark.createDataFrame(vectors, SCHEMA)), vectors)


def test_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(2)
    vectors = list(enumerate(rng.normal(size=(6, 20)).tolist()))
    check(whitening.whiten(spark.createDataFrame(vectors, SCHEMA)), vectors)


def test_odd_rows_take_no_part(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(60, 3)).tolist())]
    odd = [(100, None), (101, []), (102, [1.0, float("nan"), 0.0]), (103, [float("-inf"), 0.0, 1.0]),
           (104, [None, 1.0, 1.0]), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(vectors + odd, SCHEMA).withColumns(
        {c: F.lit(7) for c in ("component", "n", "_v", "_id", "whitened", "place", "value")}
    )
    check(whitening.whiten(df), vectors)


def test_equal_rows_single_row_and_no_row(spark):
    equal = [(i, [0.5, -2.0]) for i in range(9)]
    assert whitening.whiten(spark.createDataFrame(equal, SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame(equal[:1], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = [(None, [0.0, 1.0]), (None, [1.0, 0.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [5.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted(
        (i, c) for i in (0, 0, 3, 3, 4) for c in (1, 2)
    )


def test_large_deviations(spark):
    big = [(i, [float(i % 3) * 1e4, float(i)]) for i in range(500)]
    check(whitening.whiten(spark.createDataFrame(big, SCHEMA)), big)
    beyond = [(i, [float(i) * 1e10, float(i % 7)]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(beyond, SCHEMA), components=1)
    check(got, beyond, 1)
    assert any(r.deviation is None for r in got.collect())
