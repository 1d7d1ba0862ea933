import random

import pytest

from lendscape.operators.ranking import ntile


def plain(rows, tiles):
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0]))
    size, more = divmod(len(order), tiles)
    out, at = {}, 0
    for t in range(1, tiles + 1):
        for r in order[at : at + size + (t <= more)]:
            out[r[0]] = t
        at += size + (t <= more)
    return {r[0]: out.get(r[0]) for r in rows}


@pytest.mark.parametrize("n,tiles", [(0, 4), (3, 4), (4, 4), (103, 4), (1000, 7)])
def test_equals_sorting_all_rows(spark, n, tiles):
    rng = random.Random(n)
    # A third of the rows share one value, some have none.
    rows = [(i, rng.choice([5.0, None, rng.uniform(0, 10), rng.uniform(0, 10)]) if i % 3 else 5.0) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(6)
    got = ntile(df, tiles, "v", "k", "part")
    assert got.columns == ["k", "v", "part"]
    assert {r.k: r.part for r in got.collect()} == plain(rows, tiles)
