"""Collocations against counting every phrase in one process."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import differences, oracle

from lendscape.llm import collocations as C
from lendscape.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def grams(rows):
    """Per language, occurrences of each tuple of one to three words."""
    f = defaultdict(Counter)
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def plain(rows, least=10, top=2000, percent=50):
    out = []
    for lang, f in grams(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= percent * a for q, b in candidates.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def rows_of(got):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got.collect())


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    words = ["the", "The", "of", "loan", "rate", "É", "日本", "a-b", "(x)", "#1"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "! "]) for _ in range(rng.choice([2, 9, 60])))
    rows = [(rng.choice(["en", "en", "en", "fr", None, "und"]), text()) for _ in range(150)]
    return rows + [("en", "same words in every copy of this")] * 12 + [("es", None), ("es", ""), (None, " .,;\n"), ("de", "a")]


def frame(spark, rows):
    return spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string").repartition(4)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"min_count": 3, "sample_count": 1},
        # Nothing proposed: all frequent phrases are failures of the sample, level by level.
        {"min_count": 3, "sample_count": 1000},
        # The smallest filters.
        {"min_count": 3, "bits": 1 << 15, "share": 1, "sample_count": 1},
    ],
)
def test_collocations(spark, prose, options):
    got = C.collocations(frame(spark, prose), shares=3, bits=options.pop("bits", 1 << 20), **options)
    assert rows_of(got) == plain(prose, options.get("min_count", 10))


def test_first_ranks_and_ties(spark, prose):
    got = C.collocations(frame(spark, prose), top=7, shares=2, bits=1 << 18, min_count=2)
    assert rows_of(got) == plain(prose, 2, 7)


def test_odd_rows_clashing_columns_and_empty_table(spark, odd, clashing, none):
    more = clashing.selectExpr("*", "1 as phrase", "2 as n", "3 as a", "4 as l", "5 as `left`", "6 as count")
    want = plain([(r.lang, r.text) for r in odd.collect()])
    assert want and rows_of(C.collocations(more, bits=1 << 20)) == want
    assert C.collocations(none, bits=1 << 15).count() == 0


@pytest.mark.parametrize("most", [1, 7, 64, 1 << 20])
def test_slices_keep_pieces_whole(prose, most):
    rows = prose + [("en", "x y z" * 4000), ("en", "one two, " * 20000)]
    table = pa.table({"lang": pa.array([x or "und" for x, _ in rows]), "text": pa.array([t for _, t in rows], pa.string())})
    total = Counter()
    for data, offsets, langs in C.text_slices(table, most):
        for part in C.count_slice(C.Words(data, offsets, langs), C.Proposal(), None, 3):
            for r in part.to_pylist():
                total[r["lang"], r["phrase"], r["n"]] += r["count"]
    want = Counter()
    for lang, f in grams(rows).items():
        want.update({(lang, " ".join(p), len(p)): c for p, c in f.items()})
        want[lang, "", 0] += sum(c for p, c in f.items() if len(p) == 1)
    assert +total == +want


def test_filters_hold_every_member(spark):
    rows = [("en" if i % 2 else "fr", f"w{i} é{i % 7}", 2, 1) for i in range(500)]
    bits = C.filter_of(spark.createDataFrame(rows, C.COUNTS), 2, 1 << 17)
    table = pa.table({"lang": [r[0] for r in rows], "phrase": [r[1] for r in rows]})
    assert C.Proposal(None, bits).has_pairs(C.phrase_hashes(table, 2)).all()
    assert 0.9 < np.unpackbits(bits).sum() / 1000 <= 1


def test_full_filters_take_nothing_away(spark, prose, monkeypatch):
    """With all bits set, everything is counted in the first pass."""
    full = lambda phrases, n, bits: np.full(bits // 8, 255, np.uint8)
    monkeypatch.setattr(C, "filter_of", full)
    assert rows_of(C.collocations(frame(spark, prose), shares=2, min_count=4)) == plain(prose, 4)


def test_filter_sizes():
    assert C.filter_bits(0, 1 << 28) == C.filter_bits(100, 1 << 28) == 1 << 15
    assert 16 * 10**6 <= C.filter_bits(10**6, 1 << 28) <= 32 * 10**6
    assert C.filter_bits(10**12, 1 << 28) == 1 << 28


def test_products_beyond_64_bits(spark):
    big = spark.createDataFrame([(3 * 10**12, 4 * 10**12, 5 * 10**12), (7, 7, 7)], "a long, l long, r long")
    got = [r[0] for r in big.select(C._score(big.a, big.l, big.r)).collect()]
    assert got == [10**6 * 9 // 20, 10**6]


def test_query_equals_its_sql(spark):
    assert differences(QUERIES["op13_collocations"](spark, SF), oracle(SF), SQL["op13_collocations"]) is None
