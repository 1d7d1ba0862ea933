"""Joins, mixing, token files, graph search and the pipeline."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from compare import differences, oracle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendscape.llm import components, graph_index, mixing, ngram_join, token_files
from lendscape.llm.queries import QUERIES, SQL
from lendscape.sources.store import scratch

SF = "/root/testdata/sf0.001"


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def plain_shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    n = len(words)
    return {tuple(words[k : k + 5]) for k in range(n - 4)} if n >= 5 else {tuple(words)} if n else set()


def plain_groups(rows):
    """(id, set size, smallest linked id) by comparing every pair that shares a shingle."""
    sets = []
    for i, text in rows:
        sets.append((i, plain_shingles(text)))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        shared = Counter(j for t in s for j in lists[t]) if i is not None else {}
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                a, b = root(i), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
        for t in s if i is not None else ():
            lists[t].append(k)
    return ordered((i, len(s), None if i is None else root(i)) for i, s in sets)


@pytest.fixture(scope="module")
def copies(spark):
    import random

    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]

    def near(base, edits):
        out = list(base)
        for _ in range(edits):
            out[rng.randrange(len(out))] = rng.choice(vocabulary)
        return " ".join(out)

    base, passage = words(120), " ".join(words(60))
    rows = [(1000 + k, near(base, rng.choice([0, 1, 1, 2, 3, 4, 8]))) for k in range(120)]
    rows += [(2000 + k, passage + " " + " ".join(words(rng.choice([3, 6, 14, 60])))) for k in range(100)]
    for g in range(20):
        b = words(rng.choice([3, 5, 6, 12, 40, 200]))
        rows += [(3000 + g * 20 + k, near(b, rng.choice([0, 0, 1, 2]))) for k in range(rng.choice([1, 2, 5, 9]))]
    rows += [(1, ""), (2, None), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (None, "x y z"), (None, "x y z"),
             (7, "x y z"), (7, "x y z"), (8, "é É")]
    rows += [(5000 + k, "same text for all of them here") for k in range(80)]
    return rows


@pytest.mark.parametrize("options", [{}, {"long": 4}, {"long": 4, "most_long": 20}, {"long": 4, "most_long": 0}])
def test_similar_sets(spark, copies, options):
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(5)
    assert ordered(ngram_join.similar_sets(docs, **options).collect()) == plain_groups(copies)


def test_similar_sets_of_the_test_table_and_odd_rows(spark, clashing, none):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert ordered(QUERIES["op3_ngram_join"](spark, SF).collect()) == plain_groups(rows)
    assert ordered(ngram_join.similar_sets(clashing).collect()) == plain_groups(
        [(r.doc_id, r.text) for r in clashing.collect()]
    )
    assert ngram_join.similar_sets(none).count() == 0


def test_a_long_list_that_is_not_remembered(spark):
    """Boilerplate that no task may expand into pairs hides no link."""
    # A near pair at the far end, and enough words of its own to keep any other two apart.
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(k, f"all of them begin with this line {own(k)}") for k in range(20_000)]
    rows += [(20_000, rows[-1][1] + " end"), (20_001, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = dict(map(tuple, ngram_join.similar_sets(docs, most_long=0).select("doc_id", "component_id").collect()))
    assert got == {k: k for k in range(20_000)} | {20_000: 19_999, 20_001: 7}


def test_search_by_exact_counts(spark, copies):
    """Candidates and long lists hold every link, and a line that all share is on no list."""
    rows = list({(i, t) for i, t in copies if i is not None and t and t.split()})
    texts = spark.createDataFrame(rows, "_id long, _text string")
    pairs, entries = ngram_join.by_count(texts, 4)
    lists = {}
    for e in entries.collect():
        assert 0 <= e.place < e.h
        lists.setdefault(e.token, set()).add(e.doc_id)
    met = {tuple(sorted((p.r, p.s))) for p in pairs.collect()}
    met |= {(a, b) for members in lists.values() for a in members for b in members if a < b}
    smallest = {}
    for i, s in sorted(((i, frozenset(plain_shingles(t))) for i, t in rows), key=lambda x: x[0]):
        smallest.setdefault(s, i)
    distinct = [(i, s) for s, i in smallest.items()]
    links = {
        tuple(sorted((a, b)))
        for k, (a, s) in enumerate(distinct)
        for b, t in distinct[:k]
        if a != b and 100 * len(s & t) >= 80 * len(s | t)
    }
    assert len(links) > 100 and links <= met

    own = [(k, "one line that all share " + " ".join(f"w{k}x{j}" for j in range(30))) for k in range(200)]
    pairs, entries = ngram_join.by_count(spark.createDataFrame(own, "_id long, _text string"), 4)
    assert pairs.isEmpty() and entries.isEmpty()


def test_counts_of_shingles_round_trip(rng):
    import numpy as np

    for values in ([5], [0, 1 << 31, (1 << 32) - 1], sorted(rng.sample(range(1 << 32), 500)), list(range(9))):
        values = np.array(values, np.uint32)
        counts = np.array([rng.choice([1, 1, 2, 70_000]) for _ in values])
        got = ngram_join._counts(ngram_join._counts_blob(values, counts))
        assert [x.tolist() for x in got] == [values.tolist(), counts.tolist()]


def test_overlap_bounds():
    for n in range(1, 60):
        for m in range(1, 60):
            t = next(o for o in range(1, 200) if 100 * o >= 80 * (n + m - o))
            assert ngram_join.least_overlap(n, m) == t
        assert ngram_join.prefix_length(n) == n - next(o for o in range(n + 1) if 100 * o >= 80 * n) + 1


def test_heap_merge_adds_counts():
    lists = [[(1, 5, 0, 2), (4, 5, 0, 1)], [(1, 5, 0, 1)], [(2, 9, 1, 3), (4, 5, 0, 4)]]
    assert list(ngram_join.heap_merge(lists)) == [(1, 5, 0, 3), (2, 9, 1, 3), (4, 5, 0, 5)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(201, 200), (200, 201), (300, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_mixing_matches_sql(spark):
    assert differences(QUERIES["op2_mixing"](spark, SF), oracle(SF), SQL["op2_mixing"]) is None


def test_mixing_odd_rows(spark, odd, clashing, none):
    domain = mixing.domain_of(F.col("source"))
    got = mixing.mix(clashing, domain).collect()
    assert len(got) == odd.count()
    total = sum(r.n_tokens for r in got)
    taken = sum(r.tokens_taken for r in got)
    assert taken >= 0.8 * total - 40
    assert all(r.copies <= mixing.EPOCHS and r.tokens_taken <= r.copies * r.n_tokens for r in got)
    assert mixing.mix(none, domain).count() == 0
    again = mixing.resample(clashing, domain)
    assert again.columns == clashing.columns
    assert again.count() == sum(r.copies for r in got)


def test_budget_is_kept_on_repeated_and_null_ids(spark, odd):
    """The rows that SQL gives, whatever ids and texts repeat."""
    import duckdb

    same = [(i % 7, "one two three four five six seven eight nine ten", "en", "src1", 1) for i in range(70)]
    nameless = [(None, "a b c d e f g h i j", "en", "src1", 1)] * 50 + [(100 + i, f"k l m n o {i}", "en", "src1", 1) for i in range(50)]
    mixed = [(i % 5, "w " * (i % 4), "fr", f"src{i % 2}", 1) for i in range(60)]
    for rows in (same, nameless, mixed, [tuple(r) for r in odd.collect()]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        con = duckdb.connect()
        con.register("documents", docs.toArrow())
        got = mixing.mix(docs, mixing.domain_of(F.col("source")))
        assert differences(got, con, SQL["op2_mixing"]) is None
        total, taken = (sum(r[c] for r in got.collect()) for c in ("n_tokens", "tokens_taken"))
        assert taken <= 0.8 * total
        again = mixing.resample(docs, mixing.domain_of(F.col("source")))
        assert again.count() == sum(r.copies for r in got.collect())


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "1", 10), ("a", "y", "1", 1000), ("b", "x", "1", 1000), ("b", "y", "1", 1000)],
        "domain string, lang string, source string, tokens long",
    )
    plan = mixing.leaf_budgets(leaves, weights={}, percent=20, epochs=1)
    got = {(r.domain, r.lang): r.budget for r in plan.collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 291, ("b", "x"): 150, ("b", "y"): 150}
    # Domain a cannot use its half: what its leaves lack goes to b.
    plan = mixing.leaf_budgets(leaves.filter("domain = 'b' or lang = 'x'"), weights={}, percent=50, epochs=1)
    got = {(r.domain, r.lang): r.budget for r in plan.collect()}
    assert got == {("a", "x"): 10, ("b", "x"): 497, ("b", "y"): 497}


@pytest.mark.parametrize("n", [0, 1, 5, 63, 64, 65, 5000])
def test_coder_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n) - 1, 49_000).astype(np.uint32)
    assert (token_files.unpack(token_files.pack(ids)) == ids).all()


def test_decoding_from_checkpoints(monkeypatch):
    monkeypatch.setattr(token_files, "CHECKPOINT_STEPS", 4)
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint32)
    segment = token_files.pack(ids)
    block = segment["blocks"][0]
    freq = np.frombuffer(segment["freqs"], "<u4").astype(np.int64)
    cum, slots = np.cumsum(freq) - freq, np.repeat(np.arange(len(freq)), freq)
    parts = [token_files.decode_block(block, freq, cum, slots, i, i + 1) for i in range(len(block["steps"]))]
    assert len(parts) > 5
    assert (np.frombuffer(segment["symbols"], "<u4")[np.concatenate(parts)] == ids).all()


def test_checksum_is_checked():
    segment = token_files.pack(np.arange(500, dtype=np.uint32) % 7)
    segment["blocks"][0]["crc"] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        token_files.unpack(segment)


def plain_token_rows(rows):
    library = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    at, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return ordered(out)


def test_token_files(spark, clashing, none, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert ordered(QUERIES["op5_token_files"](spark, SF).collect()) == plain_token_rows(rows)
    got = token_files.token_files(clashing, f"{scratch(spark)}/files").orderBy("start").collect()
    # Ids that repeat may stand in either order, so starts are checked by adding up.
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in clashing.collect()), key=lambda x: (x is not None, x or 0))
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    plain = plain_token_rows([(r.doc_id, r.text) for r in clashing.collect()])
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == ordered((a, c, d) for a, _, c, d in plain)
    assert token_files.token_files(none, f"{scratch(spark)}/files").count() == 0


def plain_nearest(vectors, queries, top):
    x = np.array([v for _, v in vectors])
    ids = np.array([i for i, _ in vectors])
    out = {}
    for q, v in queries:
        scores = (x * np.array(v)).sum(axis=1)
        out[q] = [(int(ids[k]), float(scores[k])) for k in np.lexsort((ids, -scores)) if ids[k] != q][:top]
    return out


def test_graph_recall_on_the_test_table(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = plain_nearest(vectors, [v for v in vectors if v[0] % 20 == 0], 20)
    got = defaultdict(list)
    for r in QUERIES["op6_graph_index"](spark, SF).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, rows in got.items():
        scores = dict(plain_nearest(vectors, [(q, dict(vectors)[q])], len(vectors))[q])
        assert np.allclose([s for _, s in rows], [scores[i] for i, _ in rows], rtol=0, atol=1e-12)


def test_graph_recall_over_several_shards(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=24).tolist()) for i in range(3000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    want = plain_nearest(vectors, vectors[::20], 20)
    got = defaultdict(set)
    for r in graph_index.nearest(df, F.col("vec_id") % 20 == 0, shard_rows=1000).collect():
        got[r.query_id].add(r.vec_id)
    assert sum(len({i for i, _ in want[q]} & got[q]) for q in want) >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("kind", ["unit", "normal", "log-normal", "clusters"])
def test_graph_recall_for_lengths_that_differ(spark, kind):
    rng = np.random.default_rng(11)
    n, d = 2048, 48
    x = rng.normal(size=(n, d))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = rng.normal(size=(20, d))
    x = {
        "unit": unit,
        "normal": x,
        "log-normal": unit * np.exp(rng.normal(size=(n, 1))),
        "clusters": centres[rng.integers(0, 20, n)] + 0.1 * x,
    }[kind]
    vectors = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    want = plain_nearest(vectors, vectors[::20], 20)
    got = defaultdict(set)
    for r in graph_index.nearest(df, F.col("vec_id") % 20 == 0, shard_rows=1024).collect():
        got[r.query_id].add(r.vec_id)
    assert sum(len({i for i, _ in want[q]} & got[q]) for q in want) >= 0.95 * 20 * len(want)


def test_each_query_row_has_its_own_ranks(spark):
    vectors = [(i, [float(i % 7), 1.0, float(i)]) for i in range(1, 60)]
    more = [(20, vectors[19][1]), (40, [-1.0, 0.5, -3.0])]
    df = spark.createDataFrame(vectors + more, "vec_id long, embedding array<double>")
    got = graph_index.nearest(df, F.col("vec_id") % 20 == 0).collect()
    ranks = sorted((r.query_id, r["rank"]) for r in got)
    assert ranks == sorted((q, k) for q in (20, 20, 40, 40) for k in range(1, 21))
    want = [(i, s) for q in ((20, vectors[19][1]), (40, vectors[39][1]), more[0], more[1])
            for i, s in plain_nearest(vectors + more, [q], 20)[q[0]]]
    assert sorted((r.vec_id, round(r.score, 9)) for r in got) == sorted((i, round(s, 9)) for i, s in want)


def test_bands_of_extreme_lengths(spark):
    vectors = [(i, [s * 3.0, s * 4.0]) for i, s in enumerate((1e-300, 1e-3, 1.0, 1.04, 1.2, 1e150))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = dict(map(tuple, df.select("vec_id", graph_index.band("embedding")).collect()))
    step = np.log(graph_index.BAND_RATIO)
    for i, (x, y) in vectors:
        assert got[i] == np.floor((np.log(5) + np.log(y / 4)) / step + 0.5)
    assert graph_index.nearest(df, F.lit(True)).count() == 30


def test_odd_vectors_take_no_part(spark):
    good = [(i, [float(i % 3), 1.0]) for i in range(1, 31)]
    odd = [(0, None), (40, []), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]),
           (120, [None, 1.0]), (140, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>").withColumn("rank", F.lit(9))
    got = graph_index.nearest(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    want = plain_nearest(good, [good[19]], 20)[20]
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(20, i, s) for i, s in want]
    few = graph_index.nearest(df.filter("vec_id in (20, 3, 4)"), F.col("vec_id") % 20 == 0)
    assert [r.vec_id for r in few.orderBy("rank").collect()] == [3, 4] or few.count() == 2
    assert graph_index.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark, clashing, none):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (clashing, none):
            assert stage(spark, docs, SF).columns == docs.columns, name
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    assert kept.count() == docs.count()
    groups = plain_groups([(r.doc_id, r.text) for r in docs.collect()])
    one_each = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in one_each.collect()) == sorted({g for _, _, g in groups})
    masked = corpus_pipeline.mask_secrets(spark, docs, SF)
    assert masked.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    changed = masked.join(docs.select("doc_id", F.col("text").alias("before")), "doc_id").filter("text != before")
    found = QUERIES["op7_secret_scan"](spark, SF).filter("spans != ''")
    assert sorted(r.doc_id for r in changed.collect()) == sorted(r.doc_id for r in found.collect())


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and all(r.restored for r in out)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert {r.doc_id for r in out} <= {g for _, _, g in plain_groups([(r.doc_id, r.text) for r in docs.collect()])}
