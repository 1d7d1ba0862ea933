"""Exact dedup against grouping by the texts themselves."""

import hashlib
from collections import defaultdict

import pytest
from compare import differences, oracle
from pyspark.sql import functions as F

from lendscape.llm import block_naming
from lendscape.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(rows):
    """Rows (id, keep_id, size, digest) and, per group, how many are kept."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def check(got, rows):
    got = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in got}) == len(kept)
    assert all(r.doc_id == r.keep_id for r in kept)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.mark.parametrize("block_bytes", [2, 1024])
def test_same_texts_of_odd_rows(odd, block_bytes):
    short = odd.filter("text is null or length(text) < 40")
    check(block_naming.same_texts(short, block_bytes=block_bytes), pairs_of(short))


def test_clashing_columns_and_empty_table(spark, clashing, none):
    named = clashing.selectExpr("*", "1 as row", "2 as name", "3 as level", "4 as n", "5 as `keys`", "6 as `left`")
    check(block_naming.same_texts(named), pairs_of(clashing))
    assert block_naming.same_texts(none).count() == 0


def test_order_length_and_shared_blocks_tell_texts_apart(spark):
    texts = ["ab" * 3, "ab" * 4, "ab" * 5, "ba" * 4, "abba" * 2, "baab" * 2, "a" * 7, "a" * 8, "a" * 9, "abab", "ab", "a", ""]
    rows = list(enumerate(texts * 3)) + [(100, None), (100, None), (None, "ab"), (None, "only here"), (None, "only here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for block_bytes in (1, 3):
        check(block_naming.same_texts(docs, block_bytes=block_bytes), rows)


def test_blocks_that_share_a_key_are_told_apart(spark):
    """Keys of the first two seeds take few values; the third seed's are used."""

    def weak(block, seed):
        if seed >= 2:
            return block_naming.block_key(block, seed)
        few = F.pmod(F.xxhash64(F.lit(seed), block), F.lit(3))
        return F.struct(few.alias("a"), few.alias("b"))

    rows = [(i, f"text {i % 20} " * (i % 4 + 1)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(block_naming.same_texts(docs, block_bytes=8, keys=weak), rows)


def test_a_hot_group_and_long_texts(spark):
    long = "".join(f"line {i}\n" for i in range(20_000))
    rows = [(i, "the same notice for everyone " * 40) for i in range(2000)]
    rows += [(5000, long), (5001, long), (5002, long + "x"), (5003, "x" + long)]
    check(block_naming.same_texts(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "t"), ("a", "t"), ("c", "u")], "name string, body string")
    got = block_naming.same_texts(docs, "name", "body").collect()
    assert sorted((r.name, r.keep_id, r.kept) for r in got) == [("a", "b", False), ("b", "b", True), ("c", "c", True)]


def test_query_equals_its_sql(spark):
    assert differences(QUERIES["op11_block_naming"](spark, SF), oracle(SF), SQL["op11_block_naming"]) is None
