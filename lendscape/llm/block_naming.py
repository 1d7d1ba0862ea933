"""Exact deduplication by deterministic block naming, in DataFrame functions only.

A text is cut into blocks of ``BLOCK_BYTES``. Distinct blocks are sorted and numbered: equal
blocks get one integer name, different blocks different ones. Then names of adjacent blocks are
paired, the distinct pairs are sorted and numbered in turn, and so on; an odd name at the end is
paired with nothing. After as many rounds as the logarithm of its blocks a text has one name.
Name and number of rounds are its identity: by induction two texts share it if and only if they
are equal byte by byte. Names are never hashes.

Work and distribution:

* Equal blocks are combined before they are shuffled, and the bytes are shuffled once, for
  sorting. A document keeps only keys of its blocks (two 64-bit hashes). They find the block's
  name in place of its bytes, and only after it was checked that no two distinct blocks of the
  corpus share a key; otherwise the keys are drawn again with another seed. Results therefore
  do not rest on hashes being free of collisions.
* Rounds work on integers, half as many each time, and are dealt out by (row, position): a very
  long text is spread over all tasks. A frequent pair is combined before the shuffle that names
  it; the join that brings names back has stored inputs on both sides, so that adaptive
  execution splits a key with many rows.
* Every round is written to the shared checkpoint folder, which also cuts lineage. The driver
  sees one number, the largest count of blocks.

* NULL text counts as the empty text, which is one empty block.
* Equal ids: the row kept is the one with the largest id, and one of these rows if several have
  it. NULL ids are smaller than others; a group of NULL ids only has ``keep_id`` NULL.
* An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

BLOCK_BYTES = 1024
_NOTHING = -1  # stands right of an odd last name; names are not negative


def block_count(size: Column, block_bytes: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / F.lit(block_bytes)).cast("int"))


def each_block(text: Column, block_bytes: int, fn) -> Column:
    """Array of ``fn(block)``. Cut from bytes, for a place in characters is found by counting."""
    data = text.cast("binary")
    places = F.sequence(F.lit(0), block_count(F.octet_length(data), block_bytes) - 1)
    return F.transform(places, lambda i: fn(F.substring(data, i * block_bytes + 1, F.lit(block_bytes))))


def block_key(block: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(F.lit(seed), block).alias("a"), F.xxhash64(block, F.lit(seed)).alias("b")
    )


def numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Adds ``name``: the place in sorted order within a task, and the task's number in front.

    Rows are distinct, so the order is a total one and a repeated task gives the same names.
    """
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def first_names(texts: DataFrame, block_bytes: int, keys=block_key) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, text_sha256, n, keys) per document, and (key, name) per distinct block.

    ``texts`` has doc_id and text.
    """
    for seed in count():
        by_key = lambda block: F.struct(keys(block, seed).alias("key"), block.alias("block"))
        blocks = texts.select(F.inline(each_block(F.col("text"), block_bytes, by_key))).distinct()
        names = (
            numbered(blocks, "block")
            .groupBy("key")
            .agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("n_blocks"))
        )
        names = A.staged(names, "block_names")
        if names.filter("n_blocks > 1").isEmpty():
            break
    rows = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        block_count(F.octet_length("text"), block_bytes).alias("n"),
        each_block(F.col("text"), block_bytes, lambda block: keys(block, seed)).alias("keys"),
    )
    return A.staged(rows, "rows"), names.select("key", "name")


def next_names(named: DataFrame) -> DataFrame:
    """Names of adjacent pairs from (row, n, pos, name) of texts with more than one name."""
    side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
    pairs = (
        named.groupBy("row", "n", F.shiftright("pos", 1).alias("at"))
        .agg(side(0).alias("left"), F.coalesce(side(1), F.lit(_NOTHING)).alias("right"))
        .select("row", F.shiftright(F.col("n") + 1, 1).alias("n"), F.col("at").alias("pos"), "left", "right")
    )
    pairs = A.staged(pairs, "pairs")
    names = A.staged(numbered(pairs.select("left", "right").distinct(), "left", "right"), "pair_names")
    return pairs.join(names, ["left", "right"]).select("row", "n", "pos", "name")


def identities(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row, level, name): each document's one name and the round that gave it."""
    occurring = rows.select("row", "n", F.posexplode("keys").alias("pos", "key"))
    named = A.staged(occurring.join(names, "key").select("row", "n", "pos", "name"), "names")
    most = rows.agg(F.max("n")).first()[0] or 1
    out = named.filter("n = 1").select("row", F.lit(0).alias("level"), "name")
    for level in range(1, (most - 1).bit_length() + 1):
        named = A.staged(next_names(named.filter("n > 1")), "names")
        out = out.unionByName(named.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
    return out


def same_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    keys=block_key,
) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, names = first_names(texts, block_bytes, keys)
    members = rows.drop("n", "keys").join(identities(rows, names), "row")
    members = A.staged(members, "members")
    groups = members.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size")
    )
    return members.join(A.staged(groups, "groups"), ["level", "name"]).select(
        F.col("doc_id").alias(id_col),
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        "text_sha256",
    )


def oracle_sql() -> str:
    return """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""
