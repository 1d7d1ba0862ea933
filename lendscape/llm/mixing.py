"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

Leaves are (domain, language, source). A token budget goes down the tree: each node's share is
split among its children by weight, no child getting more than its leaves can give in
``epochs`` passes; what a child cannot take goes to its siblings first, and only what a whole
subtree cannot take stays with the siblings of its ancestors. A leaf reads its documents in
seeded orders, one per epoch: its budget is a number of whole epochs and a prefix of the tokens
of the next one, the last document of which may be taken in part.

The order of an epoch is that of a hash, so a prefix is found without sorting a leaf: tokens are
added up per leaf and hash bin, and only documents of the bin holding the prefix's end are
ordered. One row per leaf then decides every document by comparison.

All splitting is in whole numbers and leaves less than one token per child unspent.

* NULL domain, language or source reads as the empty name; weights not named are 1.
* NULL or empty text: no tokens, taken in no whole epoch that its leaf does not have.
* Rows of one id stand together in an epoch's order, fewer tokens first; a prefix may end among
  them, even among rows with equal id and tokens, which are numbered for it in any order. NULL ids
  are ordered by a digest of their text. The budget is kept in every case.
* An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

LEVELS = ("domain", "lang", "source")
BUDGET_PERCENT = 80
EPOCHS = 3
SEED = 20
BINS = 4096
# Parts of a leaf's rows when they meet its plan: a leaf may hold a third of all rows.
LEAF_PARTS = 64
WEIGHTS: Mapping[str, Mapping[str, int]] = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 4, "de": 3, "fr": 3, "es": 2},
    "source": {},
}
WORD = r"[^\x20\x09-\x0D]+"


def domain_of(source: Column) -> Column:
    """Domain of a test source: its number modulo four; sources without a number are domain0."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]+)$", 1).try_cast("long"), F.lit(0))
    return F.concat(F.lit("domain"), (number % 4).cast("string"))


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(seed: int, epoch: Column, key: Column) -> Column:
    """32-bit place of a document in an epoch's order."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _div(a: Column, b: Column) -> Column:
    """Whole-number division."""
    return F.call_function("div", a, b)


def split(children: DataFrame, parent: tuple[str, ...], name: str) -> DataFrame:
    """Adds ``share``: of each parent's ``budget``, by ``weight``, at most ``cap``."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("cap") / F.col("weight"), name)
    ahead, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(ahead), F.lit(0))
    fits = (F.col("cap") * F.sum("weight").over(behind) <= F.col("weight") * left).cast("int")
    filled = children.withColumn("_fits", fits).withColumn("_full", F.min("_fits").over(upto) == 1)
    spent = F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(by), F.lit(0))
    open_ = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(by)
    share = F.when(F.col("_full"), F.col("cap")).otherwise(
        _div((F.col("budget") - spent) * F.col("weight"), open_)
    )
    return filled.withColumn("share", share.cast("long")).drop("_fits", "_full")


def leaf_budgets(
    leaves: DataFrame,
    levels: tuple[str, ...] = LEVELS,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Budget per leaf from rows of (levels, tokens)."""
    total = leaves.agg(_div(F.sum("tokens") * percent, F.lit(100)).alias("budget"))
    above = total
    for depth, level in enumerate(levels):
        keys = levels[: depth + 1]
        nodes = leaves.groupBy(*keys).agg((F.sum("tokens") * epochs).alias("cap"))
        nodes = nodes.withColumn("weight", weight(level, weights))
        # The root is a single row; below it, every node has one parent row.
        joined = nodes.join(above, list(levels[:depth])) if depth else nodes.join(F.broadcast(above))
        above = split(joined, levels[:depth], level).select(*keys, F.col("share").alias("budget"))
    return above


def order_key(id_col: str, text: str) -> Column:
    """Id as text; of NULL ids a digest of the document."""
    digest = F.concat(F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.coalesce(F.col(id_col).cast("string"), digest)


def placed(docs: DataFrame, domain: Column, id_col: str, lang: str, source: str, text: str) -> DataFrame:
    """Id, leaf, order key and tokens of every document."""
    return docs.select(
        F.col(id_col).alias("_id"),
        order_key(id_col, text).alias("_key"),
        F.coalesce(domain, F.lit("")).alias("domain"),
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        n_tokens(F.col(text)).alias("n_tokens"),
    )


def with_leaf(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Join rows with one row per leaf, the rows of a leaf dealt out over parts."""
    part = F.pmod(F.monotonically_increasing_id(), F.lit(LEAF_PARTS)).cast("int")
    each = leaves.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(LEAF_PARTS - 1))))
    return rows.withColumn("_part", part).join(each, [*LEVELS, "_part"]).drop("_part")


def plan(rows: DataFrame, seed: int = SEED, bins: int = BINS, **options) -> DataFrame:
    """One row per leaf: whole epochs, and where the prefix of the next one ends.

    Its end is a place in the order (hash, key, tokens), the rows at this place that are taken as
    a whole, and the tokens taken of one more.
    """
    leaf = list(LEVELS)
    leaves = A.staged(rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    budgets = leaves.join(leaf_budgets(leaves, **options), leaf)
    some = F.col("tokens") > 0
    budgets = A.staged(
        budgets.withColumns(
            {
                "whole": F.when(some, _div(F.col("budget"), F.col("tokens"))).otherwise(0).cast("long"),
                "rest": F.when(some, F.col("budget") % F.col("tokens")).otherwise(0).cast("long"),
            }
        ),
        "budgets",
    )
    hashed = with_leaf(rows, budgets).withColumn("_hash", order_hash(seed, F.col("whole"), F.col("_key")))
    bin_of = F.floor(F.col("_hash") * bins / F.lit(1 << 32)).cast("int")
    before = Window.partitionBy(*leaf).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    binned = (
        hashed.groupBy(*leaf, "rest", bin_of.alias("_bin"))
        .agg(F.sum("n_tokens").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .filter((F.col("_before") < F.col("rest")) & (F.col("rest") <= F.col("_before") + F.col("_n")))
        .select(*leaf, "_bin", "_before")
    )
    # Stored, for else the documents would be dealt out by leaf to meet this window's rows.
    binned = A.staged(binned, "bins")
    within = Window.partitionBy(*leaf, "_bin").orderBy("_hash", "_key", "n_tokens")
    ahead = F.sum(F.col("n_tokens") * F.col("_rows")).over(within.rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("rest") - F.col("_ahead")
    ended = (
        hashed.withColumn("_bin", bin_of)
        .join(binned, [*leaf, "_bin"])
        # Rows of one place are counted first: a repeated document is one row here.
        .groupBy(*leaf, "_bin", "_before", "rest", "_hash", "_key", "n_tokens")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_ahead", F.col("_before") + F.coalesce(ahead, F.lit(0)))
        .filter((left > 0) & (left <= F.col("n_tokens") * F.col("_rows")))
        .select(
            *leaf,
            F.col("_hash").alias("cut_hash"),
            F.col("_key").alias("cut_key"),
            F.col("n_tokens").alias("cut_tokens"),
            _div(left, F.col("n_tokens")).alias("cut_rows"),
            (left % F.col("n_tokens")).alias("cut_part"),
            F.col("_rows").alias("cut_of"),
        )
    )
    return A.staged(budgets.join(ended, leaf, "left"), "leaf_plan")


def numbered(rows: DataFrame, by: list[str], parts: int = LEAF_PARTS) -> DataFrame:
    """Adds ``_index`` from 1 within ``by``, in any order; a large group is numbered in parts."""
    row, part = F.monotonically_increasing_id(), F.pmod(F.xxhash64("_row"), F.lit(parts))
    rows = A.staged(rows.withColumn("_row", row).withColumn("_part", part), "numbered")
    ahead = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    inner = F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_row"))
    joined = rows.withColumn("_inner", inner).join(sizes, [*by, "_part"])
    return joined.withColumn("_index", F.col("_before") + F.col("_inner")).drop("_row", "_part", "_before", "_inner")


def decide(
    rows: DataFrame, leaf_plan: DataFrame, seed: int = SEED, tokens: Column | None = None
) -> DataFrame:
    """Adds ``copies`` (epochs a document appears in, a partial one included) and
    ``tokens_taken``.

    Rows at the place where a prefix ends are numbered only if some leaf has several there. The
    tokens, ``n_tokens`` unless given, are compared last, so they are seldom computed.
    """
    tokens = F.col("n_tokens") if tokens is None else tokens
    joined = with_leaf(rows, leaf_plan).withColumn(
        "_hash", order_hash(seed, F.col("whole"), F.col("_key"))
    )
    hash_, key, ended = F.col("_hash"), F.col("_key"), F.col("cut_hash").isNotNull()
    at_cut = ended & (hash_ == F.col("cut_hash")) & (key == F.col("cut_key")) & (tokens == F.col("cut_tokens"))
    ahead = ended & F.when(hash_ != F.col("cut_hash"), hash_ < F.col("cut_hash")).when(
        key != F.col("cut_key"), key < F.col("cut_key")
    ).otherwise(tokens < F.col("cut_tokens"))

    def taken(df: DataFrame, at: Column, index: Column) -> DataFrame:
        whole = ahead | (at & (index <= F.col("cut_rows")))
        part = F.when(at & (index == F.col("cut_rows") + 1), F.col("cut_part")).otherwise(F.lit(0))
        return df.withColumns(
            {
                "copies": F.col("whole") + (whole | (part > 0)).cast("long"),
                "tokens_taken": F.col("whole") * tokens + F.when(whole, tokens).otherwise(part).cast("long"),
            }
        )

    if leaf_plan.filter("cut_of > 1").isEmpty():
        return taken(joined, at_cut, F.lit(1))
    others = taken(joined.filter(~at_cut), F.lit(False), F.lit(0))
    ties = numbered(joined.filter(at_cut), list(LEVELS))
    return others.unionByName(taken(ties, F.lit(True), F.col("_index")).drop("_index"))


def mix(
    docs: DataFrame,
    domain: Column,
    id_col: str = "doc_id",
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    seed: int = SEED,
    **options,
) -> DataFrame:
    """Per document: leaf, tokens, copies and tokens taken."""
    rows = A.staged(placed(docs, domain, id_col, lang, source, text), "placed")
    out = decide(rows, plan(rows, seed, **options), seed)
    return out.select(
        F.col("_id").alias(id_col),
        *LEVELS,
        "n_tokens",
        "copies",
        "tokens_taken",
    )


def resample(docs: DataFrame, domain: Column, seed: int = SEED, **options) -> DataFrame:
    """The documents themselves, a row per epoch they appear in; their own columns only."""
    rows = A.staged(placed(docs, domain, "doc_id", "lang", "source", "text"), "placed")
    leaf_plan = plan(rows, seed, **options)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        order_key("doc_id", "text").alias("_key"),
        F.coalesce(domain, F.lit("")).alias("domain"),
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
    )
    chosen = decide(keyed, leaf_plan, seed, n_tokens(F.col("_doc.text"))).filter(F.col("copies") > 0)
    return chosen.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_doc.*")


def _cases(level: str, weights: Mapping[str, int]) -> str:
    names = "".join(f" WHEN '{k}' THEN {w}" for k, w in weights.items())
    return f"CASE {level}{names} ELSE 1 END" if names else "1"


def oracle_sql() -> str:
    """The same mixture in plain SQL: every leaf ordered as a whole, no bins."""

    def level(depth: int) -> str:
        keys, parent = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        name = LEVELS[depth]
        by = f"PARTITION BY {parent}" if depth else ""
        over = f"({by} ORDER BY cap / weight, {name} ROWS BETWEEN"
        join = f"JOIN b{depth - 1} USING ({parent})" if depth else "CROSS JOIN total"
        return f"""
n{depth} AS (SELECT {keys}, CAST(sum(tokens) * {EPOCHS} AS BIGINT) cap, {_cases(name, WEIGHTS.get(name, {}))} weight
  FROM leaves GROUP BY {keys}),
f{depth} AS (SELECT *, cap * sum(weight) OVER {over} CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (budget - coalesce(sum(cap) OVER {over} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) fits
  FROM n{depth} {join}),
g{depth} AS (SELECT *, bool_and(fits) OVER {over} UNBOUNDED PRECEDING AND CURRENT ROW) full_ FROM f{depth}),
h{depth} AS (SELECT *, coalesce(sum(cap) FILTER (full_) OVER ({by}), 0) spent,
    sum(weight) FILTER (NOT full_) OVER ({by}) open_ FROM g{depth}),
b{depth} AS (SELECT {keys}, CAST(CASE WHEN full_ THEN cap ELSE ((budget - spent) * weight) // open_ END AS BIGINT) budget
  FROM h{depth})"""

    leaf = ", ".join(LEVELS)
    return f"""
WITH placed AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), ':' || md5(coalesce(text, ''))) k,
    'domain' || coalesce(TRY_CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT), 0) % 4 AS domain,
    coalesce(lang, '') lang, coalesce(source, '') source,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) n_tokens
  FROM documents),
leaves AS (SELECT {leaf}, CAST(sum(n_tokens) AS BIGINT) tokens FROM placed GROUP BY {leaf}),
total AS (SELECT CAST(sum(tokens) * {BUDGET_PERCENT} // 100 AS BIGINT) budget FROM leaves),
{",".join(level(d) for d in range(len(LEVELS)))},
budgets AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END whole,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END rest
  FROM leaves JOIN b{len(LEVELS) - 1} USING ({leaf})),
hashed AS (SELECT *, CAST('0x' || substr(md5('{SEED}:' || whole || ':' || k), 1, 8) AS BIGINT) h
  FROM placed JOIN budgets USING ({leaf})),
ordered AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY {leaf} ORDER BY h, k, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ahead FROM hashed)
SELECT doc_id, {leaf}, n_tokens,
  CAST(whole + CASE WHEN ahead < rest THEN 1 ELSE 0 END AS BIGINT) copies,
  CAST(whole * n_tokens + CASE WHEN ahead < rest THEN least(n_tokens, rest - ahead) ELSE 0 END AS BIGINT) tokens_taken
FROM ordered
"""
