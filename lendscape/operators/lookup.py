"""Dimension lookups, orphan detection and grain-safe joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscape.operators.history import VALID_FROM, VALID_TO, stretch_of


def left_lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], take: Sequence[str]
) -> DataFrame:
    """Left equi-join taking columns from a right side that is unique on ``on``."""
    return left.join(right.select(*on, *take), list(on), "left")


def lookup_current(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    take: Mapping[str, str] | Sequence[str],
    current: str = "is_current",
) -> DataFrame:
    """Attach columns of the dimension's current version; facts without one keep NULLs.

    The version filter sits on the dimension side, hence reaches its scan. A fact key that
    holds a large share of the rows is split at run time: the fact is the preserved, splittable
    side of the join.
    """
    names = take if isinstance(take, Mapping) else {c: c for c in take}
    right = dim.filter(F.col(current)).select(
        F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(a) for c, a in names.items()]
    )
    return fact.join(right, F.col(fact_key) == F.col("_dim_key"), "left").drop("_dim_key")


def lookup_as_of(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    take: Mapping[str, str] | Sequence[str],
    stretch: str | int | None = None,
) -> DataFrame:
    """Attach columns of the version valid at the fact's moment: ``valid_from <= at < valid_to``.

    Facts and versions are united and ordered; a fact takes the last version before it. No range
    join meets every version of an applicant with every fact. No key is handled as a whole
    either: rows are windowed per (key, stretch of time), and one row per stretch that has a version
    carries the last one into the stretches after it.

    * ``versions`` hold ``key`` and half-open validity; of versions that begin together the
      one that ends last counts.
    * Facts before the first version, in a gap, or with NULL key or moment keep NULLs.
    """
    names = take if isinstance(take, Mapping) else {c: c for c in take}
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    end = F.col(VALID_TO)
    # An open version sorts behind one that has ended.
    order_end = F.struct(end.isNull(), end)
    version = F.struct(end.alias("_end"), *[F.col(c).alias(a) for c, a in names.items()])
    whole = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    facts = fact.filter(known).select(
        F.col(key).alias("_key"), F.col(at).cast(versions.schema[VALID_FROM].dataType).alias("_at"), whole.alias("_fact")
    )
    held = versions.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(VALID_FROM).alias("_at"), version.alias("_version"), order_end.alias("_order")
    )
    both = facts.unionByName(held, allowMissingColumns=True)
    both = both.withColumn("_chunk", stretch_of(both, "_at", stretch))
    is_fact = F.col("_fact").isNotNull()
    within = Window.partitionBy("_key", "_chunk").orderBy("_at", is_fact, "_order")
    inner = F.last("_version", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    last = (
        held.withColumn("_chunk", stretch_of(held, "_at", stretch))
        .groupBy("_key", "_chunk")
        .agg(F.max_by("_version", F.struct("_at", "_order")).alias("_last"))
    )
    # A row per stretch with facts and one per stretch with versions; the first take from the second.
    asked = facts.withColumn("_chunk", stretch_of(facts, "_at", stretch)).select("_key", "_chunk").distinct()
    stretches = asked.join(last, ["_key", "_chunk"], "full_outer")
    ahead = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.withColumn("_carried", F.last("_last", ignorenulls=True).over(ahead)).drop("_last")
    found = (
        both.withColumn("_inner", inner)
        .filter(is_fact)
        .join(carried, ["_key", "_chunk"], "left")
        .withColumn("_found", F.coalesce("_inner", "_carried"))
        .withColumn("_valid", F.col("_found._end").isNull() | (F.col("_at") < F.col("_found._end")))
        .select("_fact.*", *[F.when(F.col("_valid"), F.col(f"_found.{a}")).alias(a) for a in names.values()])
    )
    return found.unionByName(fact.filter(~known), allowMissingColumns=True)


def lookup_small(
    fact: DataFrame,
    dim: DataFrame,
    fact_col: str,
    dim_col: str,
    take: Mapping[str, str] | Sequence[str],
    bounded: bool = False,
) -> DataFrame:
    """Attach columns of a dimension that is expected to be small.

    It is always broadcast when it is ``bounded`` by construction, such as a fixed list of codes.
    Otherwise the join is left to adaptive execution, which broadcasts what it has measured to be
    small and splits the fact side of a shuffled join where a key is hot.
    """
    names = take if isinstance(take, Mapping) else {c: c for c in take}
    right = dim.select(
        F.col(dim_col).alias("_dim_key"), *[F.col(c).alias(a) for c, a in names.items()]
    )
    if bounded:
        right = F.broadcast(right)
    return fact.join(right, F.col(fact_col) == F.col("_dim_key"), "left").drop("_dim_key")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parents = parent.select(F.col(pk).alias("_parent_key"))
    return child.filter(F.col(fk).isNotNull()).join(
        parents, F.col(fk) == F.col("_parent_key"), "left_anti"
    )


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One row: orphan rows and checked rows.

    The child is counted per key before the join, so only distinct keys are shuffled.
    """
    per_key = (
        child.filter(F.col(fk).isNotNull())
        .groupBy(F.col(fk).alias("_child_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    parents = parent.filter(F.col(pk).isNotNull()).select(F.col(pk).alias("_parent_key")).distinct()
    joined = per_key.join(parents, F.col("_child_key") == F.col("_parent_key"), "left")
    return joined.agg(
        F.coalesce(
            F.sum(F.when(F.col("_parent_key").isNull(), F.col("_rows"))), F.lit(0).cast("long")
        ).alias("orphan_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0).cast("long")).alias("checked_rows"),
    )


def star(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, Sequence[str]]]
) -> DataFrame:
    """Join a fact with several ``(dimension, fact column, key, columns)`` lookups."""
    return reduce(lambda acc, d: lookup_small(acc, d[0], d[1], d[2], d[3]), dims, fact)
