"""Keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    within: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Source rows replace target rows with the same key; other target rows stay.

    * No target yet: the source, whose keys are checked all the same.
    * A key occurring twice in the source fails the job, also where no target row has it. This
      is stricter than SQL MERGE, which fails on a double match only; here a source is checked
      alike on its first day and on any later one.
    * NULL keys match nothing and are inserted, as in SQL MERGE.
    * Both sides must have the same columns.
    * ``within`` names columns that follow from the key, by which rows are placed already, or
      are placed here into ``parts`` partitions.

    Each side is evaluated and shuffled once: rows of a key are ordered source first, and the
    first is kept. The order also puts a repeated source key next to itself. Rows with NULL keys
    are spread by their other columns.
    """
    new = source.withColumn("_new", F.lit(1))
    rows = new if target is None else target.withColumn("_new", F.lit(0)).unionByName(new)
    if parts is not None:
        rows = rows.repartition(parts, *within)
    spread = F.when(any_null(keys), F.xxhash64(*source.columns)).otherwise(F.lit(0))
    order = Window.partitionBy(*within, *keys, spread).orderBy(F.desc("_new"))
    ranked = rows.withColumns(
        {"_place": F.row_number().over(order), "_before": F.lag("_new").over(order)}
    )
    twice = (F.col("_new") == 1) & (F.col("_before") == 1)
    keep = (
        F.when(any_null(keys), F.lit(True))
        .when(twice, F.raise_error(F.lit(f"upsert source repeats a key of {list(keys)}")).cast("boolean"))
        .otherwise(F.col("_place") == 1)
    )
    return ranked.filter(keep).select(*source.columns)
