"""Latest row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_latest_rank"


def row_tiebreak(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """A reproducible order among rows that tie: the hash of their remaining columns."""
    rest = [c for c in df.columns if c not in exclude]
    return [F.xxhash64(*rest)] if rest else []


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Column | str,
    tiebreak: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order`` per key.

    Rows that tie on ``order`` are decided by ``tiebreak`` (default: a hash of all other
    columns), so the result does not depend on how rows were distributed. ``row_number() = 1`` is planned
    with a per-task limit ahead of the shuffle: a key holding a third of all rows sends one
    row per task.
    """
    order_column = F.col(order) if isinstance(order, str) else order
    if tiebreak is None:
        known = [*keys, order] if isinstance(order, str) else list(keys)
        tiebreak = row_tiebreak(df, known)
    w = Window.partitionBy(*keys).orderBy(order_column.desc(), *tiebreak)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)
