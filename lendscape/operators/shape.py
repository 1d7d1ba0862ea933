"""Column subsets, cleaning, masking, typed renames, lineage stamps and row routing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date as Date
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscape.functions import keyed_mask, mask, sentinel_to_null


def select_existing(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """The keep-list columns that exist, in keep-list order; absent ones are skipped."""
    present = set(df.columns)
    return df.select(*[c for c in keep if c in present])


def null_sentinels(
    df: DataFrame, sentinels: Mapping[str, Any], flag_suffix: str | None = None
) -> DataFrame:
    """Replace sentinel values by NULL; optionally keep a flag saying where that happened."""
    present = {c: v for c, v in sentinels.items() if c in df.columns}
    changes = {c: sentinel_to_null(c, v) for c, v in present.items()}
    if flag_suffix is not None:
        for c, v in present.items():
            changes[c + flag_suffix] = F.coalesce(F.col(c) == F.lit(v), F.lit(False))
    return df.withColumns(changes)


def mask_columns(
    df: DataFrame,
    columns: Iterable[str],
    suffix: str = "_MASKED",
    salt: str | None = None,
    key: bytes | None = None,
) -> DataFrame:
    """Add a digest per personal column, keyed where a key is given, and drop the originals."""
    present = [c for c in columns if c in df.columns]
    digest = lambda c: mask(c, salt=salt) if key is None else keyed_mask(c, key)
    return df.withColumns({c + suffix: digest(c) for c in present}).drop(*present)


def conform(df: DataFrame, mapping: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Project ``(source, alias, type)`` triples; a value that does not fit its type is an error."""
    return df.select(*[F.col(src).cast(kind).alias(alias) for src, alias, kind in mapping])


def stamp(
    df: DataFrame,
    run_ts: datetime | Column,
    ingestion_date: Date,
    batch_id: str | None = None,
    env: str | None = None,
) -> DataFrame:
    """Lineage columns from the caller's run time, so a re-run writes identical rows."""
    moment = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    columns = {"ingestion_ts": moment, "ingestion_date": F.lit(ingestion_date)}
    if batch_id is not None:
        columns["batch_id"] = F.lit(batch_id)
    if env is not None:
        columns["env"] = F.lit(env)
    return df.withColumns(columns)


def sample_first(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows by an explicit order (planned as a per-task top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that evaluates to NULL is not broken."""
    named = [F.when(rule, F.lit(name)) for name, rule in rules.items()]
    return F.array_except(F.array(*named), F.array(F.lit(None).cast("string")))


def flag_broken(df: DataFrame, rules: Mapping[str, Column], column: str = "reasons") -> DataFrame:
    """Add the list of broken rules to every row."""
    return df.withColumn(column, broken_rules(rules))


def split_quarantine(
    df: DataFrame, rules: Mapping[str, Column], column: str = "reasons"
) -> tuple[DataFrame, DataFrame]:
    """Rows breaking no rule, and the others with their reasons.

    Both results read ``df``; to store both in one pass use
    :func:`lendscape.sources.landing.ingest`, which writes them as two partitions of one job.
    """
    flagged = flag_broken(df, rules, column)
    return (
        flagged.filter(F.size(column) == 0).drop(column),
        flagged.filter(F.size(column) > 0),
    )
