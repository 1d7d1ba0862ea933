"""Type-1 dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.functions import surrogate_key


def inline(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant relation."""
    return spark.createDataFrame(list(rows), schema)


def dim_from_distinct(
    df: DataFrame, col: str, run_ts: datetime | Column, sk: str, name: str
) -> DataFrame:
    """One row per distinct non-NULL value, rebuilt in full."""
    values = df.filter(F.col(col).isNotNull()).select(F.col(col).alias(name)).distinct()
    return _keyed(values, name, run_ts, sk)


def dim_static(
    spark: SparkSession,
    rows: Sequence[tuple],
    columns: Sequence[str],
    run_ts: datetime | Column,
    sk: str,
) -> DataFrame:
    """Dimension over fixed rows; its key is the first column."""
    schema = ", ".join(f"{c} string" for c in columns)
    return _keyed(inline(spark, rows, schema), columns[0], run_ts, sk)


def _keyed(df: DataFrame, key: str, run_ts: datetime | Column, sk: str) -> DataFrame:
    updated = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.select(surrogate_key(key).alias(sk), *df.columns, updated.alias("updated_at"))
