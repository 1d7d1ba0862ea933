"""Daily partial results that add up to any period without reading the facts again.

A day's partials are one row per segment: counts and exact totals, an HLL sketch of the
applicants and a KLL sketch of the amounts. Counts and totals of a period are exact; sketches
merge into the sketch that the whole period's rows would give, within its error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscape.functions import percent, safe_ratio
from lendscape.operators.kpi import exact_sum

DAY = "day"
# 2**14 registers: a standard error of 0.8 percent of the distinct count.
HLL_LG_K = 14
# A normalised rank error of about 0.7 percent.
KLL_K = 400


def daily_partials(
    fact: DataFrame,
    day: str,
    by: Sequence[str],
    amount: str = "amt_credit",
    target: str = "target_flag",
    applicant: str = "sk_id_curr",
) -> DataFrame:
    """Partials per day and segment; one aggregation, combined ahead of its shuffle."""
    return fact.groupBy(F.col(day).cast("date").cast("string").alias(DAY), *by).agg(
        F.count(F.lit(1)).alias("applications"),
        F.count_if(F.col(target) == 1).alias("defaults"),
        exact_sum(amount).alias("amount"),
        F.count(amount).alias("amounts"),
        F.hll_sketch_agg(applicant, HLL_LG_K).alias("applicants"),
        F.kll_sketch_agg_double(F.col(amount).cast("double"), KLL_K).alias("distribution"),
    )


def rolled_up(parts: DataFrame, by: Sequence[str], unit: str | None = None) -> DataFrame:
    """Partials of a period per segment; ``unit`` is week, month and so on, None all days."""
    start = [] if unit is None else [F.trunc(F.col(DAY).cast("date"), unit).alias("period")]
    return parts.groupBy(*start, *by).agg(
        F.sum("applications").alias("applications"),
        F.sum("defaults").alias("defaults"),
        F.sum("amount").alias("amount"),
        F.sum("amounts").alias("amounts"),
        F.hll_union_agg("applicants").alias("applicants"),
        F.kll_merge_agg_double("distribution", KLL_K).alias("distribution"),
    )


def indicators(parts: DataFrame) -> DataFrame:
    """Indicators of rolled-up partials, with the applicants estimated."""
    return parts.select(
        *[c for c in parts.columns if c not in ("amount", "amounts", "applicants", "distribution")],
        percent(F.col("defaults"), F.col("applications")).alias("default_rate_pct"),
        safe_ratio(F.col("amount").cast("double"), "amounts").alias("avg_credit_amount"),
        F.hll_sketch_estimate("applicants").alias("applicants"),
    )


def quantile(sketch: Column | str, p: float) -> Column:
    """A value whose rank is near ``p``; NULL where there was no amount."""
    column = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.when(F.kll_sketch_get_n_double(column) > 0, F.kll_sketch_get_quantile_double(column, F.lit(float(p))))
