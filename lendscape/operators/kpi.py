"""Credit-risk indicators.

Facts are reduced to the finest requested grain once; totals and segment combinations are
then built from that small result, so the fact is never multiplied by grouping sets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.functions import bracket, percent, safe_ratio

ALL = "ALL"

# Amounts are added up to a decimal: a sum of doubles depends on the order in which tasks deliver,
# so a repeated run would not give the same total. A double holds any decimal number of fifteen
# digits; what it holds beyond them, or beyond twelve decimals, is rounded away row by row.
_MILLION = 1_000_000
_PLACES = 12


def exact_sum(amount: Column | str) -> Column:
    """Sum of amounts as a decimal with twelve places, the same in any order of the rows.

    Three whole numbers are added up per group, which stays in generated code: the whole part, and
    millionths and their millionths of the rest. They become one decimal once per group. Sums
    beyond 64 bits raise. NULL amounts are left out; without others the sum is NULL.
    """
    value = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    whole = value.cast("bigint")  # towards zero; an amount beyond 64 bits raises
    # Decimals that fifteen digits leave: twelve below a thousand, eleven below ten thousand, ...
    unit = F.when(F.abs(value) < 1000, F.lit(10**_PLACES))
    for kept in range(_PLACES - 1, 0, -1):
        unit = unit.when(F.abs(value) < F.lit(float(10 ** (15 - kept))), F.lit(10**kept))
    unit = unit.otherwise(F.lit(1)).cast("bigint")
    rest = F.call_function("div", F.lit(10**_PLACES), unit)
    places = F.round((value - whole) * unit).cast("bigint") * rest
    micro = F.call_function("div", places, F.lit(_MILLION))
    total = lambda c, kind: F.sum(c).cast(kind)
    return (
        total(whole, "decimal(31,12)")
        + total(micro, "decimal(20,0)") * F.lit(Decimal("0.000001"))
        + total(places % _MILLION, "decimal(20,0)") * F.lit(Decimal("0.000000000001"))
    ).cast("decimal(38,12)")


def exact_avg(amount: Column | str) -> Column:
    """Average from the exact sum; NULL without amounts."""
    return safe_ratio(exact_sum(amount).cast("double"), F.count(amount))


def _sum_back(names: Sequence[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def default_rate(
    fact: DataFrame, by: Sequence[str], target: str = "target_flag", totals: bool = True
) -> DataFrame:
    """Applications, defaults and default rate in percent per segment, with roll-up totals.

    ``grouping_level`` is 0 for the finest rows and all ones in binary for the grand total.
    """
    fine = fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("applications"), F.count_if(F.col(target) == 1).alias("defaults")
    )
    if totals:
        fine = fine.rollup(*by).agg(
            F.grouping_id().cast("long").alias("grouping_level"),
            *_sum_back(["applications", "defaults"]),
        )
    return fine.withColumn(
        "default_rate_pct", percent(F.col("defaults"), F.col("applications"))
    )


def segment_default_rates(
    fact: DataFrame, segments: Sequence[str], target: str = "target_flag"
) -> DataFrame:
    """Default rate per value of each segment on its own, and overall."""
    fine = fact.groupBy(*segments).agg(
        F.count(F.lit(1)).alias("applications"), F.count_if(F.col(target) == 1).alias("defaults")
    )
    sets = [[F.col(s)] for s in segments] + [[]]
    rolled = fine.groupingSets(sets, *segments).agg(
        F.grouping_id().cast("long").alias("grouping_level"),
        *_sum_back(["applications", "defaults"]),
    )
    return rolled.withColumn(
        "default_rate_pct", percent(F.col("defaults"), F.col("applications"))
    )


def average_credit(fact: DataFrame, by: Sequence[str], amount: str = "amt_credit") -> DataFrame:
    return fact.groupBy(*by).agg(exact_avg(amount).alias("avg_credit_amount"))


def exposure(
    fact: DataFrame, by: Sequence[str] = ("sk_id_curr",), amount: str = "amt_credit_sum"
) -> DataFrame:
    """Total bureau credit per applicant."""
    return fact.groupBy(*by).agg(exact_sum(amount).cast("double").alias("bureau_exposure"))


def overdue_rate(
    fact: DataFrame, by: Sequence[str] = (), days: str = "credit_day_overdue"
) -> DataFrame:
    """Percentage of bureau records with days overdue."""
    counted = fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("bureau_records"), F.count_if(F.col(days) > 0).alias("overdue")
    )
    return counted.withColumn(
        "overdue_rate_pct", percent(F.col("overdue"), F.col("bureau_records"))
    )


def income_credit_ratio(
    fact: DataFrame,
    by: Sequence[str],
    income: str = "amt_income_total",
    credit: str = "amt_credit",
) -> DataFrame:
    """Average of the row-level ratio; rows without credit are left out of the average."""
    return fact.groupBy(*by).agg(exact_avg(safe_ratio(income, credit)).alias("income_to_credit_ratio"))


def punctuality(
    fact: DataFrame, by: Sequence[str] = (), diff: str = "days_payment_diff"
) -> DataFrame:
    """Average days between due and paid; positive is late, unpaid rows are left out."""
    return fact.groupBy(*by).agg(exact_avg(diff).alias("avg_days_payment_diff"))


def masked_presence(
    df: DataFrame, masked: str, income: str, edges: Sequence[float]
) -> DataFrame:
    """Share of rows having a masked value, per income bracket.

    Digests carry no magnitude, so presence is the only statistic they allow.
    """
    counted = df.groupBy(bracket(income, edges).alias("income_bracket")).agg(
        F.count(F.lit(1)).alias("rows_total"), F.count(masked).alias("rows_masked")
    )
    return counted.withColumn(
        "masked_presence_pct", percent(F.col("rows_masked"), F.col("rows_total"))
    )


def per_period(df: DataFrame, column: str, unit: str, alias: str = "period") -> DataFrame:
    """Add the first day of the row's day, week or month, for use as a KPI segment."""
    start = F.col(column).cast("date") if unit == "day" else F.trunc(column, unit)
    return df.withColumn(alias, start)


def histogram(df: DataFrame, value: str, by: Sequence[str], width: float) -> DataFrame:
    """Rows per fixed-width slot of the value."""
    lower = F.floor(F.col(value) / F.lit(float(width))).cast("double") * F.lit(float(width))
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, lower.alias("slot_from"))
        .agg(F.count(F.lit(1)).alias("rows_in_slot"))
    )


# Slots per group when running totals over slots are taken; groups are added up first.
SLOTS_PER_GROUP = 1024


def exact_quantiles(
    df: DataFrame, value: str, by: Sequence[str], probabilities: Sequence[float], width: float
) -> DataFrame:
    """Exact interpolated quantiles without sorting a segment in one task.

    First pass: rows are counted per fixed-width slot, and running totals over the slots locate
    those holding the wanted ranks. Second pass: only rows of these slots are grouped by value
    and ranked. ``width`` bounds the distinct values per slot; running totals go over groups of
    slots and then within a group, so without segments no task sees all slots either.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        *by, F.col(value).alias("_v"), F.floor(F.col(value) / F.lit(float(width))).alias("_slot")
    )
    slots = rows.groupBy(*by, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    located = _located(slots, by) if by else _located_overall(slots)
    position = F.col("quantile") * (F.col("_total") - 1)
    wanted = (
        located
        .withColumn("quantile", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumns({"_lo": F.floor(position), "_hi": F.ceil(position)})
        .withColumn("_share", position - F.col("_lo"))
        .filter((F.col("_lo") < F.col("_before") + F.col("_n")) & (F.col("_hi") >= F.col("_before")))
        .select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.col("_slot").alias("_s"),
            *("quantile", "_before", "_lo", "_hi", "_share"),
        )
    )
    same_slot = reduce(lambda a, b: a & b, same, F.col("_slot") == F.col("_s"))
    chosen = wanted.select(*[f"_by_{c}" for c in by], "_s").distinct()
    counts = (
        rows.join(chosen, same_slot, "left_semi")
        .groupBy(*by, "_slot", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    running = Window.partitionBy(*by, "_slot", "quantile").orderBy("_v")
    ranked = (
        counts.join(wanted, same_slot)
        .withColumn("_end", F.col("_before") + F.sum("_n").over(running))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at(rank: str) -> Column:
        inside = (F.col(rank) >= F.col("_start")) & (F.col(rank) < F.col("_end"))
        return F.max(F.when(inside, F.col("_v")))

    return (
        ranked.groupBy(*by, "quantile")
        .agg(at("_lo").alias("_low"), at("_hi").alias("_high"), F.max("_share").alias("_share"))
        .select(
            *by,
            "quantile",
            (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias(value),
        )
    )


_AHEAD = (Window.unboundedPreceding, -1)


def _located(slots: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows before each slot of its segment, and rows of the segment."""
    segment = Window.partitionBy(*by)
    before = F.sum("_n").over(segment.orderBy("_slot").rowsBetween(*_AHEAD))
    return slots.withColumns(
        {"_before": F.coalesce(before, F.lit(0)), "_total": F.sum("_n").over(segment)}
    )


def _located_overall(slots: DataFrame) -> DataFrame:
    """The same without segments: totals go over groups of slots, then within a group."""
    grouped = slots.withColumn("_group", F.floor(F.col("_slot") / F.lit(SLOTS_PER_GROUP)))
    sizes = grouped.groupBy("_group").agg(F.sum("_n").alias("_group_n"))
    over = Window.partitionBy(F.lit(0))
    sizes = sizes.select(
        "_group",
        F.coalesce(F.sum("_group_n").over(over.orderBy("_group").rowsBetween(*_AHEAD)), F.lit(0)).alias("_ahead"),
        F.sum("_group_n").over(over).alias("_total"),
    )
    inner = F.sum("_n").over(Window.partitionBy("_group").orderBy("_slot").rowsBetween(*_AHEAD))
    placed = grouped.withColumn("_inner", F.coalesce(inner, F.lit(0))).join(sizes, "_group")
    return placed.withColumn("_before", F.col("_ahead") + F.col("_inner"))


def trend(
    df: DataFrame, period: str, measures: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Measures per period with the change from the period before.

    The window runs over the aggregated rows: one per period and segment.
    """
    grouped = df.groupBy(*by, period).agg(*[m.alias(n) for n, m in measures.items()])
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(period)
    changes = {f"{n}_change": F.col(n) - F.lag(n).over(w) for n in measures}
    return grouped.withColumns(changes)


def count_per(df: DataFrame, key: str, alias: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def applicant_features(base: DataFrame, key: str, parts: Sequence[DataFrame]) -> DataFrame:
    """One row per applicant.

    Every part must already be aggregated to the applicant: joining row-level facts to each
    other would multiply rows. Aggregates and joins share one distribution by applicant.
    """
    return reduce(lambda acc, part: acc.join(part, key, "left"), parts, base)


def long_form(
    df: DataFrame, segment: Column, measures: Mapping[str, Column]
) -> DataFrame:
    """Wide KPI rows to ``(kpi, segment, value)`` rows."""
    rows = [
        F.struct(
            F.lit(kpi).alias("kpi"), segment.alias("segment"), value.cast("double").alias("value")
        )
        for kpi, value in measures.items()
    ]
    return df.select(F.inline(F.array(*rows)))


def risk_summary(
    loans: DataFrame,
    bureau: DataFrame,
    payments: DataFrame,
    loan_type: str = "loan_type_name",
    applicant: str = "sk_id_curr",
) -> DataFrame:
    """All headline indicators in long form; segment is a loan type or ALL."""
    fine = loans.groupBy(loan_type).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("target_flag") == 1).alias("bad"),
        exact_sum("amt_credit").alias("credit"),
        F.count("amt_credit").alias("credit_n"),
        exact_sum("income_to_credit_ratio").alias("ratio"),
        F.count("income_to_credit_ratio").alias("ratio_n"),
    )
    rolled = fine.rollup(loan_type).agg(
        F.grouping_id().alias("_level"),
        *_sum_back(["n", "bad", "credit", "credit_n", "ratio", "ratio_n"]),
    )
    loan_rows = long_form(
        rolled,
        F.when(F.col("_level") == 1, F.lit(ALL)).otherwise(F.col(loan_type)),
        {
            "default_rate_pct": percent(F.col("bad"), F.col("n")),
            "avg_credit_amount": safe_ratio(F.col("credit").cast("double"), "credit_n"),
            "income_to_credit_ratio": safe_ratio(F.col("ratio").cast("double"), "ratio_n"),
        },
    )
    bureau_rows = long_form(
        bureau.groupBy(applicant)
        .agg(
            exact_sum("amt_credit_sum").alias("exposure"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("credit_day_overdue") > 0).alias("overdue"),
        )
        .agg(
            safe_ratio(F.sum("exposure").cast("double"), F.count("exposure")).alias("exposure"),
            F.sum("n").alias("n"),
            F.sum("overdue").alias("overdue"),
        ),
        F.lit(ALL),
        {
            "avg_bureau_exposure": F.col("exposure"),
            "overdue_rate_pct": percent(F.col("overdue"), F.col("n")),
        },
    )
    payment_rows = long_form(
        payments.agg(exact_avg("days_payment_diff").alias("diff")),
        F.lit(ALL),
        {"avg_days_payment_diff": F.col("diff")},
    )
    return loan_rows.unionByName(bureau_rows).unionByName(payment_rows)
