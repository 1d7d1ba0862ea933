"""Type-2 history: folding snapshots or a change log into versions.

Versions carry half-open validity ``[valid_from, valid_to)``; ``valid_to`` is NULL while open.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.functions import surrogate_key

VALID_FROM = "valid_from"
VALID_TO = "valid_to"

# A log is cut along its order column into stretches of this calendar unit, or of this many
# units of a number. Choose it so that the most frequent key has some million rows in a stretch.
STRETCH = "MONTH"
NUMBERS_PER_STRETCH = 1_000_000


def open_versions(
    source: DataFrame, run_ts: datetime | Column, key: str | None = None
) -> DataFrame:
    """First load: every source row opens a version."""
    start = _timestamp(run_ts)
    return with_keys(source, key).withColumns({VALID_FROM: start, VALID_TO: F.nullif(start, start)})


def with_keys(source: DataFrame, key: str | None) -> DataFrame:
    """The same rows; a NULL key raises when they are read."""
    if key is None:
        return source
    missing = F.raise_error(F.lit(f"history source has a NULL {key}")).cast(source.schema[key].dataType)
    return source.withColumn(key, F.coalesce(F.col(key), missing)).select(*source.columns)


def scd2_step(
    current: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | Column,
    close_deleted: bool = False,
) -> DataFrame:
    """Compare the open versions with one snapshot; both hold at most one row per key.

    * unchanged, or absent from the snapshot: the open version stays exactly as it is, so
      columns that are carried but not compared are not refreshed;
    * a compared column differs (NULL-safe): the open version is closed at ``run_ts`` and a
      new one opened;
    * new key: a version is opened;
    * ``close_deleted`` closes versions whose key is absent;
    * a NULL key in the snapshot raises: it could never be found again.

    One full outer join; keys are unique on both sides, so no key is large.
    """
    start = _timestamp(run_ts)
    attributes = [c for c in source.columns if c != key]
    held = current.select(key, F.struct(*attributes, VALID_FROM, VALID_TO).alias("_held"))
    seen = with_keys(source, key).select(key, F.struct(*attributes).alias("_seen"))
    both = held.join(seen, key, "full_outer")

    is_held, is_seen = F.col("_held").isNotNull(), F.col("_seen").isNotNull()
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"_held.{c}").eqNullSafe(F.col(f"_seen.{c}")) for c in check_cols],
    )
    changed = is_held & is_seen & ~same
    closing = changed | (is_held & ~is_seen) if close_deleted else changed

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            F.col(key).alias(key),
            *[F.col(f"{side}.{c}").alias(c) for c in attributes],
            valid_from.alias(VALID_FROM),
            valid_to.alias(VALID_TO),
        )

    from_type = current.schema[VALID_FROM].dataType
    start = start.cast(from_type)
    standing = F.when(
        is_held,
        version(
            "_held",
            F.col(f"_held.{VALID_FROM}"),
            F.when(closing, start).otherwise(F.col(f"_held.{VALID_TO}")),
        ),
    )
    opened = F.when(
        is_seen & (~is_held | changed), version("_seen", start, F.nullif(start, start))
    )
    return both.select(F.inline(F.array(standing, opened))).filter(F.col(VALID_FROM).isNotNull())


def scd2_apply(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime | Column,
    close_deleted: bool = False,
) -> DataFrame:
    """Whole history after one snapshot; closed versions pass through untouched."""
    current = history.filter(F.col(VALID_TO).isNull())
    closed = history.filter(F.col(VALID_TO).isNotNull())
    return closed.unionByName(
        scd2_step(current, source, key, check_cols, run_ts, close_deleted)
    )


def scd2_from_log(
    log: DataFrame,
    key: str,
    order: str,
    check_cols: Sequence[str],
    tiebreak: Sequence[str] = (),
    carry: Sequence[str] = (),
    stretch: str | int | None = None,
) -> DataFrame:
    """History from a change log in one pass over each key's rows in order.

    Rows repeating the state before them are dropped, the others become versions ending where
    the next one begins.

    No key is handled as a whole: the log is cut along ``order`` into stretches, rows are
    windowed per (key, stretch), and only one summary row per stretch is windowed per key to
    carry state across the cuts. Cuts follow the calendar (or round numbers), so they need no
    look at the data, do not move with outliers, and are the same at every size.
    """
    state = F.struct(*check_cols)
    within = Window.partitionBy(key, "_chunk").orderBy(order, *tiebreak)

    needed = log.select(key, order, *_fresh([*tiebreak, *check_cols, *carry], (key, order)))
    staged = (
        needed.withColumn("_chunk", stretch_of(needed, order, stretch))
        .withColumn("_before", F.lag(state).over(within))
        .withColumn("_place", F.row_number().over(within))
    )
    inner_change = (F.col("_place") > 1) & ~state.eqNullSafe(F.col("_before"))

    position = F.struct(*[F.col(c) for c in (order, *tiebreak)], F.col("_place"))
    summary = staged.groupBy(key, "_chunk").agg(
        F.min(F.when(F.col("_place") == 1, F.col(order))).alias("_first_at"),
        F.min_by(state, position).alias("_first_state"),
        F.max_by(state, position).alias("_last_state"),
        F.min(F.when(inner_change, F.col(order))).alias("_inner_at"),
    )
    by_chunk = Window.partitionBy(key).orderBy("_chunk")
    later = Window.partitionBy(key).orderBy(F.desc("_chunk")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    borders = (
        summary.withColumn("_carried", F.lag("_last_state").over(by_chunk))
        .withColumn(
            "_opens_at",
            F.when(
                F.col("_carried").isNull() | ~F.col("_first_state").eqNullSafe(F.col("_carried")),
                F.col("_first_at"),
            ).otherwise(F.col("_inner_at")),
        )
        .withColumn("_next_at", F.last("_opens_at", ignorenulls=True).over(later))
        .select(key, "_chunk", "_carried", "_next_at")
    )
    versions = (
        staged.join(borders, [key, "_chunk"], "left")
        .withColumn(
            "_previous",
            F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_before")),
        )
        .filter(F.col("_previous").isNull() | ~state.eqNullSafe(F.col("_previous")))
    )
    return versions.select(
        key,
        *[c for c in (*check_cols, *carry)],
        F.col(order).alias(VALID_FROM),
        F.coalesce(F.lead(order).over(within), F.col("_next_at")).alias(VALID_TO),
    )


def stretch_of(df: DataFrame, order: str, stretch: str | int | None = None) -> Column:
    """The stretch a row lies in; it does not decrease as ``order`` grows, NULLs come first."""
    kind = df.schema[order].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        first = F.lit("0001-01-01").cast("timestamp_ntz")
        return F.coalesce(F.date_trunc(stretch or STRETCH, utc_time(order, kind)), first)
    number = F.floor(F.col(order) / F.lit(float(stretch or NUMBERS_PER_STRETCH)))
    return F.coalesce(number, F.lit(-(1 << 62)))


def utc_time(column: str, kind: str) -> Column:
    """A moment without zone that no session setting changes: instants are read in UTC."""
    if kind != "timestamp":
        return F.col(column).cast("timestamp_ntz")
    micros, day = F.unix_micros(column), 86_400_000_000
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / day).cast("int"))
    clock = (F.pmod(micros, F.lit(day)) / 1_000_000).cast("decimal(18,6)")
    return date.cast("timestamp_ntz") + F.make_dt_interval(secs=clock)


def scd2_present(history: DataFrame, key: str, sk: str) -> DataFrame:
    """Dimension view of a history: surrogate key, start and end dates, current flag.

    Key and dates follow UTC, whatever the session's time zone, so facts built under one setting
    join dimensions read under another.
    """
    attributes = [c for c in history.columns if c not in (key, VALID_FROM, VALID_TO)]
    start, end = (
        utc_time(c, history.schema[c].dataType.typeName()) for c in (VALID_FROM, VALID_TO)
    )
    return history.select(
        surrogate_key(key, start).alias(sk),
        key,
        *attributes,
        start.cast("date").alias("start_date"),
        end.cast("date").alias("end_date"),
        F.col(VALID_TO).isNull().alias("is_current"),
    )


def not_exactly_one_current(dim: DataFrame, key: str) -> DataFrame:
    """Keys with zero or several current versions (empty when the history is sound)."""
    return (
        dim.groupBy(key)
        .agg(F.count_if("is_current").alias("current_count"))
        .filter(F.col("current_count") != 1)
    )


def _timestamp(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _fresh(columns: Sequence[str], taken: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(c for c in columns if c not in taken))
