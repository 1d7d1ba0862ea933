"""Data-quality expectations and gates.

All row-level expectations on a table are evaluated by one aggregation over it; only
uniqueness, relationships and custom failing-row queries need their own.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.operators.lookup import orphan_count

log = logging.getLogger(__name__)

WARN, FAIL = "WARN", "FAIL"
RESULT_COLUMNS = (
    "table_name",
    "check_name",
    "column_name",
    "severity",
    "failed_rows",
    "total_rows",
    "status",
)
RESULT_SCHEMA = (
    "table_name string, check_name string, column_name string, severity string, "
    "failed_rows long, total_rows long, status string"
)


class QualityGateError(RuntimeError):
    """At least one failing expectation stops the run; lists all of them."""


@dataclass(frozen=True)
class Expectation:
    """One check. Exactly one of the evaluation fields is set."""

    name: str
    column: str
    severity: str = FAIL
    bad_row: Column | None = None
    max_rate: float | None = None
    min_rows: int | None = None
    exact_rows: int | None = None
    unique: tuple[str, ...] = ()
    relation: tuple[str, DataFrame, str] | None = None
    failing: DataFrame | None = None


def row_count_at_least(n: int = 1, severity: str = FAIL) -> Expectation:
    return Expectation("row_count_at_least", "*", severity, min_rows=n)


def row_count_equals(n: int, severity: str = FAIL) -> Expectation:
    return Expectation("row_count_equals", "*", severity, exact_rows=n)


def not_null(column: str, severity: str = FAIL) -> Expectation:
    return Expectation("not_null", column, severity, bad_row=F.col(column).isNull())


def not_in_set(column: str, values: Sequence, severity: str = FAIL) -> Expectation:
    return Expectation("not_in_set", column, severity, bad_row=F.col(column).isin(list(values)))


def accepted_values(column: str, values: Sequence, severity: str = FAIL) -> Expectation:
    return Expectation(
        "accepted_values", column, severity, bad_row=~F.col(column).isin(list(values))
    )


def greater_than(column: str, bound: float, severity: str = FAIL) -> Expectation:
    return Expectation("greater_than", column, severity, bad_row=F.col(column) <= F.lit(bound))


def null_rate_below(column: str, rate: float, severity: str = WARN) -> Expectation:
    return Expectation(
        "null_rate_below", column, severity, bad_row=F.col(column).isNull(), max_rate=rate
    )


def not_digest_of(column: str, value: str, severity: str = FAIL) -> Expectation:
    """No masked value may be the digest of the given text (a sentinel that slipped through)."""
    return Expectation(
        "not_digest_of", column, severity, bad_row=F.col(column) == F.sha2(F.lit(value), 256)
    )


def masked_differs(masked: str, original: str, severity: str = FAIL) -> Expectation:
    """A masked value must not equal the text of the original beside it."""
    return Expectation(
        "masked_differs",
        masked,
        severity,
        bad_row=F.col(masked) == F.col(original).cast("string"),
    )


def is_digest(column: str, severity: str = FAIL) -> Expectation:
    """Masked values have the form of a SHA-256 digest, which no number's text has.

    Proves that masked values differ from the originals without joining the layer before.
    """
    return Expectation(
        "is_digest", column, severity, bad_row=~F.col(column).rlike("^[0-9a-f]{64}$")
    )


def unique(*columns: str, severity: str = FAIL) -> Expectation:
    """Rows sharing their key with another row count as failed; NULL keys are ignored."""
    return Expectation("unique", ",".join(columns), severity, unique=columns)


def relationship(fk: str, parent: DataFrame, pk: str, severity: str = FAIL) -> Expectation:
    """Every non-NULL foreign key exists in the parent."""
    return Expectation("relationship", fk, severity, relation=(fk, parent, pk))


def no_rows(name: str, failing: DataFrame, column: str = "*", severity: str = FAIL) -> Expectation:
    """A custom query that must return nothing."""
    return Expectation(name, column, severity, failing=failing)


def check(df: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """Evaluate expectations lazily; one result row each."""
    fused = [e for e in expectations if not (e.unique or e.relation or e.failing is not None)]
    parts = [_fused(df, table, fused)] if fused else []
    for e in expectations:
        if e.unique:
            parts.append(_unique(df, table, e))
        elif e.relation:
            fk, parent, pk = e.relation
            counted = orphan_count(df, fk, parent, pk)
            parts.append(_rows(counted, table, e, F.col("orphan_rows"), F.col("checked_rows")))
        elif e.failing is not None:
            counted = e.failing.agg(F.count(F.lit(1)).alias("n"))
            parts.append(_rows(counted, table, e, F.col("n"), F.col("n")))
    return reduce(DataFrame.unionByName, parts)


def skipped(spark: SparkSession, table: str) -> DataFrame:
    """Result row for a table that is not there."""
    return spark.createDataFrame([(table, "present", "*", FAIL, 0, 0, "SKIPPED")], RESULT_SCHEMA)


def evaluate(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    suites: Mapping[str, Sequence[Expectation]],
) -> DataFrame:
    """Run every suite; a missing table yields a SKIPPED row instead of silence."""
    parts = [
        skipped(spark, name) if tables.get(name) is None else check(tables[name], name, suite)
        for name, suite in suites.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def gate(results: DataFrame, require: Sequence[str] = ()) -> list:
    """Log warnings, then raise once with every failure.

    The results hold one row per expectation, so bringing them to the driver is bounded.
    Tables named in ``require`` must not be skipped.
    """
    rows = results.collect()
    failures = []
    for row in rows:
        text = (
            f"{row.table_name}.{row.column_name} {row.check_name}: "
            f"{row.failed_rows} of {row.total_rows} rows"
        )
        if row.status == WARN:
            log.warning("quality warning %s", text)
        elif row.status == FAIL:
            log.error("quality failure %s", text)
            failures.append(text)
        elif row.status == "SKIPPED":
            log.warning("quality skipped %s", row.table_name)
            if row.table_name in require:
                failures.append(f"{row.table_name} is missing")
    if failures:
        raise QualityGateError("; ".join(failures))
    return rows


def _result(e: Expectation, table: str, failed: Column, total: Column, bad: Column) -> Column:
    status = F.when(bad, F.lit(e.severity)).otherwise(F.lit("PASS"))
    values = (
        F.lit(table),
        F.lit(e.name),
        F.lit(e.column),
        F.lit(e.severity),
        failed.cast("long"),
        total.cast("long"),
        status,
    )
    return F.struct(*[v.alias(n) for v, n in zip(values, RESULT_COLUMNS)])


def _fused(df: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    counts = [F.count(F.lit(1)).alias("_rows")]
    for i, e in enumerate(expectations):
        if e.bad_row is not None:
            counts.append(F.count_if(e.bad_row).alias(f"_bad{i}"))
    total = F.col("_rows")
    structs = []
    for i, e in enumerate(expectations):
        if e.min_rows is not None:
            failed, bad = F.greatest(F.lit(e.min_rows) - total, F.lit(0)), total < e.min_rows
        elif e.exact_rows is not None:
            failed, bad = F.abs(total - F.lit(e.exact_rows)), total != e.exact_rows
        elif e.max_rate is not None:
            failed = F.col(f"_bad{i}")
            rate = failed.cast("double") / F.nullif(total, F.lit(0)).cast("double")
            bad = F.coalesce(rate >= F.lit(e.max_rate), F.lit(False))
        else:
            failed = F.col(f"_bad{i}")
            bad = failed > 0
        structs.append(_result(e, table, failed, total, bad))
    return df.agg(*counts).select(F.inline(F.array(*structs)))


def _unique(df: DataFrame, table: str, e: Expectation) -> DataFrame:
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in e.unique])
    counted = (
        df.filter(known)
        .groupBy(*e.unique)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("failed"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        )
    )
    return _rows(counted, table, e, F.col("failed"), F.col("total"))


def _rows(df: DataFrame, table: str, e: Expectation, failed: Column, total: Column) -> DataFrame:
    return df.select(_result(e, table, failed, total, failed > 0).alias("r")).select("r.*")
