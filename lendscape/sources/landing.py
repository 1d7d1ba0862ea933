"""From landed CSV to Bronze: typed rows, lineage, quarantine and counts in one job."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date as Date
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscape.operators.shape import broken_rules, stamp
from lendscape.sources.store import exists, has_run, latest_run, read_runs, write_run
from lendscape.specs import TableSpec

log = logging.getLogger(__name__)

DAY = "ingestion_date"
ZONE = "zone"
CLEAN, QUARANTINE = "clean", "quarantine"
_FILE = "source_file"
_CORRUPT = "_corrupt"
_WHOLE = T.DecimalType(28, 8)


@dataclass(frozen=True)
class IngestResult:
    table: str
    rows_written: int
    quarantine_rows: int

    @property
    def rows_read(self) -> int:
        return self.rows_written + self.quarantine_rows


class NoRowsError(RuntimeError):
    """A source that must deliver rows delivered none."""


def resolve_source(spark: SparkSession, landing: str, spec: TableSpec) -> str | None:
    """First of the table's files that exists, the sample before the full file."""
    for name in spec.files:
        if exists(spark, f"{landing}/{name}"):
            return f"{landing}/{name}"
    return None


def read_csv(
    spark: SparkSession, spec: TableSpec, path: str, null_token: str | None = None
) -> DataFrame:
    """CSV matched to the catalogue by header name; the parser types the catalogued columns.

    Whole numbers are read as decimals, since some writers give them a decimal point. Other
    columns are text. A line the parser cannot type is kept whole in ``_corrupt``.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {
        f.name: _WHOLE if isinstance(f.dataType, T.LongType) else f.dataType for f in spec.schema
    }
    fields = [T.StructField(c, known.get(c, T.StringType())) for c in header]
    return (
        spark.read.schema(T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("nullValue", spec.null_token if null_token is None else null_token)
        .option("multiLine", spec.multi_line)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
        .withColumn(_FILE, F.col("_metadata.file_path"))
    )


def read_source(
    spark: SparkSession,
    spec: TableSpec,
    path: str | None,
    rules: Mapping[str, Column] | None = None,
    null_token: str | None = None,
) -> DataFrame:
    """Typed rows of one source with the list of broken rules per row.

    Types come from the catalogue: no inference pass, and no change of type from one day to
    the next. Columns beyond the catalogue are stored as text. A malformed line, a whole-number
    column holding a fraction and a NULL primary key are broken rules; ``raw`` then keeps what
    the typed columns cannot hold. ``null_token`` means NULL besides the empty
    field; the default is the table's.
    """
    if path is None:
        lineage = ("source_file", "reasons", "raw")
        empty = [*spec.schema, *[f for f in spec.bronze_schema if f.name in lineage]]
        return spark.createDataFrame([], T.StructType(empty))
    parsed = read_csv(spark, spec, path, null_token)
    data = [c for c in parsed.columns if c not in (_CORRUPT, _FILE)]
    whole = [c for c in data if parsed.schema[c].dataType == _WHOLE]
    text = [c for c in data if isinstance(parsed.schema[c].dataType, T.StringType)]

    def is_cut(c: str) -> Column:
        back = F.col(c).try_cast("bigint").cast(_WHOLE)
        return F.coalesce(back != F.col(c), F.col(c).isNotNull())

    cut = _any([is_cut(c) for c in whole])
    checks = {
        "MALFORMED_ROW": F.col(_CORRUPT).isNotNull(),
        **{f"BAD_VALUE:{c}": is_cut(c) for c in whole},
        f"NULL_KEY:{spec.primary_key}": F.col(spec.primary_key).isNull(),
        **(rules or {}),
    }
    typed = {
        **{c: F.col(c).try_cast("bigint") for c in whole},
        **{c: F.nullif(F.col(c), F.lit("")) for c in text},
    }
    none = F.array().cast("array<string>")
    return parsed.select(
        *[typed.get(c, F.col(c)).alias(c) for c in data],
        _FILE,
        F.when(_any(list(checks.values())), broken_rules(checks)).otherwise(none).alias("reasons"),
        F.coalesce(F.col(_CORRUPT), F.when(cut, F.to_json(F.struct(*data)))).alias("raw"),
    )


def ingest(
    spark: SparkSession,
    spec: TableSpec,
    landing: str,
    bronze: str,
    ingestion_date: Date,
    run_ts: datetime,
    env: str = "dev",
    batch_id: str | None = None,
    rules: Mapping[str, Column] | None = None,
    null_token: str | None = None,
) -> IngestResult:
    """Land one table for one day, replacing that day.

    Clean and quarantined rows are two partitions of the same write and both counts are
    observed while it runs: the file is parsed once. A missing source yields zero rows and a
    warning.
    """
    path = resolve_source(spark, landing, spec)
    if path is None:
        log.warning("no source file for %s below %s", spec.name, landing)
        return IngestResult(spec.name, 0, 0)
    rows = stamp(
        read_source(spark, spec, path, rules, null_token),
        run_ts,
        ingestion_date,
        batch_id or f"{spec.name}-{run_ts:%Y%m%dT%H%M%S}",
        env,
    ).withColumn(ZONE, F.when(F.size("reasons") == 0, F.lit(CLEAN)).otherwise(F.lit(QUARANTINE)))
    rows = rows.drop(DAY)
    if spec.cluster_by:
        # Order inside each file makes its row-group statistics selective for later filters.
        rows = rows.sortWithinPartitions(ZONE, *spec.cluster_by)
    counts = write_run(
        rows, f"{bronze}/{spec.name}", DAY, ingestion_date.isoformat(), (ZONE, (CLEAN, QUARANTINE))
    )
    result = IngestResult(spec.name, counts[CLEAN], counts[QUARANTINE])
    if result.quarantine_rows:
        log.warning("%s: %d rows quarantined", spec.name, result.quarantine_rows)
    return result


def require_rows(result: IngestResult) -> IngestResult:
    """Fail when a table that must deliver rows wrote none."""
    if result.rows_written == 0:
        raise NoRowsError(f"no rows written for {result.table}")
    return result


def read_day(
    spark: SparkSession, bronze: str, spec: TableSpec, ingestion_date: Date, zone: str = CLEAN
) -> DataFrame | None:
    """One landed day with its date column; ``None`` when that day is not there."""
    root, label = f"{bronze}/{spec.name}", ingestion_date.isoformat()
    if not has_run(spark, root, DAY, label):
        return None
    schema = spec.bronze_schema.add(DAY, T.DateType()).add(ZONE, T.StringType())
    stored = read_runs(spark, root, DAY, [label], schema)
    return stored.filter((F.col(DAY) == F.lit(ingestion_date)) & (F.col(ZONE) == zone)).drop(ZONE)


def last_day(spark: SparkSession, bronze: str, spec: TableSpec) -> str | None:
    return latest_run(spark, f"{bronze}/{spec.name}", DAY)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(
        lambda x, y: x | y, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(False)
    )
