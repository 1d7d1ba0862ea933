"""Bronze to Silver: cleaned, masked, deduplicated, one generic job for all tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.operators.latest import latest_per_key
from lendscape.operators.shape import mask_columns, null_sentinels, select_existing
from lendscape.sources import landing, store
from lendscape.specs import TableSpec


def business_rules(spec: TableSpec) -> dict[str, Column]:
    """Optional row rules for applications: an outcome is required and credit is positive."""
    if spec.name != "application_train":
        return {}
    return {
        "HIGH:NULL_TARGET": F.col("TARGET").isNull(),
        "MEDIUM:NON_POSITIVE_CREDIT": F.col("AMT_CREDIT") <= 0,
    }


def wanted_rows(spec: TableSpec, bronze: DataFrame) -> DataFrame:
    """Rows the table keeps at all, e.g. the most recent month of a balance."""
    rows = bronze
    for column, value in spec.only.items():
        rows = rows.filter(F.col(column) == F.lit(value))
    return rows


def clean(
    spec: TableSpec,
    bronze: DataFrame,
    salt: str | None = None,
    tiebreak: Sequence[str] | None = None,
    mask_key: bytes | None = None,
) -> DataFrame:
    """Row filter, kept columns, latest row per key, sentinels to NULL, then masking.

    Sentinels become NULL before masking, so that no digest of one is ever stored. Masking
    follows deduplication: the wide digests are neither shuffled nor computed for rows that
    are dropped. Ties are decided on the landed values.
    """
    rows = select_existing(wanted_rows(spec, bronze), spec.silver_columns)
    if spec.dedup_keys:
        rows = latest_per_key(rows, spec.dedup_keys, "ingestion_ts", tiebreak)
    rows = null_sentinels(rows, spec.sentinels)
    return mask_columns(rows, spec.masked, salt=salt, key=mask_key)


def run_silver(
    spark: SparkSession,
    spec: TableSpec,
    bronze: str,
    silver: str,
    ingestion_date: Date,
    salt: str | None = None,
    mask_key: bytes | None = None,
) -> bool:
    """Merge one landed day into the keyed table, or replace that day of a keyless one.

    Returns whether there was a landed day.
    """
    landed = landing.read_day(spark, bronze, spec, ingestion_date)
    if landed is None:
        return False
    rows = clean(spec, landed, salt, mask_key=mask_key)
    root, label = f"{silver}/{spec.silver_name}", ingestion_date.isoformat()
    if spec.upsert_keys:
        store.publish_upsert(spark, root, rows, spec.upsert_keys, label)
    else:
        store.write_run(rows.drop(landing.DAY), root, landing.DAY, label)
    return True


def read_silver(spark: SparkSession, spec: TableSpec, silver: str) -> DataFrame | None:
    """Current state of a keyed table, or all days of a keyless one."""
    root = f"{silver}/{spec.silver_name}"
    if spec.upsert_keys:
        return store.read_keyed(spark, root, spec.upsert_keys)
    days = store.run_labels(spark, root, landing.DAY)
    return store.read_runs(spark, root, landing.DAY, days) if days else None
