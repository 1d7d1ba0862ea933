"""One day's batch: land, gate, clean, gate, fold history, build the star, gate, summarise."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date as Date
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.operators import partials
from lendscape.operators import quality as q
from lendscape.operators.kpi import risk_summary
from lendscape.plans import gold, suites
from lendscape.plans.silver import business_rules, clean, read_silver, run_silver
from lendscape.sources import landing, store
from lendscape.specs import (
    APPLICATION,
    BUREAU,
    BUREAU_BALANCE,
    INSTALLMENTS,
    PREVIOUS_APPLICATION,
    SOURCES,
    TRACKED_ATTRIBUTES,
)

BUILD = "build"
MARTS = (
    "dim_applicant",
    "dim_loan_type",
    "dim_credit_status",
    "fact_loan_application",
    "fact_bureau_credit",
    "fact_installment_payment",
    "applicant_features",
)


@dataclass(frozen=True)
class Lake:
    """Layer locations below one root on the shared file system."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def history(self) -> str:
        return f"{self.root}/history/applicant"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def land(
    spark: SparkSession,
    source: str,
    lake: Lake,
    day: Date,
    run_ts: datetime,
    env: str = "dev",
    apply_business_rules: bool = True,
    parallel: int = 4,
) -> dict[str, landing.IngestResult]:
    """Land all tables; independent Spark jobs are submitted side by side.

    Applications without outcome or with non-positive credit are quarantined unless
    ``apply_business_rules`` is switched off.
    """

    def one(spec):
        rules = business_rules(spec) if apply_business_rules else {}
        return landing.ingest(
            spark, spec, source, lake.bronze, day, run_ts, env=env, rules=rules
        )

    with ThreadPoolExecutor(parallel) as pool:
        return {r.table: r for r in pool.map(one, SOURCES.values())}


def bronze_gate(spark: SparkSession, lake: Lake, day: Date) -> DataFrame:
    tables = {n: landing.read_day(spark, lake.bronze, s, day) for n, s in SOURCES.items()}
    return q.evaluate(spark, tables, {n: suites.bronze_suite(s) for n, s in SOURCES.items()})


def refine(
    spark: SparkSession,
    lake: Lake,
    day: Date,
    salt: str | None = None,
    parallel: int = 4,
    mask_key: bytes | None = None,
) -> None:
    """Applications first, the other tables side by side after them."""
    run_silver(spark, APPLICATION, lake.bronze, lake.silver, day, salt, mask_key)
    others = [s for s in SOURCES.values() if s is not APPLICATION]
    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(lambda s: run_silver(spark, s, lake.bronze, lake.silver, day), others))


def silver_gate(spark: SparkSession, lake: Lake) -> DataFrame:
    tables = {s.silver_name: read_silver(spark, s, lake.silver) for s in SOURCES.values()}
    return q.evaluate(spark, tables, suites.silver_suites(tables))


def model(
    spark: SparkSession, lake: Lake, run_ts: datetime
) -> dict[str, DataFrame]:
    """Gate the staged rows, rebuild the marts from them and return the marts as stored."""
    app = gold.stg_application(read_silver(spark, APPLICATION, lake.silver))
    bureau = gold.stg_bureau(read_silver(spark, BUREAU, lake.silver))
    balance = gold.stg_bureau_balance(read_silver(spark, BUREAU_BALANCE, lake.silver))
    installments = gold.stg_installments(read_silver(spark, INSTALLMENTS, lake.silver))
    attributes = gold.applicant_attributes(app)
    staged = {
        "stg_application": app,
        "stg_bureau": bureau,
        "stg_bureau_balance": balance,
        "stg_installments": installments,
        "applicant_attributes": attributes,
        "bureau_with_balance": gold.bureau_with_balance(bureau, balance),
        "installment_payments": gold.installment_payments(installments),
    }
    q.gate(q.evaluate(spark, staged, suites.staging_suites()))

    store.publish_history(
        spark, lake.history, attributes, "applicant_id", TRACKED_ATTRIBUTES, run_ts
    )
    label = store.run_label(run_ts)

    def build(name: str, df: DataFrame) -> DataFrame:
        store.write_run(df, lake.gold(name), BUILD, label)
        return store.read_run(spark, lake.gold(name), BUILD, label)

    history = store.read_history(spark, lake.history, "applicant_id", run_ts)
    marts = {
        "dim_applicant": build("dim_applicant", gold.dim_applicant(history)),
        "dim_loan_type": build("dim_loan_type", gold.dim_loan_type(app, run_ts)),
        "dim_credit_status": build("dim_credit_status", gold.dim_credit_status(spark, run_ts)),
    }
    marts["fact_loan_application"] = build(
        "fact_loan_application",
        gold.fact_loan_application(app, marts["dim_applicant"], marts["dim_loan_type"]),
    )
    marts["fact_bureau_credit"] = build(
        "fact_bureau_credit",
        gold.fact_bureau_credit(
            bureau, balance, marts["dim_applicant"], marts["dim_credit_status"]
        ),
    )
    marts["fact_installment_payment"] = build(
        "fact_installment_payment", gold.fact_installment_payment(installments)
    )
    previous = read_silver(spark, PREVIOUS_APPLICATION, lake.silver)
    marts["applicant_features"] = build(
        "applicant_features",
        gold.applicant_features(
            app.select("sk_id_curr"),
            marts["fact_bureau_credit"],
            previous.select(F.col("SK_ID_CURR").alias("sk_id_curr")),
            marts["fact_installment_payment"],
        ),
    )
    return marts


def stored_marts(spark: SparkSession, lake: Lake, run_ts: datetime) -> dict[str, DataFrame]:
    """The marts as a run has stored them."""
    label = store.run_label(run_ts)
    return {name: store.read_run(spark, lake.gold(name), BUILD, label) for name in MARTS}


def gold_gate(spark: SparkSession, marts: dict[str, DataFrame]) -> DataFrame:
    return q.evaluate(spark, marts, suites.gold_suites(marts))


def summarise(
    spark: SparkSession, lake: Lake, marts: dict[str, DataFrame], run_ts: datetime
) -> DataFrame:
    """Store and return the KPI summary."""
    loans = gold.with_loan_type(marts["fact_loan_application"], marts["dim_loan_type"])
    summary = risk_summary(loans, marts["fact_bureau_credit"], marts["fact_installment_payment"])
    label = store.run_label(run_ts)
    store.write_run(summary, lake.gold("risk_summary"), BUILD, label)
    return store.read_run(spark, lake.gold("risk_summary"), BUILD, label)


def keep_partials(spark: SparkSession, lake: Lake, day: Date) -> DataFrame | None:
    """Store the partial results of a day's landed applications, and return those of all days.

    Periods are rolled up from them, so that no day's facts are read again.
    """
    landed = landing.read_day(spark, lake.bronze, APPLICATION, day)
    root = lake.gold("application_partials")
    if landed is not None:
        fact = gold.stg_application(clean(APPLICATION, landed))
        parts = partials.daily_partials(fact, "ingestion_date", ["name_contract_type"])
        store.write_run(parts.drop(partials.DAY), root, partials.DAY, day.isoformat())
    days = store.run_labels(spark, root, partials.DAY)
    return store.read_runs(spark, root, partials.DAY, days) if days else None


def run_day(
    spark: SparkSession,
    source: str,
    lake: Lake,
    day: Date,
    run_ts: datetime,
    env: str = "dev",
    apply_business_rules: bool = True,
    require_all: bool = True,
    salt: str | None = None,
    mask_key: bytes | None = None,
) -> dict[str, DataFrame]:
    """The whole batch. Warnings are logged; failures stop it at the gate they occur in."""
    landed = land(spark, source, lake, day, run_ts, env, apply_business_rules)
    if require_all:
        for result in landed.values():
            landing.require_rows(result)
    q.gate(bronze_gate(spark, lake, day))
    refine(spark, lake, day, salt, mask_key=mask_key)
    q.gate(silver_gate(spark, lake), require=["silver_application", "silver_bureau"])
    marts = model(spark, lake, run_ts)
    q.gate(gold_gate(spark, marts))
    marts["risk_summary"] = summarise(spark, lake, marts, run_ts)
    marts["application_partials"] = keep_partials(spark, lake, day)
    return marts
