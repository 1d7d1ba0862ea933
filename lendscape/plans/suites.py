"""Quality suites per layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lendscape.operators import quality as q
from lendscape.operators.history import not_exactly_one_current
from lendscape.operators.lookup import orphans
from lendscape.specs import CREDIT_STATUSES, TableSpec

# The employment sentinel's text, and the tolerated share of missing occupations.
EMPLOYMENT_SENTINEL = "365243"
OCCUPATION_NULL_RATE = 0.40


def bronze_suite(spec: TableSpec, expected: int | None = None) -> list[q.Expectation]:
    """Warnings only: the run goes on with what was landed.

    ``expected`` is a row count known from elsewhere than the landed rows themselves.
    """
    out = [
        q.row_count_at_least(1, q.WARN),
        q.not_null(spec.primary_key, q.WARN),
        q.not_null("ingestion_ts", q.WARN),
    ]
    if spec.name == "application_train":
        out.append(q.unique(spec.primary_key, severity=q.WARN))
    if expected is not None:
        out.append(q.row_count_equals(expected, q.WARN))
    return out


def silver_suites(tables: Mapping[str, DataFrame | None]) -> dict[str, list[q.Expectation]]:
    """Failures stop the run before anything is modelled."""
    bureau = [q.not_null("SK_ID_BUREAU"), q.unique("SK_ID_BUREAU")]
    application = tables.get("silver_application")
    if application is not None:
        bureau.append(q.relationship("SK_ID_CURR", application, "SK_ID_CURR", q.WARN))
    return {
        "silver_application": [
            q.not_null("SK_ID_CURR"),
            q.unique("SK_ID_CURR"),
            q.not_in_set("ORGANIZATION_TYPE", ["XNA"]),
            q.not_null("DAYS_BIRTH_MASKED"),
            q.is_digest("DAYS_BIRTH_MASKED"),
            q.is_digest("DAYS_EMPLOYED_MASKED"),
            q.not_digest_of("DAYS_EMPLOYED_MASKED", EMPLOYMENT_SENTINEL),
            q.greater_than("AMT_CREDIT", 0),
            q.null_rate_below("OCCUPATION_TYPE", OCCUPATION_NULL_RATE),
        ],
        "silver_bureau": bureau,
        "silver_bureau_balance": [q.not_null("SK_ID_BUREAU"), q.unique("SK_ID_BUREAU")],
        "silver_installments": [q.not_null("SK_ID_PREV")],
    }


def staging_suites() -> dict[str, list[q.Expectation]]:
    """Checks on the staged and derived rows the marts are built from."""
    return {
        "stg_application": [
            q.not_null("amt_credit"),
            q.accepted_values("target_flag", [0, 1], q.WARN),
            q.not_null("sk_id_curr"),
            q.unique("sk_id_curr"),
            q.not_null("days_birth_masked"),
        ],
        "stg_bureau": [q.not_null("sk_id_bureau"), q.unique("sk_id_bureau")],
        "stg_bureau_balance": [q.not_null("sk_id_bureau"), q.unique("sk_id_bureau")],
        "stg_installments": [q.not_null("sk_id_prev")],
        "applicant_attributes": [q.not_null("applicant_id"), q.unique("applicant_id")],
        "bureau_with_balance": [q.not_null("sk_id_bureau"), q.unique("sk_id_bureau")],
        "installment_payments": [q.not_null("sk_id_prev")],
    }


def gold_suites(tables: Mapping[str, DataFrame]) -> dict[str, list[q.Expectation]]:
    """Checks on the marts, the custom orphan queries among them."""
    applicants, loan_types = tables["dim_applicant"], tables["dim_loan_type"]
    statuses = tables["dim_credit_status"]
    loans, bureau = tables["fact_loan_application"], tables["fact_bureau_credit"]
    suites = {
        "fact_loan_application": [
            q.not_null("loan_application_sk"),
            q.unique("loan_application_sk"),
            q.not_null("sk_id_curr"),
            q.not_null("applicant_sk"),
            q.relationship("applicant_sk", applicants, "applicant_sk"),
            q.not_null("loan_type_id"),
            q.relationship("loan_type_id", loan_types, "loan_type_id"),
            q.accepted_values("target_flag", [0, 1], q.WARN),
            q.not_null("amt_credit"),
        ],
        "fact_bureau_credit": [
            q.not_null("bureau_credit_sk"),
            q.unique("bureau_credit_sk"),
            q.not_null("sk_id_bureau"),
            q.not_null("applicant_sk"),
            q.relationship("applicant_sk", applicants, "applicant_sk"),
            q.not_null("credit_status_id"),
            q.relationship("credit_status_id", statuses, "status_id"),
        ],
        "fact_installment_payment": [
            q.not_null("payment_sk"),
            q.unique("payment_sk"),
            q.not_null("sk_id_curr"),
            q.relationship("sk_id_curr", loans, "sk_id_curr", q.WARN),
        ],
        "dim_applicant": [
            q.not_null("applicant_sk"),
            q.unique("applicant_sk"),
            q.not_null("applicant_id"),
            q.not_null("start_date"),
            q.not_null("is_current"),
            q.not_null("days_birth_masked"),
            q.no_rows(
                "one_current_per_applicant",
                not_exactly_one_current(applicants, "applicant_id"),
                "applicant_id",
            ),
        ],
        "dim_loan_type": [
            q.not_null("loan_type_id"),
            q.unique("loan_type_id"),
            q.not_null("loan_type_name"),
            q.unique("loan_type_name"),
        ],
        "dim_credit_status": [
            q.not_null("status_id"),
            q.unique("status_id"),
            q.not_null("status_code"),
            q.unique("status_code"),
            q.accepted_values("status_code", [code for code, _ in CREDIT_STATUSES]),
        ],
    }
    for name, fact in (("fact_loan_application", loans), ("fact_bureau_credit", bureau)):
        unresolved = orphans(fact, "applicant_sk", applicants, "applicant_sk")
        suites[name].append(q.no_rows("applicant_resolves", unresolved, "applicant_sk"))
    return suites
