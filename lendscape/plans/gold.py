"""Silver to Gold: staging projections, applicant history, star schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.functions import day_gap, safe_ratio, surrogate_key
from lendscape.operators.dims import dim_from_distinct, dim_static
from lendscape.operators.history import scd2_present
from lendscape.operators.kpi import applicant_features as join_features
from lendscape.operators.kpi import count_per, exact_avg, exact_sum
from lendscape.operators.lookup import left_lookup, lookup_current, lookup_small
from lendscape.operators.shape import conform
from lendscape.specs import CARRIED_ATTRIBUTES, CREDIT_STATUSES, TRACKED_ATTRIBUTES

# Staging columns as (source, name, type).
STG_APPLICATION = (
    ("SK_ID_CURR", "sk_id_curr", "bigint"),
    ("TARGET", "target_flag", "bigint"),
    ("NAME_CONTRACT_TYPE", "name_contract_type", "string"),
    ("AMT_CREDIT", "amt_credit", "double"),
    ("AMT_ANNUITY", "amt_annuity", "double"),
    ("AMT_INCOME_TOTAL", "amt_income_total", "double"),
    ("AMT_GOODS_PRICE", "amt_goods_price", "double"),
    ("NAME_INCOME_TYPE", "name_income_type", "string"),
    ("NAME_EDUCATION_TYPE", "name_education_type", "string"),
    ("NAME_FAMILY_STATUS", "name_family_status", "string"),
    ("NAME_HOUSING_TYPE", "name_housing_type", "string"),
    ("CNT_CHILDREN", "cnt_children", "bigint"),
    ("FLAG_OWN_CAR", "flag_own_car", "string"),
    ("FLAG_OWN_REALTY", "flag_own_realty", "string"),
    ("OCCUPATION_TYPE", "occupation_type", "string"),
    ("ORGANIZATION_TYPE", "organization_type", "string"),
    ("REGION_RATING_CLIENT", "region_rating_client", "bigint"),
    ("EXT_SOURCE_1", "ext_source_1", "double"),
    ("EXT_SOURCE_2", "ext_source_2", "double"),
    ("EXT_SOURCE_3", "ext_source_3", "double"),
    ("DAYS_BIRTH_MASKED", "days_birth_masked", "string"),
    ("DAYS_EMPLOYED_MASKED", "days_employed_masked", "string"),
    ("ingestion_date", "ingestion_date", "date"),
)
STG_BUREAU = (
    ("SK_ID_CURR", "sk_id_curr", "bigint"),
    ("SK_ID_BUREAU", "sk_id_bureau", "bigint"),
    ("CREDIT_ACTIVE", "credit_active", "string"),
    ("CREDIT_CURRENCY", "credit_currency", "string"),
    ("DAYS_CREDIT", "days_credit", "bigint"),
    ("CREDIT_DAY_OVERDUE", "credit_day_overdue", "bigint"),
    ("DAYS_CREDIT_ENDDATE", "days_credit_enddate", "double"),
    ("DAYS_CREDIT_UPDATE", "days_credit_update", "bigint"),
    ("AMT_CREDIT_SUM", "amt_credit_sum", "double"),
    ("AMT_CREDIT_SUM_DEBT", "amt_credit_sum_debt", "double"),
    ("AMT_CREDIT_SUM_LIMIT", "amt_credit_sum_limit", "double"),
    ("AMT_CREDIT_SUM_OVERDUE", "amt_credit_sum_overdue", "double"),
    ("CREDIT_TYPE", "credit_type", "string"),
    ("CNT_CREDIT_PROLONG", "cnt_credit_prolong", "bigint"),
    ("ingestion_date", "ingestion_date", "date"),
)
STG_BUREAU_BALANCE = (
    ("SK_ID_BUREAU", "sk_id_bureau", "bigint"),
    ("STATUS", "status", "string"),
    ("ingestion_date", "ingestion_date", "date"),
)
STG_INSTALLMENTS = (
    ("SK_ID_PREV", "sk_id_prev", "bigint"),
    ("SK_ID_CURR", "sk_id_curr", "bigint"),
    ("NUM_INSTALMENT_VERSION", "num_instalment_version", "double"),
    ("NUM_INSTALMENT_NUMBER", "num_instalment_number", "double"),
    ("DAYS_INSTALMENT", "days_instalment", "double"),
    ("DAYS_ENTRY_PAYMENT", "days_entry_payment", "double"),
    ("AMT_INSTALMENT", "amt_instalment", "double"),
    ("AMT_PAYMENT", "amt_payment", "double"),
    ("ingestion_date", "ingestion_date", "date"),
)


def stage(silver: DataFrame, mapping: tuple, key: str) -> DataFrame:
    """Typed, renamed rows with a non-NULL key."""
    return conform(silver.filter(F.col(key).isNotNull()), mapping)


def stg_application(silver: DataFrame) -> DataFrame:
    return stage(silver, STG_APPLICATION, "SK_ID_CURR")


def stg_bureau(silver: DataFrame) -> DataFrame:
    return stage(silver, STG_BUREAU, "SK_ID_BUREAU")


def stg_bureau_balance(silver: DataFrame) -> DataFrame:
    return stage(silver, STG_BUREAU_BALANCE, "SK_ID_BUREAU")


def stg_installments(silver: DataFrame) -> DataFrame:
    return stage(silver, STG_INSTALLMENTS, "SK_ID_PREV")


def applicant_attributes(stg_app: DataFrame) -> DataFrame:
    """What the applicant history follows."""
    return stg_app.select(
        F.col("sk_id_curr").alias("applicant_id"), *TRACKED_ATTRIBUTES, *CARRIED_ATTRIBUTES
    )


def bureau_with_balance(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """Bureau records with their most recent monthly status, where there is one."""
    status = balance.withColumnRenamed("status", "bureau_balance_status")
    return left_lookup(bureau, status, ["sk_id_bureau"], ["bureau_balance_status"])


def installment_payments(stg_inst: DataFrame) -> DataFrame:
    """Payments with days between due and paid; positive is late."""
    return stg_inst.withColumn(
        "days_payment_diff", day_gap("days_entry_payment", "days_instalment")
    )


def dim_applicant(history: DataFrame) -> DataFrame:
    return scd2_present(history, "applicant_id", "applicant_sk")


def dim_loan_type(stg_app: DataFrame, run_ts: datetime | Column) -> DataFrame:
    return dim_from_distinct(
        stg_app, "name_contract_type", run_ts, "loan_type_id", "loan_type_name"
    )


def dim_credit_status(spark: SparkSession, run_ts: datetime | Column) -> DataFrame:
    return dim_static(
        spark, CREDIT_STATUSES, ("status_code", "status_description"), run_ts, "status_id"
    )


def fact_loan_application(
    stg_app: DataFrame, applicants: DataFrame, loan_types: DataFrame
) -> DataFrame:
    """One row per application with the applicant version current at build time."""
    rows = stg_app.select(
        "sk_id_curr",
        "name_contract_type",
        "target_flag",
        "amt_credit",
        "amt_annuity",
        "amt_income_total",
        "ingestion_date",
    )
    rows = lookup_current(rows, applicants, "sk_id_curr", "applicant_id", ["applicant_sk"])
    rows = lookup_small(
        rows, loan_types, "name_contract_type", "loan_type_name", ["loan_type_id"]
    )
    return rows.select(
        surrogate_key("sk_id_curr").alias("loan_application_sk"),
        "applicant_sk",
        "loan_type_id",
        "sk_id_curr",
        "target_flag",
        "amt_credit",
        "amt_annuity",
        "amt_income_total",
        safe_ratio("amt_income_total", "amt_credit").alias("income_to_credit_ratio"),
        "ingestion_date",
    )


def fact_bureau_credit(
    bureau: DataFrame, balance: DataFrame, applicants: DataFrame, statuses: DataFrame
) -> DataFrame:
    """One row per bureau record."""
    rows = bureau.select(
        "sk_id_curr",
        "sk_id_bureau",
        "credit_active",
        "credit_day_overdue",
        "amt_credit_sum",
        "amt_credit_sum_debt",
        "credit_type",
        "ingestion_date",
    )
    rows = bureau_with_balance(rows, balance)
    rows = lookup_current(rows, applicants, "sk_id_curr", "applicant_id", ["applicant_sk"])
    # The status dimension is the fixed list of codes, hence bounded.
    rows = lookup_small(
        rows,
        statuses,
        "credit_active",
        "status_code",
        {"status_id": "credit_status_id"},
        bounded=True,
    )
    return rows.select(
        surrogate_key("sk_id_bureau").alias("bureau_credit_sk"),
        "applicant_sk",
        "sk_id_curr",
        "sk_id_bureau",
        "credit_status_id",
        "credit_day_overdue",
        "amt_credit_sum",
        "amt_credit_sum_debt",
        "credit_type",
        "bureau_balance_status",
        "ingestion_date",
    )


def fact_installment_payment(stg_inst: DataFrame) -> DataFrame:
    """One row per instalment payment; the instalment number enters the key as an integer."""
    return installment_payments(stg_inst).select(
        surrogate_key("sk_id_prev", F.col("num_instalment_number").cast("bigint")).alias(
            "payment_sk"
        ),
        "sk_id_curr",
        "sk_id_prev",
        "num_instalment_number",
        "days_instalment",
        "days_entry_payment",
        "amt_instalment",
        "amt_payment",
        "days_payment_diff",
        "ingestion_date",
    )


def loan_star(fact: DataFrame, applicants: DataFrame, loan_types: DataFrame) -> DataFrame:
    """Loan fact with applicant segments and the loan type's name, for segment KPIs."""
    rows = lookup_current(
        fact,
        applicants,
        "applicant_sk",
        "applicant_sk",
        ["name_income_type", "name_education_type", "name_family_status", "days_employed_masked"],
    )
    return with_loan_type(rows, loan_types)


def with_loan_type(fact: DataFrame, loan_types: DataFrame) -> DataFrame:
    """Loan fact with the loan type's name, all that the headline summary needs."""
    return lookup_small(fact, loan_types, "loan_type_id", "loan_type_id", ["loan_type_name"])


def with_employment(loans: DataFrame, stg_app: DataFrame) -> DataFrame:
    """Loans with what the applicant does and for whom, for employment segments."""
    employment = ["occupation_type", "organization_type"]
    return left_lookup(loans, stg_app.select("sk_id_curr", *employment), ["sk_id_curr"], employment)


def applicant_features(
    applicants: DataFrame, bureau: DataFrame, previous: DataFrame, payments: DataFrame
) -> DataFrame:
    """One row per applicant: bureau records, previous applications, punctuality.

    Every part is reduced to the applicant before it is joined.
    """
    records = bureau.groupBy("sk_id_curr").agg(
        F.count(F.lit(1)).alias("bureau_records"),
        exact_sum("amt_credit_sum").cast("double").alias("bureau_exposure"),
        F.count_if(F.col("credit_day_overdue") > 0).alias("overdue_records"),
    )
    paid = payments.groupBy("sk_id_curr").agg(
        F.count(F.lit(1)).alias("payments"),
        exact_avg("days_payment_diff").alias("avg_days_payment_diff"),
    )
    counted = count_per(previous, "sk_id_curr", "previous_applications")
    return join_features(applicants, "sk_id_curr", [records, counted, paid])
