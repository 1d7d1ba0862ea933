"""Catalogue of the source tables: schema, keys, cleaning rules and staging names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

TYPES = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

# Lineage columns every landed table carries.
METADATA = ("ingestion_ts", "ingestion_date")


@dataclass(frozen=True)
class TableSpec:
    """Everything the generic jobs need to know about one source table."""

    name: str
    files: tuple[str, ...]
    columns: Mapping[str, str]
    primary_key: str
    silver_name: str
    dedup_keys: tuple[str, ...] = ()
    upsert_keys: tuple[str, ...] = ()
    keep: tuple[str, ...] = ()
    sentinels: Mapping[str, Any] = field(default_factory=dict)
    masked: tuple[str, ...] = ()
    only: Mapping[str, Any] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    # Text that means NULL in the file, and whether quoted fields may span lines (then a file is
    # read by one task).
    null_token: str = ""
    multi_line: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, TYPES[t]) for n, t in self.columns.items()])

    @property
    def bronze_schema(self) -> T.StructType:
        """Schema of a landed row, as stored."""
        return (
            self.schema.add("ingestion_ts", T.TimestampType())
            .add("source_file", T.StringType())
            .add("batch_id", T.StringType())
            .add("env", T.StringType())
            .add("reasons", T.ArrayType(T.StringType()))
            .add("raw", T.StringType())
        )

    @property
    def silver_columns(self) -> tuple[str, ...]:
        """Kept columns in order, metadata last."""
        return (self.keep or tuple(self.columns)) + METADATA


# File names, keys, kept columns and sentinels of the seven source tables.
APPLICATION = TableSpec(
    name="application_train",
    files=("application_train_dev_1000rows.csv", "application_train.csv"),
    columns={
        "SK_ID_CURR": "long",
        "TARGET": "long",
        "NAME_CONTRACT_TYPE": "string",
        "AMT_CREDIT": "double",
        "AMT_ANNUITY": "double",
        "AMT_INCOME_TOTAL": "double",
        "AMT_GOODS_PRICE": "double",
        "NAME_INCOME_TYPE": "string",
        "NAME_EDUCATION_TYPE": "string",
        "NAME_FAMILY_STATUS": "string",
        "NAME_HOUSING_TYPE": "string",
        "DAYS_BIRTH": "long",
        "DAYS_EMPLOYED": "long",
        "FLAG_OWN_CAR": "string",
        "FLAG_OWN_REALTY": "string",
        "CNT_CHILDREN": "long",
        "OCCUPATION_TYPE": "string",
        "ORGANIZATION_TYPE": "string",
        "REGION_RATING_CLIENT": "long",
        "EXT_SOURCE_1": "double",
        "EXT_SOURCE_2": "double",
        "EXT_SOURCE_3": "double",
    },
    primary_key="SK_ID_CURR",
    silver_name="silver_application",
    dedup_keys=("SK_ID_CURR",),
    upsert_keys=("SK_ID_CURR",),
    sentinels={"ORGANIZATION_TYPE": "XNA", "DAYS_EMPLOYED": 365243},
    masked=("DAYS_BIRTH", "DAYS_EMPLOYED"),
)

BUREAU = TableSpec(
    name="bureau",
    files=("bureau.csv",),
    columns={
        "SK_ID_CURR": "long",
        "SK_ID_BUREAU": "long",
        "CREDIT_ACTIVE": "string",
        "CREDIT_CURRENCY": "string",
        "DAYS_CREDIT": "long",
        "CREDIT_DAY_OVERDUE": "long",
        "DAYS_CREDIT_ENDDATE": "double",
        "DAYS_CREDIT_UPDATE": "long",
        "AMT_CREDIT_SUM": "double",
        "AMT_CREDIT_SUM_DEBT": "double",
        "AMT_CREDIT_SUM_LIMIT": "double",
        "AMT_CREDIT_SUM_OVERDUE": "double",
        "CREDIT_TYPE": "string",
        "CNT_CREDIT_PROLONG": "long",
    },
    primary_key="SK_ID_BUREAU",
    silver_name="silver_bureau",
    dedup_keys=("SK_ID_BUREAU",),
    upsert_keys=("SK_ID_BUREAU",),
)

BUREAU_BALANCE = TableSpec(
    name="bureau_balance",
    files=("bureau_balance.csv",),
    columns={"SK_ID_BUREAU": "long", "MONTHS_BALANCE": "long", "STATUS": "string"},
    primary_key="SK_ID_BUREAU",
    silver_name="silver_bureau_balance",
    dedup_keys=("SK_ID_BUREAU",),
    upsert_keys=("SK_ID_BUREAU",),
    keep=("SK_ID_BUREAU", "STATUS"),
    only={"MONTHS_BALANCE": 0},
    cluster_by=("MONTHS_BALANCE",),
)

PREVIOUS_APPLICATION = TableSpec(
    name="previous_application",
    files=("previous_application.csv",),
    columns={
        "SK_ID_PREV": "long",
        "SK_ID_CURR": "long",
        "NAME_CONTRACT_TYPE": "string",
        "AMT_CREDIT": "double",
        "AMT_APPLICATION": "double",
        "NAME_CONTRACT_STATUS": "string",
        "DAYS_DECISION": "long",
        "NAME_PRODUCT_TYPE": "string",
    },
    primary_key="SK_ID_PREV",
    silver_name="silver_previous_application",
    upsert_keys=("SK_ID_PREV",),
)

INSTALLMENTS = TableSpec(
    name="installments_payments",
    files=("installments_payments.csv",),
    columns={
        "SK_ID_PREV": "long",
        "SK_ID_CURR": "long",
        "NUM_INSTALMENT_VERSION": "double",
        "NUM_INSTALMENT_NUMBER": "double",
        "DAYS_INSTALMENT": "double",
        "DAYS_ENTRY_PAYMENT": "double",
        "AMT_INSTALMENT": "double",
        "AMT_PAYMENT": "double",
    },
    primary_key="SK_ID_PREV",
    silver_name="silver_installments",
    dedup_keys=("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"),
    upsert_keys=("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"),
)

POS_CASH = TableSpec(
    name="POS_CASH_balance",
    files=("POS_CASH_balance.csv",),
    columns={
        "SK_ID_PREV": "long",
        "SK_ID_CURR": "long",
        "MONTHS_BALANCE": "long",
        "CNT_INSTALMENT": "double",
        "CNT_INSTALMENT_FUTURE": "double",
        "NAME_CONTRACT_STATUS": "string",
        "SK_DPD": "long",
        "SK_DPD_DEF": "long",
    },
    primary_key="SK_ID_PREV",
    silver_name="silver_pos_cash",
)

CREDIT_CARD = TableSpec(
    name="credit_card_balance",
    files=("credit_card_balance.csv",),
    columns={
        "SK_ID_PREV": "long",
        "SK_ID_CURR": "long",
        "MONTHS_BALANCE": "long",
        "AMT_BALANCE": "double",
        "AMT_CREDIT_LIMIT_ACTUAL": "double",
        "AMT_DRAWINGS_CURRENT": "double",
        "AMT_PAYMENT_CURRENT": "double",
        "SK_DPD": "long",
        "NAME_CONTRACT_STATUS": "string",
    },
    primary_key="SK_ID_PREV",
    silver_name="silver_credit_card",
)

SOURCES = {
    spec.name: spec
    for spec in (
        APPLICATION,
        BUREAU,
        BUREAU_BALANCE,
        PREVIOUS_APPLICATION,
        INSTALLMENTS,
        POS_CASH,
        CREDIT_CARD,
    )
}

# Bureau credit status codes and their descriptions.
CREDIT_STATUSES = (
    ("Active", "Active bureau credit line"),
    ("Closed", "Closed bureau credit line"),
    ("Bad debt", "Bureau credit in bad debt status"),
    ("Sold", "Bureau credit sold to third party"),
)

# Applicant attributes whose change opens a new history version,
# and those carried along without being compared.
TRACKED_ATTRIBUTES = (
    "name_income_type",
    "name_education_type",
    "name_family_status",
    "cnt_children",
)
CARRIED_ATTRIBUTES = ("days_birth_masked", "days_employed_masked")
