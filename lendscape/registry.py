"""Queries over the given tables, each with the SQL that must return the same rows.

The tables stand in for the loan data: customer is the applicant, orders the application,
lineitem the bureau record, balance or instalment, events the change log.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.functions import keyed_mask, mask, percent, sentinel_to_null, surrogate_key
from lendscape.operators import kpi, lookup, partials, ranking, shape
from lendscape.operators import quality as q
from lendscape.operators.dims import dim_from_distinct, dim_static
from lendscape.operators.history import (
    not_exactly_one_current,
    open_versions,
    scd2_apply,
    scd2_from_log,
    scd2_present,
)
from lendscape.operators.latest import latest_per_key
from lendscape.operators.upsert import upsert
from lendscape.plans import gold, silver, suites
from lendscape.sources import landing, store
from lendscape.sources.store import settle
from lendscape.streaming.upserts import upsert_files
from lendscape.specs import (
    APPLICATION,
    BUREAU,
    BUREAU_BALANCE,
    CARRIED_ATTRIBUTES,
    CREDIT_CARD,
    CREDIT_STATUSES,
    INSTALLMENTS,
    POS_CASH,
    PREVIOUS_APPLICATION,
    TRACKED_ATTRIBUTES,
    TableSpec,
)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register the decorated function under its own name."""

    def add(fn):
        QUERIES[fn.__name__] = Query(fn, sql)
        return fn

    return add


# Columns of the given tables; naming them saves a footer-reading job per scan.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def moment(text: str) -> Column:
    """Timestamp literal independent of any time zone setting."""
    return F.lit(text).cast("timestamp_ntz")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating-point columns whose last digits depend on the order of summation."""
    return df.withColumns(
        {name: F.round(name, digits) for name, kind in df.dtypes if kind == "double"}
    )


RUN_TS = "2026-05-12 00:00:00"
RUN_TS_SQL = f"TIMESTAMP '{RUN_TS}'"
_DAYS = (datetime(2026, 5, 12), datetime(2026, 5, 13))
FIRST_SNAPSHOT, SECOND_SNAPSHOT = "1998-07-01 00:00:00", "2002-01-01 00:00:00"


# --- Column operators -----------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def subset_existing(spark, sf):
    keep = ["o_orderkey", "no_such_column", "o_totalprice", "o_orderstatus"]
    return shape.select_existing(table(spark, sf, "orders"), keep)


@query(
    "SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders"
)
def sentinel_null_string(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return shape.null_sentinels(orders, {"o_orderpriority": "4-NOT SPECIFIED"})


@query(
    "SELECT p_partkey, nullif(p_size, 25) AS p_size, coalesce(p_size = 25, false) AS p_size_anomaly "
    "FROM part"
)
def sentinel_null_flagged(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    return shape.null_sentinels(part, {"p_size": 25}, flag_suffix="_anomaly")


@query(
    "SELECT p_partkey, sha256(cast(nullif(p_size, 25) AS varchar)) AS p_size_masked FROM part"
)
def sentinel_null_numeric_masked(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    return shape.mask_columns(shape.null_sentinels(part, {"p_size": 25}), ["p_size"], "_masked")


@query(
    "SELECT c_custkey, c_mktsegment, sha256(cast(c_nationkey AS varchar)) AS c_nationkey_masked, "
    "sha256(c_name) AS c_name_masked FROM customer"
)
def mask_pii(spark, sf):
    customer = table(spark, sf, "customer")
    named = customer.withColumn("c_name_masked", mask("c_name", integral=False))
    return shape.mask_columns(named, ["c_nationkey"], "_masked").drop("c_name", "c_acctbal")


@query(
    "SELECT p_partkey, sha256(concat('pepper', cast(p_size AS varchar))) AS p_size_masked FROM part"
)
def mask_salted(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    return shape.mask_columns(part, ["p_size"], "_masked", salt="pepper")


def _hmac_sql(key: str, text: str) -> str:
    block = key.encode().ljust(64, b"\0")
    inner, outer = ("unhex('" + bytes(b ^ pad for b in block).hex() + "')" for pad in (0x36, 0x5C))
    return f"sha256({outer} || unhex(sha256({inner} || encode({text}))))"


@query(
    f"SELECT c_custkey, {_hmac_sql('a secret', 'c_name')} AS c_name_masked, "
    f"{_hmac_sql('a secret', 'cast(c_nationkey AS varchar)')} AS c_nationkey_masked FROM customer"
)
def mask_keyed(spark, sf):
    """Personal columns under a keyed digest."""
    return table(spark, sf, "customer").select(
        "c_custkey",
        keyed_mask("c_name", b"a secret", integral=False).alias("c_name_masked"),
        keyed_mask("c_nationkey", b"a secret").alias("c_nationkey_masked"),
    )


@query(
    f"SELECT o_orderkey, {RUN_TS_SQL} AS ingestion_ts, DATE '2026-05-12' AS ingestion_date, "
    "'b1' AS batch_id, 'dev' AS env FROM orders"
)
def metadata_stamp(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return shape.stamp(orders, moment(RUN_TS), date(2026, 5, 12), "b1", "dev")


@query(
    "SELECT o_orderkey AS sk_id_curr, cast(o_totalprice AS double) AS amt_credit, "
    "cast(o_orderkey AS varchar) AS application_code, cast(o_orderdate AS date) AS ingestion_date, "
    "cast(o_orderkey AS double) AS key_as_double FROM orders"
)
def conform_types(spark, sf):
    return shape.conform(
        table(spark, sf, "orders"),
        [
            ("o_orderkey", "sk_id_curr", "bigint"),
            ("o_totalprice", "amt_credit", "double"),
            ("o_orderkey", "application_code", "string"),
            ("o_orderdate", "ingestion_date", "date"),
            ("o_orderkey", "key_as_double", "double"),
        ],
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def first_n_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return shape.sample_first(orders, 100, ["o_orderkey"])


# --- Quarantine -----------------------------------------------------------------------------



def _customer_rules() -> dict[str, Column]:
    return {
        "NON_POSITIVE_BALANCE": F.col("c_acctbal") <= 0,
        "NATION_ZERO": F.col("c_nationkey") == 0,
    }


_CUSTOMER_REASONS = (
    "concat_ws(',', CASE WHEN c_acctbal <= 0 THEN 'NON_POSITIVE_BALANCE' END, "
    "CASE WHEN c_nationkey = 0 THEN 'NATION_ZERO' END)"
)


@query(
    f"SELECT * FROM (SELECT c_custkey, c_acctbal, {_CUSTOMER_REASONS} AS reasons FROM customer) "
    "WHERE reasons <> ''"
)
def quarantine_split(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    _, quarantine = shape.split_quarantine(customer, _customer_rules())
    return quarantine.drop("c_nationkey").withColumn("reasons", F.array_join("reasons", ","))


@query(
    f"SELECT c_custkey, c_acctbal FROM customer WHERE {_CUSTOMER_REASONS} = ''"
)
def quarantine_clean(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    clean, _ = shape.split_quarantine(customer, _customer_rules())
    return clean.drop("c_nationkey")


@query(
    "SELECT c_mktsegment, count(*) AS rows_read, "
    f"count(*) FILTER (WHERE {_CUSTOMER_REASONS} = '') AS rows_clean, "
    f"count(*) FILTER (WHERE {_CUSTOMER_REASONS} <> '') AS rows_quarantined "
    "FROM customer GROUP BY c_mktsegment"
)
def quarantine_counts(spark, sf):
    flagged = shape.flag_broken(table(spark, sf, "customer"), _customer_rules())
    return flagged.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.size("reasons") == 0).alias("rows_clean"),
        F.count_if(F.size("reasons") > 0).alias("rows_quarantined"),
    )


# --- Landing and storage --------------------------------------------------------------------


_LANDED_CUSTOMER = TableSpec(
    name="customer",
    files=("customer_sample.csv", "customer.csv"),
    columns={
        "c_custkey": "long",
        "c_name": "string",
        "c_nationkey": "long",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    primary_key="c_custkey",
    silver_name="customer",
)


def _land_customers(spark, sf) -> tuple[str, landing.IngestResult]:
    """Export customers as CSV, without the key in nation 3 and with a broken balance in nation 5."""
    folder = store.scratch(spark)
    broken = F.when(F.col("c_nationkey") == 5, F.lit("n/a"))
    exported = table(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).alias("c_custkey"),
        F.coalesce(broken, F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
        "c_name",
        "c_nationkey",
    )
    exported.write.option("header", True).csv(f"{folder}/in/customer.csv")
    result = landing.ingest(
        spark, _LANDED_CUSTOMER, f"{folder}/in", f"{folder}/bronze", _DAYS[0].date(), _DAYS[0]
    )
    return f"{folder}/bronze", result


@query(
    "SELECT c_custkey, c_name, cast(c_nationkey AS bigint) AS c_nationkey, c_acctbal, c_mktsegment, "
    "DATE '2026-05-12' AS ingestion_date FROM customer WHERE c_nationkey NOT IN (3, 5)"
)
def landed_clean(spark, sf):
    bronze, _ = _land_customers(spark, sf)
    day = landing.read_day(spark, bronze, _LANDED_CUSTOMER, _DAYS[0].date())
    return shape.select_existing(day, [*_LANDED_CUSTOMER.columns, "ingestion_date"])


@query(
    "SELECT c_name, CASE c_nationkey WHEN 3 THEN 'NULL_KEY:c_custkey' ELSE 'MALFORMED_ROW' END "
    "AS reasons, c_nationkey = 5 AS has_text FROM customer WHERE c_nationkey IN (3, 5)"
)
def landed_quarantine(spark, sf):
    bronze, _ = _land_customers(spark, sf)
    bad = landing.read_day(
        spark, bronze, _LANDED_CUSTOMER, _DAYS[0].date(), landing.QUARANTINE
    )
    return bad.select(
        "c_name",
        F.array_join("reasons", ",").alias("reasons"),
        F.coalesce(F.col("raw").contains(F.col("c_name")), F.lit(False)).alias("has_text"),
    )


@query(
    "SELECT 'customer' AS table_name, count(*) FILTER (WHERE c_nationkey NOT IN (3, 5)) AS rows_written, "
    "count(*) FILTER (WHERE c_nationkey IN (3, 5)) AS quarantine_rows, count(*) AS rows_read "
    "FROM customer"
)
def landed_counts(spark, sf):
    _, result = _land_customers(spark, sf)
    return spark.createDataFrame(
        [(result.table, result.rows_written, result.quarantine_rows, result.rows_read)],
        "table_name string, rows_written long, quarantine_rows long, rows_read long",
    )


@query(
    """
    WITH first AS (SELECT * FROM orders WHERE o_orderstatus <> 'O'),
         second AS (SELECT * REPLACE (o_totalprice + 100 AS o_totalprice) FROM orders
                    WHERE o_orderstatus <> 'F')
    SELECT * FROM first WHERE o_orderkey NOT IN (SELECT o_orderkey FROM second)
    UNION ALL SELECT * FROM second
    """
)
def stored_upsert(spark, sf):
    """Two days published one after the other, the second one twice."""
    root = f"{store.scratch(spark)}/orders"
    orders = table(spark, sf, "orders")
    first = orders.filter(F.col("o_orderstatus") != "O")
    second = orders.filter(F.col("o_orderstatus") != "F").withColumn(
        "o_totalprice", F.col("o_totalprice") + 100
    )
    store.publish_upsert(spark, root, first, ["o_orderkey"], "2026-05-12")
    for _ in range(2):
        store.publish_upsert(spark, root, second, ["o_orderkey"], "2026-05-13")
    return store.read_keyed(spark, root, ["o_orderkey"])


@query(
    """
    WITH first AS (SELECT * FROM orders WHERE o_orderstatus = 'P'),
         second AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
                    WHERE o_orderpriority = '1-URGENT'),
         third AS (SELECT * REPLACE (o_totalprice + 100 AS o_totalprice) FROM orders
                   WHERE o_orderstatus = 'O')
    SELECT * FROM third
    UNION ALL SELECT * FROM second WHERE o_orderkey NOT IN (SELECT o_orderkey FROM third)
    UNION ALL SELECT * FROM first WHERE o_orderkey NOT IN (SELECT o_orderkey FROM third)
      AND o_orderkey NOT IN (SELECT o_orderkey FROM second)
    """
)
def stored_upsert_backdated(spark, sf):
    """Three days of which the middle one comes last."""
    root, orders = f"{store.scratch(spark)}/orders", table(spark, sf, "orders")
    dearer = lambda df, by: df.withColumn("o_totalprice", F.col("o_totalprice") + by)
    days = (
        ("2026-05-10", orders.filter("o_orderstatus = 'P'")),
        ("2026-05-12", dearer(orders.filter("o_orderstatus = 'O'"), 100)),
        ("2026-05-11", dearer(orders.filter("o_orderpriority = '1-URGENT'"), 1)),
    )
    for label, rows in days:
        store.publish_upsert(spark, root, rows, ["o_orderkey"], label)
    return store.read_keyed(spark, root, ["o_orderkey"])


def _dearer_first(orders):
    """The order with the smallest key, at a higher price."""
    one = orders.join(orders.agg(F.min("o_orderkey").alias("o_orderkey")), "o_orderkey")
    return one.withColumn("o_totalprice", F.col("o_totalprice") + 100)


@query(
    """
    WITH changed AS (SELECT min(o_orderkey) AS k FROM orders)
    SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey = k THEN 100 ELSE 0 END AS o_totalprice,
           cast(7 AS bigint) AS files_kept, cast(1 AS bigint) AS files_written
    FROM orders, changed
    """
)
def stored_upsert_buckets(spark, sf):
    """A second day with one key: seven of eight buckets keep their files."""
    root = f"{store.scratch(spark)}/orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    store.merge_buckets(spark, root, orders, ["o_orderkey"], 8)
    before = set(store.read_buckets(spark, root, orders.schema).inputFiles())
    store.merge_buckets(spark, root, _dearer_first(orders), ["o_orderkey"], 8)
    state = store.read_buckets(spark, root, orders.schema)
    after = set(state.inputFiles())
    return state.withColumns(
        {
            "files_kept": F.lit(len(before & after)).cast("long"),
            "files_written": F.lit(len(after - before)).cast("long"),
        }
    )


@query(
    """
    WITH changed AS (SELECT min(o_orderkey) AS k FROM orders)
    SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey = k THEN 100 ELSE 0 END AS o_totalprice
    FROM orders, changed
    """
)
def stored_upsert_folded(spark, sf):
    """A folded base, and a second day with one key read over it."""
    root = f"{store.scratch(spark)}/orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    store.publish_upsert(spark, root, orders, ["o_orderkey"], "2026-05-12")
    store.fold(spark, root, ["o_orderkey"], "2026-05-12")
    store.publish_upsert(spark, root, _dearer_first(orders), ["o_orderkey"], "2026-05-13")
    return store.read_keyed(spark, root, ["o_orderkey"])


@query(
    """
    SELECT strftime(o_orderdate, '%Y-%m-01') AS day, o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
          ORDER BY o_orderdate DESC, o_orderkey) AS in_month
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') WHERE in_month = 1) WHERE rn = 1
    """
)
def stored_upsert_months(spark, sf):
    """A customer's newest order, merged month by month with folding on the way."""
    root, orders = f"{store.scratch(spark)}/newest", table(spark, sf, "orders")
    recent = settle(
        orders.filter(F.col("o_orderdate") >= moment("1998-01-01 00:00:00")).withColumn(
            "day", F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd")
        )
    )
    for (day,) in sorted(recent.select("day").distinct().collect()):
        month = latest_per_key(recent.filter(F.col("day") == day), ["o_custkey"], "o_orderdate", ["o_orderkey"])
        rows = month.select("day", "o_custkey", "o_orderkey", "o_totalprice")
        store.publish_upsert(spark, root, rows, ["o_custkey"], day, fold_after=3)
    return store.read_keyed(spark, root, ["o_custkey"])


@query(
    "SELECT *, DATE '2026-05-12' AS load FROM orders WHERE o_orderstatus = 'F' UNION ALL "
    "SELECT *, DATE '2026-05-13' FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"
)
def stored_day_replaced(spark, sf):
    """A keyless table of two days: landing the second again replaces it and leaves the first."""
    root, orders = f"{store.scratch(spark)}/orders", table(spark, sf, "orders")
    store.write_run(orders.filter("o_orderstatus = 'F'"), root, "load", "2026-05-12")
    store.write_run(orders, root, "load", "2026-05-13")
    recent = orders.filter(F.col("o_orderdate") >= moment("1998-01-01 00:00:00"))
    store.write_run(recent, root, "load", "2026-05-13")
    return store.read_runs(spark, root, "load", store.run_labels(spark, root, "load"))


@query(
    "SELECT CASE WHEN c_nationkey IN (3, 5) THEN 'quarantine' ELSE 'clean' END AS zone, "
    "'customer.csv' AS source_file, count(*) AS n FROM customer GROUP BY 1"
)
def landed_source_file(spark, sf):
    """Lineage of landed rows: the folder the file came from."""
    bronze, _ = _land_customers(spark, sf)
    rows = [
        landing.read_day(spark, bronze, _LANDED_CUSTOMER, _DAYS[0].date(), zone).select(
            F.lit(zone).alias("zone"),
            F.element_at(F.split("source_file", "/"), -2).alias("source_file"),
        )
        for zone in (landing.CLEAN, landing.QUARANTINE)
    ]
    return rows[0].unionByName(rows[1]).groupBy("zone", "source_file").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "SELECT 'customer' AS table_name, 'row_count_equals' AS check_name, '*' AS column_name, "
    "'FAIL' AS severity, count(*) FILTER (WHERE c_nationkey IN (3, 5)) AS failed_rows, "
    "count(*) FILTER (WHERE c_nationkey NOT IN (3, 5)) AS total_rows, "
    "CASE WHEN count(*) FILTER (WHERE c_nationkey IN (3, 5)) > 0 THEN 'FAIL' ELSE 'PASS' END AS status "
    "FROM customer"
)
def dq_expected_count(spark, sf):
    """Landed clean rows against the source's own count, which quarantined rows fall short of."""
    bronze, _ = _land_customers(spark, sf)
    expected = table(spark, sf, "customer").count()
    day = landing.read_day(spark, bronze, _LANDED_CUSTOMER, _DAYS[0].date())
    return q.check(day, "customer", [q.row_count_equals(expected)])


@query(
    "SELECT 'none' AS table_name, 'present' AS check_name, '*' AS column_name, 'FAIL' AS severity, "
    "cast(0 AS bigint) AS failed_rows, cast(0 AS bigint) AS total_rows, 'SKIPPED' AS status "
    "UNION ALL SELECT 'orders', 'greater_than', 'o_totalprice', 'WARN', "
    "count(*) FILTER (WHERE o_totalprice <= 100000), count(*), "
    "CASE WHEN count(*) FILTER (WHERE o_totalprice <= 100000) > 0 THEN 'WARN' ELSE 'PASS' END FROM orders "
    "UNION ALL SELECT 'orders', 'not_in_set', 'o_orderstatus', 'FAIL', "
    "count(*) FILTER (WHERE o_orderstatus = 'P'), count(*), "
    "CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'FAIL' ELSE 'PASS' END FROM orders"
)
def dq_statuses(spark, sf):
    """A missing table, a warning and a failure as result rows of one evaluation."""
    suites_ = {
        "none": [q.not_null("x")],
        "orders": [q.greater_than("o_totalprice", 100_000, q.WARN), q.not_in_set("o_orderstatus", ["P"])],
    }
    return q.evaluate(spark, {"none": None, "orders": table(spark, sf, "orders")}, suites_)


@query(
    "SELECT p_brand, count(*) AS parts, min(p_retailprice) AS cheapest FROM part GROUP BY p_brand"
)
def staged_view(spark, sf):
    """A staged view read by name in SQL."""
    store.materialise(table(spark, sf, "part"), "stg_part", "view")
    return spark.sql(
        "SELECT p_brand, count(*) AS parts, min(p_retailprice) AS cheapest FROM stg_part GROUP BY p_brand"
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 100 END AS o_totalprice,
           o_orderdate FROM orders
    """
)
def streamed_upsert(spark, sf):
    """Files of a folder merged batch by batch, then more files by a second call."""
    folder, orders = store.scratch(spark), table(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    dearer = orders.filter("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 100).alias("o_totalprice"), "o_orderdate"
    )
    for part in (rows, dearer):
        part.repartition(2).write.mode("append").parquet(f"{folder}/in")
        upsert_files(
            spark, f"{folder}/in", rows.schema, f"{folder}/orders", ["o_orderkey"], "o_orderdate",
            f"{folder}/checkpoint", files_per_batch=1, fold_after=3,
        )
    return store.read_keyed(spark, f"{folder}/orders", ["o_orderkey"])


# --- Latest per key -------------------------------------------------------------------------


@query(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1"
)
def latest_event_per_user(spark, sf):
    return latest_per_key(table(spark, sf, "events"), ["user_id"], "ts", ["event_id"])


_LATEST_LINES = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1"
)


def latest_lines(spark, sf):
    return latest_per_key(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        ["l_partkey", "l_suppkey"],
    )


@query(_LATEST_LINES)
def latest_per_composite_key(spark, sf):
    return latest_lines(spark, sf)


@query(
    "SELECT l_orderkey, l_linestatus, l_returnflag, l_shipdate FROM (SELECT *, row_number() OVER "
    "(PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS rn "
    "FROM lineitem WHERE l_linestatus = 'O') WHERE rn = 1"
)
def filter_then_latest(spark, sf):
    lines = table(spark, sf, "lineitem").filter(F.col("l_linestatus") == "O")
    latest = latest_per_key(
        lines, ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_partkey", "l_suppkey"]
    )
    return latest.select("l_orderkey", "l_linestatus", "l_returnflag", "l_shipdate")


# --- Source-shaped rows and their Silver form -----------------------------------------------


def bronze_application(spark, sf):
    """Lineitem versions of an order as repeatedly landed applications."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_CURR"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("TARGET"),
        F.col("l_linestatus").alias("NAME_CONTRACT_TYPE"),
        F.col("l_extendedprice").alias("AMT_CREDIT"),
        F.col("l_quantity").alias("AMT_ANNUITY"),
        (-F.col("l_partkey")).alias("DAYS_BIRTH"),
        F.when(F.col("l_linenumber") == 4, F.lit(365243).cast("long"))
        .otherwise(-F.col("l_suppkey"))
        .alias("DAYS_EMPLOYED"),
        F.when(F.col("l_returnflag") == "N", F.lit("XNA"))
        .otherwise(F.col("l_returnflag"))
        .alias("ORGANIZATION_TYPE"),
        F.col("l_tax").alias("NOT_KEPT"),
        F.col("l_shipdate").alias("ingestion_ts"),
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
    )


_APPLICATION_TIES = ("AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "DAYS_EMPLOYED")


@query(
    """
    WITH landed AS (
      SELECT l_orderkey AS SK_ID_CURR,
             cast(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS bigint) AS TARGET,
             l_linestatus AS NAME_CONTRACT_TYPE, l_extendedprice AS AMT_CREDIT,
             l_quantity AS AMT_ANNUITY, nullif(l_returnflag, 'N') AS ORGANIZATION_TYPE,
             l_shipdate AS ingestion_ts, cast(l_shipdate AS date) AS ingestion_date,
             -l_partkey AS birth,
             CASE WHEN l_linenumber = 4 THEN 365243 ELSE -l_suppkey END AS employed
      FROM lineitem)
    SELECT * EXCLUDE (rn, birth, employed), sha256(cast(birth AS varchar)) AS DAYS_BIRTH_MASKED,
           sha256(cast(nullif(employed, 365243) AS varchar)) AS DAYS_EMPLOYED_MASKED
    FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY ingestion_ts DESC,
            AMT_CREDIT, AMT_ANNUITY, birth, employed) AS rn FROM landed)
    WHERE rn = 1
    """
)
def silver_application(spark, sf):
    return silver.clean(APPLICATION, bronze_application(spark, sf), tiebreak=_APPLICATION_TIES)


def bronze_bureau(spark, sf):
    """Lineitem versions of an order line as bureau records."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_CURR"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("SK_ID_BUREAU"),
        F.when(F.col("l_linenumber") == 7, "Unlisted")
        .when(flag == "A", "Active")
        .when(flag == "R", "Bad debt")
        .when(status == "F", "Closed")
        .otherwise("Sold")
        .alias("CREDIT_ACTIVE"),
        F.when(flag == "R", F.col("l_linenumber") * 5)
        .otherwise(0)
        .cast("long")
        .alias("CREDIT_DAY_OVERDUE"),
        F.col("l_extendedprice").alias("AMT_CREDIT_SUM"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("AMT_CREDIT_SUM_DEBT"),
        status.alias("CREDIT_TYPE"),
        F.col("l_shipdate").alias("ingestion_ts"),
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
        F.col("l_partkey").alias("NOT_KEPT"),
    )


_BUREAU_TIES = ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "CREDIT_ACTIVE", "CREDIT_TYPE")
_BUREAU_ROWS = """
    SELECT l_orderkey AS SK_ID_CURR, l_orderkey * 10 + l_linenumber AS SK_ID_BUREAU,
           CASE WHEN l_linenumber = 7 THEN 'Unlisted' WHEN l_returnflag = 'A' THEN 'Active'
                WHEN l_returnflag = 'R' THEN 'Bad debt' WHEN l_linestatus = 'F' THEN 'Closed'
                ELSE 'Sold' END AS CREDIT_ACTIVE,
           cast(CASE WHEN l_returnflag = 'R' THEN l_linenumber * 5 ELSE 0 END AS bigint)
             AS CREDIT_DAY_OVERDUE,
           l_extendedprice AS AMT_CREDIT_SUM, l_extendedprice * l_discount AS AMT_CREDIT_SUM_DEBT,
           l_linestatus AS CREDIT_TYPE, l_shipdate AS ingestion_ts,
           cast(l_shipdate AS date) AS ingestion_date
    FROM lineitem"""
_SILVER_BUREAU = f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY SK_ID_BUREAU ORDER BY ingestion_ts DESC,
        AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT, CREDIT_ACTIVE, CREDIT_TYPE) AS rn
      FROM ({_BUREAU_ROWS})) WHERE rn = 1"""


@query(_SILVER_BUREAU)
def silver_bureau(spark, sf):
    return silver.clean(BUREAU, bronze_bureau(spark, sf), tiebreak=_BUREAU_TIES)


def bronze_balance(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("SK_ID_BUREAU"),
        (-(F.col("l_quantity").cast("long") % 3)).alias("MONTHS_BALANCE"),
        F.col("l_returnflag").alias("STATUS"),
        F.col("l_shipdate").alias("ingestion_ts"),
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
    )


_SILVER_BALANCE = """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY SK_ID_BUREAU ORDER BY ingestion_ts DESC, STATUS) AS rn
      FROM (SELECT l_orderkey * 10 + l_linenumber AS SK_ID_BUREAU, l_returnflag AS STATUS,
                   l_shipdate AS ingestion_ts, cast(l_shipdate AS date) AS ingestion_date
            FROM lineitem WHERE cast(l_quantity AS bigint) % 3 = 0)) WHERE rn = 1"""


@query(_SILVER_BALANCE)
def silver_bureau_balance(spark, sf):
    return silver.clean(BUREAU_BALANCE, bronze_balance(spark, sf), tiebreak=["STATUS"])


@query(
    "SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, o_orderpriority AS NAME_CONTRACT_TYPE, "
    "o_totalprice AS AMT_CREDIT, o_orderstatus AS NAME_CONTRACT_STATUS, "
    "cast(o_orderdate AS date) AS ingestion_date FROM orders"
)
def silver_previous_application(spark, sf):
    landed = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        F.col("o_totalprice").alias("AMT_CREDIT"),
        F.col("o_orderstatus").alias("NAME_CONTRACT_STATUS"),
        F.col("o_orderdate").alias("NOT_KEPT"),
        F.col("o_orderdate").cast("date").alias("ingestion_date"),
    )
    return silver.clean(PREVIOUS_APPLICATION, landed)


def bronze_installments(spark, sf):
    """Order lines as instalments: due on the order day, paid on the shipping day."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    start = F.lit("1995-01-01").cast("date")
    lines = table(spark, sf, "lineitem")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.lit(1.0).alias("NUM_INSTALMENT_VERSION"),
        F.col("l_linenumber").cast("double").alias("NUM_INSTALMENT_NUMBER"),
        F.datediff("o_orderdate", start).cast("double").alias("DAYS_INSTALMENT"),
        F.when(
            F.col("l_returnflag") != "N", F.datediff("l_shipdate", start).cast("double")
        ).alias("DAYS_ENTRY_PAYMENT"),
        F.col("l_extendedprice").alias("AMT_INSTALMENT"),
        sentinel_to_null("l_quantity", 50.0).alias("AMT_PAYMENT"),
        F.col("l_shipdate").alias("ingestion_ts"),
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
    )


_INSTALLMENT_TIES = ("AMT_INSTALMENT", "AMT_PAYMENT", "DAYS_ENTRY_PAYMENT")
_SILVER_INSTALLMENTS = """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY SK_ID_PREV, NUM_INSTALMENT_NUMBER
        ORDER BY ingestion_ts DESC, AMT_INSTALMENT, AMT_PAYMENT NULLS FIRST,
        DAYS_ENTRY_PAYMENT NULLS FIRST) AS rn
      FROM (SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
                   cast(1.0 AS double) AS NUM_INSTALMENT_VERSION,
                   cast(l_linenumber AS double) AS NUM_INSTALMENT_NUMBER,
                   cast(date_diff('day', DATE '1995-01-01', cast(o_orderdate AS date)) AS double)
                     AS DAYS_INSTALMENT,
                   CASE WHEN l_returnflag <> 'N' THEN
                     cast(date_diff('day', DATE '1995-01-01', cast(l_shipdate AS date)) AS double)
                   END AS DAYS_ENTRY_PAYMENT,
                   l_extendedprice AS AMT_INSTALMENT, nullif(l_quantity, 50.0) AS AMT_PAYMENT,
                   l_shipdate AS ingestion_ts, cast(l_shipdate AS date) AS ingestion_date
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)) WHERE rn = 1"""


@query(_SILVER_INSTALLMENTS)
def silver_installments(spark, sf):
    return silver.clean(
        INSTALLMENTS, bronze_installments(spark, sf), tiebreak=_INSTALLMENT_TIES
    )


@query(
    "SELECT l_orderkey AS SK_ID_PREV, -cast(l_linenumber AS bigint) AS MONTHS_BALANCE, "
    "l_quantity AS CNT_INSTALMENT, l_linestatus AS NAME_CONTRACT_STATUS, l_suppkey AS SK_DPD, "
    "cast(l_shipdate AS date) AS ingestion_date FROM lineitem"
)
def silver_pos_cash(spark, sf):
    landed = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        (-F.col("l_linenumber").cast("long")).alias("MONTHS_BALANCE"),
        F.col("l_quantity").alias("CNT_INSTALMENT"),
        F.col("l_linestatus").alias("NAME_CONTRACT_STATUS"),
        F.col("l_suppkey").alias("SK_DPD"),
        F.col("l_tax").alias("NOT_KEPT"),
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
    )
    return silver.clean(POS_CASH, landed)


@query(
    "SELECT l_orderkey AS SK_ID_PREV, l_suppkey AS SK_ID_CURR, l_extendedprice AS AMT_BALANCE, "
    "l_quantity AS AMT_DRAWINGS_CURRENT, l_linestatus AS NAME_CONTRACT_STATUS, "
    "cast(l_shipdate AS date) AS ingestion_date FROM lineitem"
)
def silver_credit_card(spark, sf):
    landed = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_suppkey").alias("SK_ID_CURR"),
        F.col("l_extendedprice").alias("AMT_BALANCE"),
        F.col("l_quantity").alias("AMT_DRAWINGS_CURRENT"),
        F.col("l_linestatus").alias("NAME_CONTRACT_STATUS"),
        F.col("l_partkey").alias("NOT_KEPT"),
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
    )
    return silver.clean(CREDIT_CARD, landed)


# --- Keys and type-1 dimensions -------------------------------------------------------------


@query(
    "SELECT md5(concat(coalesce(cast(l_orderkey AS varchar), ''), '|', "
    "coalesce(cast(l_linenumber AS varchar), ''), '|', coalesce(nullif(l_returnflag, 'N'), ''))) "
    "AS line_sk, l_orderkey, l_linenumber, l_partkey FROM lineitem"
)
def surrogate_key_composite(spark, sf):
    return table(spark, sf, "lineitem").select(
        surrogate_key(
            "l_orderkey", "l_linenumber", sentinel_to_null("l_returnflag", "N")
        ).alias("line_sk"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


@query(
    f"SELECT md5(o_orderpriority) AS loan_type_id, o_orderpriority AS loan_type_name, "
    f"{RUN_TS_SQL} AS updated_at FROM (SELECT DISTINCT o_orderpriority FROM orders "
    "WHERE o_orderpriority IS NOT NULL)"
)
def distinct_dim(spark, sf):
    return dim_from_distinct(
        table(spark, sf, "orders"),
        "o_orderpriority",
        moment(RUN_TS),
        "loan_type_id",
        "loan_type_name",
    )


_ORDER_STATUSES = (("F", "finished"), ("O", "open"), ("X", "unused"))


@query(
    f"""
    SELECT md5(code) AS status_id, code AS status_code, description AS status_description,
           {RUN_TS_SQL} AS updated_at, coalesce(n, 0) AS applications
    FROM (VALUES ('F', 'finished'), ('O', 'open'), ('X', 'unused')) AS s(code, description)
    LEFT JOIN (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) ON code = o_orderstatus
    """
)
def inline_dim_status(spark, sf):
    dim = dim_static(
        spark, _ORDER_STATUSES, ("status_code", "status_description"), moment(RUN_TS), "status_id"
    )
    used = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderstatus").alias("status_code"))
        .agg(F.count(F.lit(1)).alias("applications"))
    )
    return lookup.left_lookup(dim, used, ["status_code"], ["applications"]).withColumn(
        "applications", F.coalesce("applications", F.lit(0).cast("long"))
    )


# --- Upsert ---------------------------------------------------------------------------------


@query(
    """
    WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         source AS (SELECT * REPLACE (o_totalprice + 100 AS o_totalprice) FROM orders
                    WHERE o_orderdate >= TIMESTAMP '1997-01-01')
    SELECT * FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
    UNION ALL SELECT * FROM source
    """
)
def upsert_merge(spark, sf):
    orders = table(spark, sf, "orders")
    target = orders.filter(F.col("o_orderdate") < moment("1998-01-01 00:00:00"))
    source = orders.filter(F.col("o_orderdate") >= moment("1997-01-01 00:00:00")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 100
    )
    return upsert(target, source, ["o_orderkey"])


@query(
    f"""
    WITH latest AS ({_LATEST_LINES}),
         target AS (SELECT l_orderkey, l_linenumber, l_quantity FROM latest WHERE l_linestatus = 'F'),
         source AS (SELECT l_orderkey, l_linenumber, l_quantity + 1 AS l_quantity FROM latest
                    WHERE l_returnflag = 'R')
    SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s
      WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
    UNION ALL SELECT * FROM source
    """
)
def upsert_composite(spark, sf):
    latest = latest_lines(spark, sf)
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    target = latest.filter(F.col("l_linestatus") == "F").select(*columns)
    source = (
        latest.filter(F.col("l_returnflag") == "R")
        .select(*columns)
        .withColumn("l_quantity", F.col("l_quantity") + 1)
    )
    return upsert(target, source, ["l_orderkey", "l_linenumber"])


# --- Type-2 history -------------------------------------------------------------------------


def _customer_state(spark, sf, after: bool) -> DataFrame:
    orders = table(spark, sf, "orders")
    border = moment(FIRST_SNAPSHOT)
    part = orders.filter(
        F.col("o_orderdate") >= border if after else F.col("o_orderdate") < border
    )
    latest = latest_per_key(part, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return latest.select(
        F.col("o_custkey").alias("applicant_id"),
        "o_orderpriority",
        "o_orderstatus",
        F.col("o_totalprice").alias("carried_price"),
    )


def _two_snapshots(spark, sf, close_deleted=False) -> DataFrame:
    first = open_versions(_customer_state(spark, sf, after=False), moment(FIRST_SNAPSHOT))
    return scd2_apply(
        first,
        _customer_state(spark, sf, after=True),
        "applicant_id",
        ["o_orderpriority", "o_orderstatus"],
        moment(SECOND_SNAPSHOT),
        close_deleted,
    )


def _two_snapshots_sql(close_deleted: bool) -> str:
    state = (
        "SELECT o_custkey AS applicant_id, o_orderpriority, o_orderstatus, "
        "o_totalprice AS carried_price FROM (SELECT *, row_number() OVER "
        "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn "
        "FROM orders WHERE o_orderdate {op} TIMESTAMP '" + FIRST_SNAPSHOT + "') WHERE rn = 1"
    )
    absent = (
        f"WHEN s2.applicant_id IS NULL THEN TIMESTAMP '{SECOND_SNAPSHOT}'" if close_deleted else ""
    )
    return f"""
    WITH s1 AS ({state.format(op="<")}), s2 AS ({state.format(op=">=")}),
    compared AS (
      SELECT s1.applicant_id AS id1, s2.applicant_id AS id2,
             s1.applicant_id IS NOT NULL AND s2.applicant_id IS NOT NULL AND
             (s1.o_orderpriority IS DISTINCT FROM s2.o_orderpriority OR
              s1.o_orderstatus IS DISTINCT FROM s2.o_orderstatus) AS changed
      FROM s1 FULL OUTER JOIN s2 ON s1.applicant_id = s2.applicant_id)
    SELECT s1.*, TIMESTAMP '{FIRST_SNAPSHOT}' AS valid_from,
           CASE WHEN changed THEN TIMESTAMP '{SECOND_SNAPSHOT}' {absent} END AS valid_to
    FROM s1 JOIN compared ON id1 = s1.applicant_id LEFT JOIN s2 ON s2.applicant_id = s1.applicant_id
    UNION ALL
    SELECT s2.*, TIMESTAMP '{SECOND_SNAPSHOT}', cast(NULL AS timestamp)
    FROM s2 JOIN compared ON id2 = s2.applicant_id WHERE changed OR id1 IS NULL
    """


@query(_two_snapshots_sql(False))
def scd2_two_snapshots(spark, sf):
    return _two_snapshots(spark, sf)


@query(
    _two_snapshots_sql(False)
    .replace(f"'{FIRST_SNAPSHOT}' AS valid_from", "'2026-05-12 00:00:00' AS valid_from")
    .replace(f"'{SECOND_SNAPSHOT}'", "'2026-05-13 00:00:00'")
)
def stored_history(spark, sf):
    """The same two snapshots published as runs of a stored history, the second one twice."""
    root = f"{store.scratch(spark)}/history"
    for after, at in ((False, _DAYS[0]), (True, _DAYS[1]), (True, _DAYS[1])):
        store.publish_history(
            spark,
            root,
            _customer_state(spark, sf, after),
            "applicant_id",
            ["o_orderpriority", "o_orderstatus"],
            at,
        )
    return store.read_history(spark, root, "applicant_id").withColumns(
        {c: F.col(c).cast("string").cast("timestamp_ntz") for c in ("valid_from", "valid_to")}
    )


@query(
    "WITH versions AS ("
    + _two_snapshots_sql(False)
    + f") SELECT 'r20260512T000000000000' AS run, count(*) FILTER (WHERE valid_from = TIMESTAMP '{FIRST_SNAPSHOT}') "
    "AS opened, cast(0 AS bigint) AS closed FROM versions UNION ALL SELECT 'r20260513T000000000000', "
    f"count(*) FILTER (WHERE valid_from = TIMESTAMP '{SECOND_SNAPSHOT}'), count(valid_to) FROM versions"
)
def stored_history_log(spark, sf):
    """What each run of a stored history wrote: versions opened and closed, not the table."""
    root = f"{store.scratch(spark)}/history"
    for after, at in ((False, _DAYS[0]), (True, _DAYS[1])):
        rows = _customer_state(spark, sf, after)
        store.publish_history(spark, root, rows, "applicant_id", ["o_orderpriority", "o_orderstatus"], at)
    log = store.read_runs(spark, root, store.RUN, store.run_labels(spark, root, store.RUN))
    return log.groupBy("run").agg(
        F.count_if(F.col("valid_to").isNull()).alias("opened"), F.count("valid_to").alias("closed")
    )


@query(
    "SELECT md5(concat(cast(applicant_id AS varchar), '|', cast(valid_from AS varchar))) AS applicant_sk, "
    "* EXCLUDE (valid_from, valid_to), cast(valid_from AS date) AS start_date, "
    "cast(valid_to AS date) AS end_date, valid_to IS NULL AS is_current FROM ("
    + _two_snapshots_sql(False)
    .replace(f"'{FIRST_SNAPSHOT}' AS valid_from", "'2026-05-12 00:00:00' AS valid_from")
    .replace(f"'{SECOND_SNAPSHOT}'", "'2026-05-13 00:00:00'")
    + ")"
)
def stored_history_presented(spark, sf):
    """A stored history of instants, presented: keys and dates follow UTC."""
    root = f"{store.scratch(spark)}/history"
    for after, at in zip((False, True), (datetime(2026, 5, 12, tzinfo=timezone.utc), datetime(2026, 5, 13, tzinfo=timezone.utc))):
        store.publish_history(
            spark, root, _customer_state(spark, sf, after), "applicant_id",
            ["o_orderpriority", "o_orderstatus"], at,
        )
    return scd2_present(store.read_history(spark, root, "applicant_id"), "applicant_id", "applicant_sk")


@query(_two_snapshots_sql(True))
def scd2_close_deleted(spark, sf):
    return _two_snapshots(spark, sf, close_deleted=True)


_EVENT_HISTORY = """
    SELECT user_id, event_type, value, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
          FROM events)
    WHERE before IS NULL OR before IS DISTINCT FROM event_type"""


@query(_EVENT_HISTORY)
def scd2_history_from_log(spark, sf):
    return scd2_from_log(
        table(spark, sf, "events"), "user_id", "ts", ["event_type"], ["event_id"], ["value"]
    )


@query(
    """
    WITH log AS (SELECT user_id, event_type, event_id,
                        CASE WHEN event_id % 1000 = 7 THEN TIMESTAMP '9999-12-30'
                             WHEN event_id % 1000 = 8 THEN TIMESTAMP '0002-01-01' ELSE ts END AS ts
                 FROM events)
    SELECT user_id, event_type, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM log)
    WHERE before IS NULL OR before IS DISTINCT FROM event_type
    """
)
def scd2_from_log_many_stretches(spark, sf):
    """Hours as stretches, and moments thousands of years off."""
    rest = F.col("event_id") % 1000
    log = table(spark, sf, "events").withColumn(
        "ts",
        F.when(rest == 7, moment("9999-12-30 00:00:00"))
        .when(rest == 8, moment("0002-01-01 00:00:00"))
        .otherwise(F.col("ts")),
    )
    return scd2_from_log(log, "user_id", "ts", ["event_type"], ["event_id"], stretch="HOUR")


_PRESENTED = """
    SELECT md5(concat(cast({key} AS varchar), '|', cast(valid_from AS varchar))) AS {sk},
           * EXCLUDE (valid_from, valid_to), cast(valid_from AS date) AS start_date,
           cast(valid_to AS date) AS end_date, valid_to IS NULL AS is_current
    FROM ({history})"""


@query(_PRESENTED.format(key="user_id", sk="user_sk", history=_EVENT_HISTORY))
def scd2_presentation(spark, sf):
    return scd2_present(scd2_history_from_log(spark, sf), "user_id", "user_sk")


@query(
    f"""
    WITH h AS ({_EVENT_HISTORY}),
         per_key AS (SELECT user_id, count(*) FILTER (WHERE valid_to IS NULL) AS n FROM h GROUP BY 1)
    SELECT count(*) AS keys, cast(sum(n) AS bigint) AS current_versions,
           count(*) FILTER (WHERE n <> 1) AS violations FROM per_key
    """
)
def scd2_one_current(spark, sf):
    dim = scd2_presentation(spark, sf)
    per_key = dim.groupBy("user_id").agg(F.count_if("is_current").alias("n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("n").alias("current_versions"),
        F.count_if(F.col("n") != 1).alias("violations"),
    )


# --- Joins ----------------------------------------------------------------------------------


@query(
    """
    SELECT o_orderkey, o_totalprice, l_returnflag, l_shipdate FROM orders LEFT JOIN (
      SELECT l_orderkey, l_returnflag, l_shipdate FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS rn
        FROM lineitem) WHERE rn = 1) ON l_orderkey = o_orderkey
    """
)
def left_join_optional(spark, sf):
    latest = latest_per_key(
        table(spark, sf, "lineitem"),
        ["l_orderkey"],
        "l_shipdate",
        ["l_linenumber", "l_partkey", "l_suppkey"],
    ).withColumnRenamed("l_orderkey", "o_orderkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return lookup.left_lookup(orders, latest, ["o_orderkey"], ["l_returnflag", "l_shipdate"])


@query(
    f"""
    WITH dim AS ({_PRESENTED.format(key="user_id", sk="user_sk", history=_EVENT_HISTORY)})
    SELECT c_custkey, c_mktsegment, user_sk, event_type FROM customer
    LEFT JOIN dim ON c_custkey = user_id AND is_current
    """
)
def current_dim_lookup(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lookup.lookup_current(
        customer, scd2_presentation(spark, sf), "c_custkey", "user_id", ["user_sk", "event_type"]
    )


@query(
    f"""
    SELECT e.event_id, e.user_id, e.ts, h.event_type AS state, h.valid_from AS state_since
    FROM (SELECT event_id, user_id, ts + INTERVAL 36 HOUR AS ts FROM events) e
    LEFT JOIN ({_EVENT_HISTORY}) h ON h.user_id = e.user_id AND h.valid_from <= e.ts
      AND (h.valid_to IS NULL OR e.ts < h.valid_to)
    """
)
def as_of_lookup(spark, sf):
    """Each event, a day and a half later, with the state its user has then."""
    later = F.col("ts") + F.expr("INTERVAL 36 HOURS")
    facts = table(spark, sf, "events").select("event_id", "user_id", later.alias("ts"))
    versions = scd2_history_from_log(spark, sf)
    take = {"event_type": "state", "valid_from": "state_since"}
    return lookup.lookup_as_of(facts, versions, "user_id", "ts", take, stretch="DAY")


@query(
    "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"
)
def small_dim_lookup(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation")
    return lookup.lookup_small(customer, nation, "c_nationkey", "n_nationkey", ["n_name"]).drop(
        "c_nationkey"
    )


@query(
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)"
)
def fk_orphans(spark, sf):
    parents = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lookup.orphans(orders, "o_custkey", parents, "c_custkey")


# --- Staging and star schema ----------------------------------------------------------------


def stg_application(spark, sf):
    """Orders with their customer's balance as staged applications."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    priority = sentinel_to_null("o_orderpriority", "4-NOT SPECIFIED")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        F.col("o_orderkey").alias("sk_id_curr"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("long").alias("target_flag"),
        priority.alias("name_contract_type"),
        F.col("o_totalprice").alias("amt_credit"),
        (F.col("o_totalprice") / 12.0).alias("amt_annuity"),
        F.col("c_acctbal").alias("amt_income_total"),
        F.col("c_mktsegment").alias("name_income_type"),
        F.col("o_orderpriority").alias("name_education_type"),
        F.col("o_orderstatus").alias("name_family_status"),
        F.col("c_nationkey").cast("long").alias("cnt_children"),
        mask("o_custkey").alias("days_birth_masked"),
        mask(sentinel_to_null("c_nationkey", 0)).alias("days_employed_masked"),
        F.col("o_orderdate").cast("date").alias("ingestion_date"),
    )


_STG_APP = """
    SELECT o_orderkey AS sk_id_curr,
           cast(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS bigint) AS target_flag,
           nullif(o_orderpriority, '4-NOT SPECIFIED') AS name_contract_type,
           o_totalprice AS amt_credit, o_totalprice / cast(12 AS double) AS amt_annuity,
           c_acctbal AS amt_income_total, c_mktsegment AS name_income_type,
           o_orderpriority AS name_education_type, o_orderstatus AS name_family_status,
           cast(c_nationkey AS bigint) AS cnt_children,
           sha256(cast(o_custkey AS varchar)) AS days_birth_masked,
           sha256(cast(nullif(c_nationkey, 0) AS varchar)) AS days_employed_masked,
           cast(o_orderdate AS date) AS ingestion_date
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""


def applicant_history(spark, sf, app=None):
    """Applications landed before the first border, then all with the last line's status."""
    app = stg_application(spark, sf) if app is None else app
    attributes = gold.applicant_attributes(app)
    landed = app.filter(
        F.col("ingestion_date") < F.lit(FIRST_SNAPSHOT[:10]).cast("date")
    )
    first = open_versions(gold.applicant_attributes(landed), moment(FIRST_SNAPSHOT))
    last_line = latest_per_key(
        table(spark, sf, "lineitem"),
        ["l_orderkey"],
        "l_shipdate",
        ["l_linenumber", "l_partkey", "l_suppkey"],
    ).select(F.col("l_orderkey").alias("applicant_id"), "l_linestatus")
    moved = (
        lookup.left_lookup(attributes, last_line, ["applicant_id"], ["l_linestatus"])
        .withColumn("name_family_status", F.coalesce("l_linestatus", "name_family_status"))
        .drop("l_linestatus")
    )
    return scd2_apply(first, moved, "applicant_id", TRACKED_ATTRIBUTES, moment(SECOND_SNAPSHOT))


_ATTRIBUTES = ", ".join((*TRACKED_ATTRIBUTES, *CARRIED_ATTRIBUTES))
_APPLICANT_HISTORY = f"""
    SELECT s1.*, TIMESTAMP '{FIRST_SNAPSHOT}' AS valid_from,
           CASE WHEN s1.name_family_status IS DISTINCT FROM s2.name_family_status
                THEN TIMESTAMP '{SECOND_SNAPSHOT}' END AS valid_to
    FROM (SELECT sk_id_curr AS applicant_id, {_ATTRIBUTES} FROM ({_STG_APP})
          WHERE ingestion_date < DATE '{FIRST_SNAPSHOT[:10]}') s1
    JOIN moved s2 ON s1.applicant_id = s2.applicant_id
    UNION ALL
    SELECT s2.*, TIMESTAMP '{SECOND_SNAPSHOT}', cast(NULL AS timestamp)
    FROM moved s2 LEFT JOIN (SELECT * FROM ({_STG_APP})
                             WHERE ingestion_date < DATE '{FIRST_SNAPSHOT[:10]}') s1
      ON s1.sk_id_curr = s2.applicant_id
    WHERE s1.sk_id_curr IS NULL OR s1.name_family_status IS DISTINCT FROM s2.name_family_status"""
_WITH_APPLICANTS = f"""
    WITH last_line AS (SELECT l_orderkey, l_linestatus FROM (SELECT *, row_number() OVER (
           PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey)
           AS rn FROM lineitem) WHERE rn = 1),
         app AS ({_STG_APP}),
         moved AS (SELECT sk_id_curr AS applicant_id, name_income_type, name_education_type,
                          coalesce(l_linestatus, name_family_status) AS name_family_status,
                          cnt_children, days_birth_masked, days_employed_masked
                   FROM app LEFT JOIN last_line ON l_orderkey = sk_id_curr),
         dim AS ({_PRESENTED.format(key="applicant_id", sk="applicant_sk", history=_APPLICANT_HISTORY)})
"""


@query(_WITH_APPLICANTS + "SELECT * FROM dim")
def dim_applicant(spark, sf):
    return gold.dim_applicant(applicant_history(spark, sf))


@query(
    f"SELECT sk_id_curr AS applicant_id, {_ATTRIBUTES} FROM ({_STG_APP})"
)
def applicant_attributes(spark, sf):
    return gold.applicant_attributes(stg_application(spark, sf))


@query(
    f"SELECT md5(n) AS loan_type_id, n AS loan_type_name, {RUN_TS_SQL} AS updated_at FROM "
    f"(SELECT DISTINCT name_contract_type AS n FROM ({_STG_APP}) WHERE name_contract_type IS NOT NULL)"
)
def dim_loan_type(spark, sf):
    return gold.dim_loan_type(stg_application(spark, sf), moment(RUN_TS))


_FACT_LOAN = """
    SELECT md5(cast(sk_id_curr AS varchar)) AS loan_application_sk, applicant_sk,
           md5(name_contract_type) AS loan_type_id, sk_id_curr, target_flag, amt_credit,
           amt_annuity, amt_income_total,
           amt_income_total / nullif(amt_credit, 0) AS income_to_credit_ratio, ingestion_date
    FROM app LEFT JOIN dim ON sk_id_curr = applicant_id AND is_current"""


def _loan_types(spark, sf, app=None):
    return gold.dim_loan_type(stg_application(spark, sf) if app is None else app, moment(RUN_TS))


@query(_WITH_APPLICANTS + _FACT_LOAN)
def fact_loan_application(spark, sf):
    return gold.fact_loan_application(
        stg_application(spark, sf), dim_applicant(spark, sf), _loan_types(spark, sf)
    )


_STATUS_VALUES = ", ".join(f"('{code}', '{text}')" for code, text in CREDIT_STATUSES)
_FACT_BUREAU = f"""
    SELECT md5(cast(b.SK_ID_BUREAU AS varchar)) AS bureau_credit_sk, applicant_sk,
           SK_ID_CURR AS sk_id_curr, b.SK_ID_BUREAU AS sk_id_bureau, md5(code) AS credit_status_id,
           CREDIT_DAY_OVERDUE AS credit_day_overdue, AMT_CREDIT_SUM AS amt_credit_sum,
           AMT_CREDIT_SUM_DEBT AS amt_credit_sum_debt, CREDIT_TYPE AS credit_type,
           STATUS AS bureau_balance_status, b.ingestion_date
    FROM ({_SILVER_BUREAU}) b
    LEFT JOIN ({_SILVER_BALANCE}) bb ON b.SK_ID_BUREAU = bb.SK_ID_BUREAU
    LEFT JOIN dim ON SK_ID_CURR = applicant_id AND is_current
    LEFT JOIN (VALUES {_STATUS_VALUES}) AS s(code, description) ON CREDIT_ACTIVE = code"""


def stg_bureau(spark, sf):
    return shape.conform(
        silver_bureau(spark, sf),
        [m for m in gold.STG_BUREAU if m[0] in _BUREAU_LANDED],
    )


_BUREAU_LANDED = {
    "SK_ID_CURR",
    "SK_ID_BUREAU",
    "CREDIT_ACTIVE",
    "CREDIT_DAY_OVERDUE",
    "AMT_CREDIT_SUM",
    "AMT_CREDIT_SUM_DEBT",
    "CREDIT_TYPE",
    "ingestion_date",
}


def _bureau_fact(spark, sf, applicants):
    return gold.fact_bureau_credit(
        stg_bureau(spark, sf),
        gold.stg_bureau_balance(silver_bureau_balance(spark, sf)),
        applicants,
        gold.dim_credit_status(spark, moment(RUN_TS)),
    )


@query(_WITH_APPLICANTS + _FACT_BUREAU)
def fact_bureau_credit(spark, sf):
    return _bureau_fact(spark, sf, dim_applicant(spark, sf))


_FACT_PAYMENT = f"""
    SELECT md5(concat(cast(SK_ID_PREV AS varchar), '|',
                      cast(cast(NUM_INSTALMENT_NUMBER AS bigint) AS varchar))) AS payment_sk,
           SK_ID_CURR AS sk_id_curr, SK_ID_PREV AS sk_id_prev,
           NUM_INSTALMENT_NUMBER AS num_instalment_number, DAYS_INSTALMENT AS days_instalment,
           DAYS_ENTRY_PAYMENT AS days_entry_payment, AMT_INSTALMENT AS amt_instalment,
           AMT_PAYMENT AS amt_payment, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS days_payment_diff,
           ingestion_date
    FROM ({_SILVER_INSTALLMENTS})"""


@query(_FACT_PAYMENT)
def fact_installment_payment(spark, sf):
    return gold.fact_installment_payment(gold.stg_installments(silver_installments(spark, sf)))


# --- KPIs -----------------------------------------------------------------------------------


@query(
    f"""
    SELECT name_contract_type, cast(grouping(name_contract_type) AS bigint) AS grouping_level,
           count(*) AS applications, count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*)
             AS default_rate_pct
    FROM ({_STG_APP}) GROUP BY ROLLUP (name_contract_type)
    """
)
def kpi_default_rate(spark, sf):
    return kpi.default_rate(stg_application(spark, sf), ["name_contract_type"])


@query(
    f"""
    SELECT name_contract_type, name_income_type, cnt_children,
           cast(grouping(name_contract_type, name_income_type, cnt_children) AS bigint)
             AS grouping_level,
           count(*) AS applications, count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*)
             AS default_rate_pct
    FROM ({_STG_APP})
    GROUP BY GROUPING SETS ((name_contract_type), (name_income_type), (cnt_children), ())
    """
)
def kpi_segment_rates(spark, sf):
    return kpi.segment_default_rates(
        stg_application(spark, sf), ["name_contract_type", "name_income_type", "cnt_children"]
    )


@query(
    f"SELECT name_contract_type, round(sum(amt_credit) / count(amt_credit), 4) "
    f"AS avg_credit_amount FROM ({_STG_APP}) GROUP BY 1"
)
def kpi_avg_credit(spark, sf):
    return rounded(kpi.average_credit(stg_application(spark, sf), ["name_contract_type"]), 4)


@query(
    "SELECT o_custkey, round(sum(l_extendedprice), 4) AS bureau_exposure "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"
)
def kpi_exposure_per_applicant(spark, sf):
    """Added up per order before the join, so that one row per order is shuffled for it."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        kpi.exact_sum("l_extendedprice").alias("amount")
    )
    joined = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
    total = F.sum("amount").cast("double").alias("bureau_exposure")
    return rounded(joined.groupBy("o_custkey").agg(total), 4)


@query(
    "SELECT l_suppkey, round(sum(round(l_extendedprice / 1000000000.0, 11)), 12) AS bureau_exposure "
    "FROM lineitem GROUP BY 1"
)
def kpi_exposure_small_amounts(spark, sf):
    """Amounts with up to eleven decimals: none of their digits is lost."""
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", F.round(F.col("l_extendedprice") / 1e9, 11).alias("amount")
    )
    return rounded(kpi.exposure(lines, ["l_suppkey"], "amount"), 12)


@query(
    f"SELECT count(*) AS bureau_records, count(*) FILTER (WHERE CREDIT_DAY_OVERDUE > 0) AS overdue, "
    f"cast(count(*) FILTER (WHERE CREDIT_DAY_OVERDUE > 0) AS double) * 100.0 / count(*) "
    f"AS overdue_rate_pct FROM ({_SILVER_BUREAU})"
)
def kpi_overdue_rate(spark, sf):
    return kpi.overdue_rate(stg_bureau(spark, sf))


@query(
    f"SELECT name_income_type, round(avg(amt_income_total / nullif(amt_credit, 0)), 8) "
    f"AS income_to_credit_ratio FROM ({_STG_APP}) GROUP BY 1"
)
def kpi_income_credit_ratio(spark, sf):
    return rounded(
        kpi.income_credit_ratio(stg_application(spark, sf), ["name_income_type"]), 8
    )


@query(
    f"SELECT num_instalment_number, avg(days_payment_diff) AS avg_days_payment_diff "
    f"FROM ({_FACT_PAYMENT}) GROUP BY 1"
)
def kpi_payment_punctuality(spark, sf):
    return kpi.punctuality(fact_installment_payment(spark, sf), ["num_instalment_number"])


_EDGES = (0.0, 2500.0, 5000.0, 7500.0)


@query(
    f"""
    SELECT CASE WHEN amt_income_total < 0 THEN 0 WHEN amt_income_total < 2500 THEN 1
                WHEN amt_income_total < 5000 THEN 2 WHEN amt_income_total < 7500 THEN 3
                WHEN amt_income_total IS NOT NULL THEN 4 END AS income_bracket,
           count(*) AS rows_total, count(days_employed_masked) AS rows_masked,
           cast(count(days_employed_masked) AS double) * 100.0 / count(*) AS masked_presence_pct
    FROM ({_STG_APP}) GROUP BY 1
    """
)
def kpi_masked_presence(spark, sf):
    return kpi.masked_presence(
        stg_application(spark, sf), "days_employed_masked", "amt_income_total", _EDGES
    )


@query(
    f"""
    SELECT income_quartile, count(*) AS rows_total, count(days_employed_masked) AS rows_masked,
           cast(count(days_employed_masked) AS double) * 100.0 / count(*) AS masked_presence_pct,
           min(amt_income_total) AS income_from, max(amt_income_total) AS income_to
    FROM (SELECT *, CASE WHEN amt_income_total IS NOT NULL THEN ntile(4) OVER (
            PARTITION BY amt_income_total IS NULL ORDER BY amt_income_total, sk_id_curr) END AS income_quartile
          FROM ({_STG_APP})) GROUP BY 1
    """
)
def kpi_masked_presence_quartiles(spark, sf):
    """Share of masked values per quarter of the incomes."""
    app = stg_application(spark, sf).select("sk_id_curr", "amt_income_total", "days_employed_masked")
    tiled = ranking.ntile(app, 4, "amt_income_total", "sk_id_curr", "income_quartile")
    counted = tiled.groupBy("income_quartile").agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count("days_employed_masked").alias("rows_masked"),
        F.min("amt_income_total").alias("income_from"),
        F.max("amt_income_total").alias("income_to"),
    )
    return counted.withColumn("masked_presence_pct", percent(F.col("rows_masked"), F.col("rows_total")))


def _stored_partials(spark, sf) -> DataFrame:
    """Daily partials in a partition per month, of which one month is stored again."""
    root, app = f"{store.scratch(spark)}/partials", stg_application(spark, sf)
    parts = partials.daily_partials(app, "ingestion_date", ["name_contract_type"])
    month = parts.withColumn("month", F.substring(partials.DAY, 1, 7))
    month.repartition("month").write.partitionBy("month").parquet(root)
    again = app.filter(F.trunc("ingestion_date", "month") == F.lit("1996-01-01").cast("date"))
    store.write_run(
        partials.daily_partials(again, "ingestion_date", ["name_contract_type"]), root, "month", "1996-01"
    )
    return store.read_runs(spark, root, "month", store.run_labels(spark, root, "month"))


_ROLLED_UP = """
    SELECT {period} name_contract_type, count(*) AS applications, count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*) AS default_rate_pct,
           cast(sum(cast(amt_credit AS decimal(18, 2))) AS double) / count(amt_credit) AS avg_credit_amount,
           true AS applicants_near
    FROM ({app}) GROUP BY ALL"""


def _rolled_up(spark, sf, unit: str | None) -> DataFrame:
    rolled = partials.indicators(partials.rolled_up(_stored_partials(spark, sf), ["name_contract_type"], unit))
    # An application is an applicant in these tables, so the estimate is held against their number.
    near = F.abs(F.col("applicants") - F.col("applications")) <= F.greatest(F.lit(1.0), F.col("applications") * 0.04)
    return rolled.withColumn("applicants_near", near).drop("applicants")


@query(_ROLLED_UP.format(period="cast(date_trunc('month', ingestion_date) AS date) AS period,", app=_STG_APP))
def kpi_monthly_from_days(spark, sf):
    """Monthly indicators added up from stored daily partials."""
    return _rolled_up(spark, sf, "month")


@query(_ROLLED_UP.format(period="cast(date_trunc('week', ingestion_date) AS date) AS period,", app=_STG_APP))
def kpi_weekly_from_days(spark, sf):
    return _rolled_up(spark, sf, "week")


@query(
    f"""
    SELECT name_contract_type, q AS quantile, count(amt_credit) AS amounts, true AS rank_near
    FROM ({_STG_APP}), (VALUES (cast(0.1 AS double)), (0.5), (0.9)) AS p(q) GROUP BY 1, 2
    """
)
def credit_quantiles_from_days(spark, sf):
    """Quantiles of daily sketches merged over all days, held against the rows' own ranks."""
    whole = partials.rolled_up(_stored_partials(spark, sf), ["name_contract_type"])
    wanted = settle(
        whole.select(
            F.col("name_contract_type").alias("_type"),
            F.col("amounts"),
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(p).alias("quantile"), partials.quantile("distribution", p).alias("_value"))
                        for p in (0.1, 0.5, 0.9)
                    ]
                )
            ),
        )
    )
    app = stg_application(spark, sf).select("name_contract_type", "amt_credit")
    ranked = app.join(wanted, F.col("name_contract_type").eqNullSafe(F.col("_type")))
    return (
        ranked.groupBy("name_contract_type", "quantile", "amounts")
        .agg((F.count_if(F.col("amt_credit") <= F.col("_value")) / F.count("amt_credit")).alias("_rank"))
        .withColumn("rank_near", F.abs(F.col("_rank") - F.col("quantile")) <= 0.02)
        .drop("_rank")
    )


@query(
    f"""
    SELECT cast(date_trunc('month', ingestion_date) AS date) AS period, count(*) AS applications,
           count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*)
             AS default_rate_pct
    FROM ({_STG_APP}) GROUP BY 1
    """
)
def kpi_monthly(spark, sf):
    app = kpi.per_period(stg_application(spark, sf), "ingestion_date", "month")
    return kpi.default_rate(app, ["period"], totals=False)


@query(
    f"""
    SELECT cast(date_trunc('week', ingestion_date) AS date) AS period, name_contract_type,
           count(*) AS applications, count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*)
             AS default_rate_pct
    FROM ({_STG_APP}) GROUP BY 1, 2
    """
)
def kpi_weekly(spark, sf):
    app = kpi.per_period(stg_application(spark, sf), "ingestion_date", "week")
    return kpi.default_rate(app, ["period", "name_contract_type"], totals=False)


@query(
    f"""
    SELECT ingestion_date AS period, count(*) AS applications,
           count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*)
             AS default_rate_pct
    FROM ({_STG_APP}) GROUP BY 1
    """
)
def kpi_daily(spark, sf):
    app = kpi.per_period(stg_application(spark, sf), "ingestion_date", "day")
    return kpi.default_rate(app, ["period"], totals=False)


@query(
    """
    SELECT o_orderpriority, q AS quantile, round(quantile_cont(o_totalprice, q), 4) AS o_totalprice
    FROM orders, (VALUES (cast(0.0 AS double)), (0.25), (0.5), (0.9), (1.0)) AS p(q)
    GROUP BY 1, 2
    """.replace("quantile_cont(o_totalprice, q)", "CASE q WHEN 0.0 THEN min(o_totalprice) "
    "WHEN 0.25 THEN quantile_cont(o_totalprice, 0.25) WHEN 0.5 THEN quantile_cont(o_totalprice, 0.5) "
    "WHEN 0.9 THEN quantile_cont(o_totalprice, 0.9) ELSE max(o_totalprice) END")
)
def credit_quantiles(spark, sf):
    return rounded(
        kpi.exact_quantiles(
            table(spark, sf, "orders"),
            "o_totalprice",
            ["o_orderpriority"],
            [0.0, 0.25, 0.5, 0.9, 1.0],
            1000.0,
        ),
        4,
    )


@query(
    "SELECT q AS quantile, round(CASE q WHEN 0.01 THEN quantile_cont(l_extendedprice, 0.01) "
    "WHEN 0.5 THEN quantile_cont(l_extendedprice, 0.5) ELSE quantile_cont(l_extendedprice, 0.99) END, 4) "
    "AS l_extendedprice FROM lineitem, (VALUES (cast(0.01 AS double)), (0.5), (0.99)) AS p(q) GROUP BY 1"
)
def amount_quantiles_overall(spark, sf):
    """Quantiles of the whole table: no segment, slots of one unit."""
    lines = table(spark, sf, "lineitem")
    return rounded(kpi.exact_quantiles(lines, "l_extendedprice", [], [0.01, 0.5, 0.99], 1.0), 4)


@query(
    "SELECT o_orderpriority, floor(o_totalprice / 50000.0) * 50000.0 AS slot_from, "
    "count(*) AS rows_in_slot FROM orders GROUP BY 1, 2"
)
def credit_histogram(spark, sf):
    return kpi.histogram(
        table(spark, sf, "orders"), "o_totalprice", ["o_orderpriority"], 50_000.0
    )


@query(
    _WITH_APPLICANTS
    + f"""
    , loans AS ({_FACT_LOAN}), bureau AS ({_FACT_BUREAU}), payments AS ({_FACT_PAYMENT}),
    named AS (SELECT loans.*, name_contract_type AS loan_type_name
              FROM loans JOIN app ON loans.sk_id_curr = app.sk_id_curr),
    rolled AS (SELECT CASE WHEN grouping(loan_type_name) = 1 THEN 'ALL' ELSE loan_type_name END
                 AS segment, count(*) AS n, count(*) FILTER (WHERE target_flag = 1) AS bad,
                 round(sum(amt_credit) / count(amt_credit), 4) AS credit, avg(income_to_credit_ratio) AS ratio
               FROM named GROUP BY ROLLUP (loan_type_name))
    SELECT 'default_rate_pct' AS kpi, segment, cast(bad AS double) * 100.0 / n AS value
      FROM rolled
    UNION ALL SELECT 'avg_credit_amount', segment, credit FROM rolled
    UNION ALL SELECT 'income_to_credit_ratio', segment, round(ratio, 8) FROM rolled
    UNION ALL SELECT 'avg_bureau_exposure', 'ALL',
      round(sum(amt_credit_sum) / count(DISTINCT sk_id_curr), 4) FROM bureau
    UNION ALL SELECT 'overdue_rate_pct', 'ALL',
      cast(count(*) FILTER (WHERE credit_day_overdue > 0) AS double) * 100.0 / count(*)
      FROM bureau
    UNION ALL SELECT 'avg_days_payment_diff', 'ALL', avg(days_payment_diff) FROM payments
    """
)
def kpi_summary(spark, sf):
    app = settle(stg_application(spark, sf))
    dim = settle(gold.dim_applicant(applicant_history(spark, sf, app)))
    types = settle(_loan_types(spark, sf, app))
    fact = gold.fact_loan_application(app, dim, types)
    loans = gold.with_loan_type(fact, types)
    summary = kpi.risk_summary(
        loans, _bureau_fact(spark, sf, dim), fact_installment_payment(spark, sf)
    )
    amounts = F.col("kpi").isin("avg_credit_amount", "avg_bureau_exposure")
    return summary.withColumn(
        "value",
        F.when(F.col("kpi") == "income_to_credit_ratio", F.round("value", 8))
        .when(amounts, F.round("value", 4))
        .otherwise(F.col("value")),
    )


@query(
    _WITH_APPLICANTS
    + f"""
    , loans AS ({_FACT_LOAN})
    SELECT name_education_type, name_family_status, count(*) AS applications,
           count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*)
             AS default_rate_pct
    FROM loans LEFT JOIN dim ON loans.applicant_sk = dim.applicant_sk AND is_current
    GROUP BY 1, 2
    """
)
def kpi_by_applicant_segment(spark, sf):
    dim = dim_applicant(spark, sf)
    loans = lookup.lookup_current(
        gold.fact_loan_application(stg_application(spark, sf), dim, _loan_types(spark, sf)),
        dim,
        "applicant_sk",
        "applicant_sk",
        ["name_education_type", "name_family_status"],
    )
    return kpi.default_rate(loans, ["name_education_type", "name_family_status"], totals=False)


@query(
    "SELECT o_custkey, count(*) AS previous_applications FROM orders GROUP BY 1"
)
def previous_application_count(spark, sf):
    return kpi.count_per(table(spark, sf, "orders"), "o_custkey", "previous_applications")


@query(
    """
    WITH lines AS (SELECT o_custkey, count(*) AS bureau_records,
                          round(sum(l_extendedprice), 4) AS exposure,
                          count(*) FILTER (WHERE l_returnflag = 'R') AS overdue_records
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
         apps AS (SELECT o_custkey, count(*) AS previous_applications, max(o_totalprice) AS max_credit
                  FROM orders GROUP BY 1)
    SELECT c_custkey AS applicant_id, c_mktsegment, previous_applications, max_credit,
           bureau_records, exposure, overdue_records
    FROM customer LEFT JOIN apps a ON a.o_custkey = c_custkey
    LEFT JOIN lines l ON l.o_custkey = c_custkey
    """
)
def applicant_features(spark, sf):
    orders = table(spark, sf, "orders")
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        kpi.exact_sum("l_extendedprice").alias("amount"),
        F.count_if(F.col("l_returnflag") == "R").alias("overdue"),
    )
    lines = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("applicant_id"))
        .agg(
            F.sum("n").alias("bureau_records"),
            F.round(F.sum("amount").cast("double"), 4).alias("exposure"),
            F.sum("overdue").alias("overdue_records"),
        )
    )
    applications = orders.groupBy(F.col("o_custkey").alias("applicant_id")).agg(
        F.count(F.lit(1)).alias("previous_applications"),
        F.max("o_totalprice").alias("max_credit"),
    )
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("applicant_id"), "c_mktsegment"
    )
    return kpi.applicant_features(base, "applicant_id", [applications, lines])


@query(
    """
    SELECT o_orderstatus, period, balance,
           balance - lag(balance) OVER (PARTITION BY o_orderstatus ORDER BY period) AS balance_change
    FROM (SELECT o_orderstatus, cast(date_trunc('month', o_orderdate) AS date) AS period,
                 cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS balance
          FROM orders GROUP BY 1, 2)
    """
)
def balance_trend(spark, sf):
    orders = kpi.per_period(table(spark, sf, "orders"), "o_orderdate", "month")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return kpi.trend(orders, "period", {"balance": F.sum(cents)}, ["o_orderstatus"])


@query(
    """
    SELECT months_balance, contracts, delinquent,
           contracts - lag(contracts) OVER (ORDER BY months_balance) AS contracts_change,
           delinquent - lag(delinquent) OVER (ORDER BY months_balance) AS delinquent_change
    FROM (SELECT -cast(l_quantity AS bigint) AS months_balance, count(*) AS contracts,
                 count(*) FILTER (WHERE l_returnflag = 'R') AS delinquent
          FROM lineitem GROUP BY 1)
    """
)
def delinquency_trend(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "months_balance", -F.col("l_quantity").cast("long")
    )
    measures = {
        "contracts": F.count(F.lit(1)),
        "delinquent": F.count_if(F.col("l_returnflag") == "R"),
    }
    return kpi.trend(lines, "months_balance", measures)


# --- Quality --------------------------------------------------------------------------------


def _check_sql(check, column, severity, failed, total, bad, source, name):
    return (
        f"SELECT '{name}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
        f"'{severity}' AS severity, cast({failed} AS bigint) AS failed_rows, "
        f"cast({total} AS bigint) AS total_rows, "
        f"CASE WHEN {bad} THEN '{severity}' ELSE 'PASS' END AS status FROM {source}"
    )


def _row_check(check, column, severity, bad_row, source, name):
    failed = f"count(*) FILTER (WHERE {bad_row})"
    return _check_sql(check, column, severity, failed, "count(*)", f"{failed} > 0", source, name)


_DIGEST = "c_nationkey_masked = sha256('7')"
_MASKED_CUSTOMER = "(SELECT *, sha256(cast(c_nationkey AS varchar)) AS c_nationkey_masked FROM customer)"


@query(
    " UNION ALL ".join(
        [
            _check_sql(
                "row_count_at_least", "*", "WARN", "greatest(1 - count(*), 0)", "count(*)",
                "count(*) < 1", "orders", "orders",
            ),
            _row_check("not_null", "o_orderkey", "FAIL", "o_orderkey IS NULL", "orders", "orders"),
            _row_check(
                "not_in_set", "o_orderpriority", "FAIL", "o_orderpriority IN ('4-NOT SPECIFIED')",
                "orders", "orders",
            ),
            _row_check(
                "accepted_values", "o_orderstatus", "WARN", "o_orderstatus NOT IN ('F', 'O')",
                "orders", "orders",
            ),
            _row_check(
                "greater_than", "o_totalprice", "FAIL", "o_totalprice <= 1000", "orders", "orders"
            ),
            _check_sql(
                "unique", "o_custkey,o_orderdate", "FAIL",
                "coalesce(sum(n) FILTER (WHERE n > 1), 0)", "sum(n)",
                "coalesce(sum(n) FILTER (WHERE n > 1), 0) > 0",
                "(SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)", "orders",
            ),
            _check_sql(
                "unique", "o_orderkey", "FAIL", "coalesce(sum(n) FILTER (WHERE n > 1), 0)",
                "sum(n)", "coalesce(sum(n) FILTER (WHERE n > 1), 0) > 0",
                "(SELECT count(*) AS n FROM orders GROUP BY o_orderkey)", "orders",
            ),
        ]
    )
)
def dq_suite(spark, sf):
    return q.check(
        table(spark, sf, "orders"),
        "orders",
        [
            q.row_count_at_least(1, q.WARN),
            q.not_null("o_orderkey"),
            q.not_in_set("o_orderpriority", ["4-NOT SPECIFIED"]),
            q.accepted_values("o_orderstatus", ["F", "O"], q.WARN),
            q.greater_than("o_totalprice", 1000),
            q.unique("o_custkey", "o_orderdate"),
            q.unique("o_orderkey"),
        ],
    )


@query(
    " UNION ALL ".join(
        [
            _row_check(
                "not_digest_of", "c_nationkey_masked", "FAIL", _DIGEST, _MASKED_CUSTOMER, "customer"
            ),
            _row_check(
                "masked_differs", "c_nationkey_masked", "FAIL",
                "c_nationkey_masked = cast(c_nationkey AS varchar)", _MASKED_CUSTOMER, "customer",
            ),
            _row_check(
                "is_digest", "c_nationkey_masked", "FAIL",
                "NOT regexp_full_match(c_nationkey_masked, '[0-9a-f]{64}')", _MASKED_CUSTOMER,
                "customer",
            ),
            _check_sql(
                "null_rate_below", "clean_balance", "WARN",
                "count(*) FILTER (WHERE c_acctbal < 0)", "count(*)",
                "count(*) FILTER (WHERE c_acctbal < 0) / cast(count(*) AS double) >= 0.05",
                "customer", "customer",
            ),
        ]
    )
)
def dq_masking(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_nationkey",
        mask("c_nationkey").alias("c_nationkey_masked"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("clean_balance"),
    )
    return q.check(
        customer,
        "customer",
        [
            q.not_digest_of("c_nationkey_masked", "7"),
            q.masked_differs("c_nationkey_masked", "c_nationkey"),
            q.is_digest("c_nationkey_masked"),
            q.null_rate_below("clean_balance", 0.05),
        ],
    )


@query(
    " UNION ALL ".join(
        _check_sql(
            "relationship", column, "FAIL", f"count(*) FILTER (WHERE {parent} IS NULL)", "count(*)",
            f"count(*) FILTER (WHERE {parent} IS NULL) > 0", source, "orders",
        )
        for column, parent, source in [
            (
                "o_custkey", "c_custkey",
                "orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) "
                "ON o_custkey = c_custkey",
            ),
            (
                "o_orderkey", "l_orderkey",
                "orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) "
                "ON o_orderkey = l_orderkey",
            ),
        ]
    )
)
def dq_relationships(spark, sf):
    solvent = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return q.check(
        table(spark, sf, "orders"),
        "orders",
        [
            q.relationship("o_custkey", solvent, "c_custkey"),
            q.relationship("o_orderkey", table(spark, sf, "lineitem"), "l_orderkey"),
        ],
    )


@query(
    _WITH_APPLICANTS
    + ", loans AS ("
    + _FACT_LOAN
    + ") "
    + " UNION ALL ".join(
        [
            _row_check("not_null", c, "FAIL", f"{c} IS NULL", "loans", "fact_loan_application")
            for c in ("loan_application_sk", "sk_id_curr", "applicant_sk", "loan_type_id", "amt_credit")
        ]
        + [
            _row_check(
                "accepted_values", "target_flag", "WARN", "target_flag NOT IN (0, 1)", "loans",
                "fact_loan_application",
            ),
            _check_sql(
                "unique", "loan_application_sk", "FAIL",
                "coalesce(sum(n) FILTER (WHERE n > 1), 0)", "sum(n)",
                "coalesce(sum(n) FILTER (WHERE n > 1), 0) > 0",
                "(SELECT count(*) AS n FROM loans GROUP BY loan_application_sk)",
                "fact_loan_application",
            ),
        ]
        + [
            _check_sql(
                "relationship", column, "FAIL", lost, f"count({column})", f"{lost} > 0",
                f"loans LEFT JOIN {parents} ON {column} = parent", "fact_loan_application",
            )
            for column, parents, lost in [
                ("applicant_sk", "(SELECT DISTINCT applicant_sk AS parent FROM dim)",
                 "count(*) FILTER (WHERE applicant_sk IS NOT NULL AND parent IS NULL)"),
                ("loan_type_id", "(SELECT DISTINCT md5(name_contract_type) AS parent FROM app)",
                 "count(*) FILTER (WHERE loan_type_id IS NOT NULL AND parent IS NULL)"),
            ]
        ]
        + [
            _check_sql(
                "applicant_resolves", "applicant_sk", "FAIL", "count(*)", "count(*)", "count(*) > 0",
                "(SELECT 1 FROM loans WHERE applicant_sk IS NOT NULL AND NOT EXISTS "
                "(SELECT 1 FROM dim WHERE dim.applicant_sk = loans.applicant_sk))",
                "fact_loan_application",
            ),
        ]
    )
)
def dq_loan_fact(spark, sf):
    """The loan fact's own suite; applications without a contract type fail it."""
    dim, types = settle(dim_applicant(spark, sf)), settle(_loan_types(spark, sf))
    loans = settle(gold.fact_loan_application(stg_application(spark, sf), dim, types))
    marts = {
        "fact_loan_application": loans,
        "fact_bureau_credit": _bureau_fact(spark, sf, dim),
        "dim_applicant": dim,
        "dim_loan_type": types,
        "dim_credit_status": gold.dim_credit_status(spark, moment(RUN_TS)),
    }
    suite = suites.gold_suites(marts)["fact_loan_application"]
    return q.check(loans, "fact_loan_application", suite)


@query(
    f"""
    WITH h AS ({_EVENT_HISTORY})
    SELECT 'events' AS table_name, 'one_current_per_user' AS check_name, 'user_id' AS column_name,
           'FAIL' AS severity, cast(count(*) AS bigint) AS failed_rows,
           cast(count(*) AS bigint) AS total_rows,
           CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
    FROM (SELECT user_id FROM h GROUP BY 1 HAVING count(*) FILTER (WHERE valid_to IS NULL) <> 1)
    """
)
def dq_failing_rows(spark, sf):
    dim = scd2_presentation(spark, sf)
    return q.check(
        dim,
        "events",
        [q.no_rows("one_current_per_user", not_exactly_one_current(dim, "user_id"), "user_id")],
    )


_BROKEN = (
    "CASE WHEN user_id % 10 = 3 THEN false WHEN user_id % 10 = 4 THEN true ELSE valid_to IS NULL END"
)


@query(
    f"""
    WITH h AS (SELECT user_id, {_BROKEN} AS is_current FROM ({_EVENT_HISTORY})),
         bad AS (SELECT user_id FROM h GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1)
    SELECT 'events' AS table_name, 'one_current_per_user' AS check_name, 'user_id' AS column_name,
           'FAIL' AS severity, count(*) AS failed_rows, count(*) AS total_rows,
           CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
    FROM bad
    """
)
def dq_failing_rows_found(spark, sf):
    """The same check on a history with users without, and with several, current versions."""
    rest = F.col("user_id") % 10
    current = F.when(rest == 3, F.lit(False)).when(rest == 4, F.lit(True)).otherwise(F.col("is_current"))
    dim = scd2_presentation(spark, sf).withColumn("is_current", current)
    return q.check(
        dim,
        "events",
        [q.no_rows("one_current_per_user", not_exactly_one_current(dim, "user_id"), "user_id")],
    )


@query(
    "SELECT l_orderkey AS sk_id_curr, l_suppkey AS sk_id_bureau, l_returnflag AS credit_active, "
    "l_extendedprice AS amt_credit_sum, cast(l_linenumber AS bigint) AS days_credit, "
    "cast(l_shipdate AS date) AS ingestion_date FROM lineitem WHERE l_linenumber <> 3"
)
def staged_bureau(spark, sf):
    """Staging from Silver rows some of which have no key."""
    silver_rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_CURR"),
        F.when(F.col("l_linenumber") != 3, F.col("l_suppkey")).alias("SK_ID_BUREAU"),
        F.col("l_returnflag").alias("CREDIT_ACTIVE"),
        F.col("l_extendedprice").alias("AMT_CREDIT_SUM"),
        F.col("l_linenumber").alias("DAYS_CREDIT"),
        F.col("l_shipdate").alias("ingestion_date"),
    )
    missing = {c: F.lit(None).cast("string") for c, _, _ in gold.STG_BUREAU if c not in silver_rows.columns}
    return gold.stg_bureau(silver_rows.withColumns(missing)).select(
        "sk_id_curr", "sk_id_bureau", "credit_active", "amt_credit_sum", "days_credit", "ingestion_date"
    )


@query(
    "SELECT o_orderkey AS sk_id_curr, cast(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS bigint) "
    "AS target_flag, o_orderpriority AS name_contract_type, o_totalprice AS amt_credit, "
    "cast(o_custkey AS double) AS ext_source_1, cast(o_orderdate AS date) AS ingestion_date "
    "FROM orders WHERE o_orderstatus <> 'P'"
)
def staged_application(spark, sf):
    """Staging of applications from Silver rows some of which have no key."""
    silver_rows = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("SK_ID_CURR"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("TARGET"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        F.col("o_totalprice").alias("AMT_CREDIT"),
        F.col("o_custkey").alias("EXT_SOURCE_1"),
        F.col("o_orderdate").alias("ingestion_date"),
    )
    missing = {
        c: F.lit(None).cast("string") for c, _, _ in gold.STG_APPLICATION if c not in silver_rows.columns
    }
    return gold.stg_application(silver_rows.withColumns(missing)).select(
        "sk_id_curr", "target_flag", "name_contract_type", "amt_credit", "ext_source_1", "ingestion_date"
    )


@query(
    f"""
    SELECT name_contract_type, name_income_type, organization_type,
           cast(grouping(name_contract_type, name_income_type, organization_type) AS bigint)
             AS grouping_level,
           count(*) AS applications, count(*) FILTER (WHERE target_flag = 1) AS defaults,
           cast(count(*) FILTER (WHERE target_flag = 1) AS double) * 100.0 / count(*)
             AS default_rate_pct
    FROM (SELECT a.*, 'organization ' || (o_custkey % 7) AS organization_type
          FROM ({_STG_APP}) a JOIN orders ON o_orderkey = sk_id_curr)
    GROUP BY GROUPING SETS ((name_contract_type), (name_income_type), (organization_type), ())
    """
)
def kpi_employment_rates(spark, sf):
    """Default rate by contract type, income type and employer's organization."""
    employer = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sk_id_curr"),
        F.concat(F.lit("organization "), (F.col("o_custkey") % 7).cast("string")).alias("organization_type"),
        F.lit(None).cast("string").alias("occupation_type"),
    )
    loans = gold.with_employment(stg_application(spark, sf), employer)
    return kpi.segment_default_rates(loans, ["name_contract_type", "name_income_type", "organization_type"])


@query(
    """
    WITH bureau AS (SELECT o_custkey, count(*) AS bureau_records, round(sum(l_extendedprice), 4) AS bureau_exposure,
                           count(*) FILTER (WHERE l_returnflag = 'R') AS overdue_records
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
         paid AS (SELECT o_custkey, count(*) AS payments, avg(cast(l_linenumber AS double)) AS avg_days_payment_diff
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' GROUP BY 1),
         before AS (SELECT o_custkey, count(*) AS previous_applications FROM orders GROUP BY 1)
    SELECT c_custkey AS sk_id_curr, bureau_records, bureau_exposure, overdue_records, previous_applications,
           payments, avg_days_payment_diff
    FROM customer LEFT JOIN bureau b ON b.o_custkey = c_custkey LEFT JOIN paid p ON p.o_custkey = c_custkey
    LEFT JOIN before v ON v.o_custkey = c_custkey
    """
)
def applicant_feature_mart(spark, sf):
    """The feature mart as the batch builds it: bureau, previous applications, punctuality."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("sk_id_curr"))
    lines = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    bureau = lines.select(
        "sk_id_curr",
        F.col("l_extendedprice").alias("amt_credit_sum"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("credit_day_overdue"),
    )
    payments = lines.filter("l_linestatus = 'F'").select(
        "sk_id_curr", F.col("l_linenumber").cast("double").alias("days_payment_diff")
    )
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("sk_id_curr"))
    mart = gold.applicant_features(base, bureau, orders.drop("o_orderkey"), payments)
    return mart.withColumn("bureau_exposure", F.round("bureau_exposure", 4))
