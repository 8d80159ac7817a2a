"""Data quality and profiling queries over the driver tables."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from quaymart.operators import marts as M
from quaymart.operators import quality as Q
from quaymart.plans.marts import LTV_CUTS, last_purchase, market
from quaymart.plans.registry import query
from quaymart.plans.rentals import rentals, tiers
from quaymart.plans.twins import twin
from quaymart.session import stage
from quaymart.sources.tables import (
    FOREIGN_KEYS, KEYS, TABLES, catalog_columns, register_folder, schema_columns, with_keys,
)

CORE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# Expected rows at the scale factor of the correctness run.
EXPECTED_ROWS = {"region": 5, "nation": 25, "customer": 1500, "supplier": 100, "part": 2000,
                 "orders": 15000, "lineitem": 60000, "events": 10000}
MIN_ROWS = {"region": 5, "nation": 25, "customer": 100, "supplier": 10, "part": 200,
            "orders": 1500, "events": 1000}
FUTURE = "2001-11-01"
STATUSES = ("delivered", "shipped")
CONFIG = {"customers": {"target": "customer", "min_rows": 1000},
          "orders": {"target": "orders", "min_rows": 15000},
          "parts": {"target": "part", "min_rows": 5000},
          "returns": {"target": "returns", "min_rows": 1}}


@query("dq_row_counts", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, n AS row_count, CAST({e} AS BIGINT) AS expected,
    CASE WHEN n = {e} THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS n FROM {t})"""
    for t, e in EXPECTED_ROWS.items()))
def q_dq_row_counts(spark, folder):
    t = market(spark, folder).t
    checks = [Q.Check(n, n, F.count(F.lit(1)), e) for n, e in EXPECTED_ROWS.items()]
    return Q.run_checks({n: t.scan(n) for n in EXPECTED_ROWS}, checks).select(
        F.col("check_name").alias("table_name"), F.col("value").alias("row_count"), "expected",
        "status")


_CHECKS = (
    ("orders row count", "orders", "count(*)", 15000),
    ("no negative order totals", "orders", "count(CASE WHEN o_totalprice < 0 THEN 1 END)", 0),
    ("no orders without customer", "orders", "count(CASE WHEN o_custkey IS NULL THEN 1 END)", 0),
    ("lineitem row count", "lineitem", "count(*)", 60000),
    ("no negative prices", "lineitem", "count(CASE WHEN l_extendedprice < 0 THEN 1 END)", 0),
    ("no future shipments", "lineitem",
     f"count(CASE WHEN l_shipdate > TIMESTAMP '{FUTURE}' THEN 1 END)", 0),
    ("no overdrawn customers", "customer", "count(CASE WHEN c_acctbal < 0 THEN 1 END)", 0),
)


@query("dq_checks", " UNION ALL ".join(
    f"""SELECT '{n}' AS check_name, v AS value, CAST({e} AS BIGINT) AS expected,
    CASE WHEN v = {e} THEN 'PASS' ELSE 'FAIL' END AS status, CAST(NULL AS VARCHAR) AS error
    FROM (SELECT {x} AS v FROM {t})""" for n, t, x, e in _CHECKS))
def q_dq_checks(spark, folder):
    t = market(spark, folder).t
    future = F.col("l_shipdate") > F.lit(FUTURE).cast("timestamp_ntz")
    exprs = [F.count(F.lit(1)), F.count_if(F.col("o_totalprice") < 0),
             F.count_if(F.col("o_custkey").isNull()), F.count(F.lit(1)),
             F.count_if(F.col("l_extendedprice") < 0), F.count_if(future),
             F.count_if(F.col("c_acctbal") < 0)]
    checks = [Q.Check(n, table, x, e) for (n, table, _, e), x in zip(_CHECKS, exprs)]
    return Q.run_checks({n: t.scan(n) for n in ("orders", "lineitem", "customer")}, checks)


@query("dq_null_share", twin("r_item_rental", """
SELECT 'return_date' AS column_name, null_count, total,
    round(null_count * 1000.0::DOUBLE / total) / 10.0::DOUBLE AS null_pct,
    CASE WHEN null_count * 100 > total * 5 THEN 'WARNING' ELSE 'OK' END AS status
FROM (SELECT count(CASE WHEN return_date IS NULL THEN 1 END) AS null_count, count(*) AS total
      FROM r_item_rental)"""))
def q_dq_null_share(spark, folder):
    return Q.null_share(rentals(spark, folder).item_rental, "return_date", 5)


@query("dq_unique", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dq_unique(spark, folder):
    return Q.not_unique(market(spark, folder).t.lineitem, "l_orderkey", "l_linenumber")


@query("dq_not_null", twin("stg_orders", """SELECT order_id, order_status FROM stg_orders
WHERE delivered_at IS NULL AND order_status = 'delivered'"""))
def q_dq_not_null(spark, folder):
    orders = M.stg_orders(market(spark, folder).orders)
    return Q.is_null(orders, "delivered_at", where=F.col("order_status") == "delivered").select(
        "order_id", "order_status")


@query("dq_accepted", twin("m_orders", """SELECT order_status AS value, count(*) AS n FROM m_orders
WHERE order_status NOT IN ('delivered', 'shipped') GROUP BY 1"""))
def q_dq_accepted(spark, folder):
    return Q.not_accepted(market(spark, folder).orders_undated, "order_status", STATUSES)


@query("dq_relationship", """SELECT o_orderkey AS value, count(*) AS n FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""")
def q_dq_relationship(spark, folder):
    t = market(spark, folder).t
    return Q.orphans(t.orders, "o_orderkey", t.lineitem, "l_orderkey")


@query("dq_singular", twin("stg_orders stg_payments", """
SELECT 'assert_no_negative_payments' AS test_name, count(*) AS failures, count(*) = 0 AS passed
FROM stg_payments WHERE total_payment_cents < 0
UNION ALL SELECT 'assert_late_orders_have_delivery_date', count(*), count(*) = 0
FROM stg_orders WHERE is_late AND delivered_at IS NULL"""))
def q_dq_singular(spark, folder):
    m = market(spark, folder)
    payments, orders = M.stg_order_payments(m.order_payments), M.stg_orders(m.orders)
    return Q.run_tests({
        "assert_no_negative_payments": payments.where(F.col("total_payment_cents") < 0),
        "assert_late_orders_have_delivery_date": orders.where(
            F.col("is_late") & F.col("delivered_at").isNull())})


# The order states that the staging model accepts.
ORDER_STATES = ("delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved")


def mart_tests(raw_orders, raw_customers, orders, customers, payments, metrics, lifetime, sellers):
    """All declared tests of sources, staging and mart models, as verdict rows.

    Tests that look at single rows share one aggregate per frame; those that
    compare rows find their violations apart.
    """
    def empty(*cols):
        return {f"{c} not_null": F.col(c).isNull() for c in cols}

    def outside(col, values):
        return {f"{col} accepted": F.col(col).isNotNull() & ~F.col(col).isin(*values)}

    by_row = {
        "raw.orders": (raw_orders, empty("order_id")),
        "raw.customers": (raw_customers, empty("customer_id")),
        "stg_orders": (orders, empty("order_id", "customer_id") | outside("order_status", ORDER_STATES) | outside("is_late", (True, False))),
        "stg_customers": (customers, empty("customer_id", "customer_unique_id")),
        "stg_order_payments": (payments, empty("order_id", "total_payment_cents")),
        "mart_customer_ltv": (lifetime, empty("customer_unique_id", "total_orders", "total_spent")
                              | outside("value_segment", ("Bronze", "Silver", "Gold", "Platinum")) | outside("is_churned", (0, 1))),
        "mart_order_metrics": (metrics, empty("order_id", "total_payment") | outside("is_late", (True, False))
                               | {"is_late not_null": F.col("is_late").isNull() & (F.col("order_status") == "delivered")}),
        "mart_seller_summary": (sellers, empty("seller_id", "total_orders", "total_revenue")),
    }
    between = {
        "raw.orders.order_id unique": Q.not_unique(raw_orders, "order_id"),
        "stg_orders.order_id unique": Q.not_unique(orders, "order_id"),
        "stg_orders.customer_id relationships": Q.orphans(orders, "customer_id", customers, "customer_id"),
        "stg_customers.customer_id unique": Q.not_unique(customers, "customer_id"),
        "stg_order_payments.order_id unique": Q.not_unique(payments, "order_id"),
        "mart_customer_ltv.customer_unique_id unique": Q.not_unique(lifetime, "customer_unique_id"),
        "mart_order_metrics.order_id unique": Q.not_unique(metrics, "order_id"),
        "mart_seller_summary.seller_id unique": Q.not_unique(sellers, "seller_id"),
    }
    out = Q.run_tests(between)
    for model, (frame, tests) in by_row.items():
        out = out.unionByName(Q.count_violations(frame, {f"{model}.{name}": bad for name, bad in tests.items()}))
    return out


_T = "SELECT '{}' AS test_name, count(*) AS failures, count(*) = 0 AS passed FROM {}"


def _unique_sql(table, key):
    return f"(SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


def _null_sql(model, table, *cols):
    return {f"{model}.{c} not_null": f"{table} WHERE {c} IS NULL" for c in cols}


_SUITE = (
    _null_sql("raw.orders", "m_orders", "order_id") | _null_sql("raw.customers", "m_customers", "customer_id")
    | _null_sql("stg_orders", "stg_orders", "order_id", "customer_id")
    | _null_sql("stg_customers", "m_customers", "customer_id", "customer_unique_id")
    | _null_sql("stg_order_payments", "stg_payments", "order_id", "total_payment_cents")
    | _null_sql("mart_customer_ltv", "v_ltv", "customer_unique_id", "total_orders", "total_spent")
    | _null_sql("mart_order_metrics", "v_order_metrics", "order_id", "total_payment", "is_late")
    | _null_sql("mart_seller_summary", "v_seller_summary", "seller_id", "total_orders", "total_revenue")
    | {
        "raw.orders.order_id unique": _unique_sql("m_orders", "order_id"),
        "stg_orders.order_id unique": _unique_sql("stg_orders", "order_id"),
        "stg_orders.customer_id relationships": "stg_orders WHERE customer_id NOT IN (SELECT customer_id FROM m_customers)",
        "stg_orders.order_status accepted": f"stg_orders WHERE order_status NOT IN {ORDER_STATES}",
        "stg_orders.is_late accepted": "stg_orders WHERE is_late NOT IN (true, false)",
        "stg_customers.customer_id unique": _unique_sql("m_customers", "customer_id"),
        "stg_order_payments.order_id unique": _unique_sql("stg_payments", "order_id"),
        "mart_customer_ltv.customer_unique_id unique": _unique_sql("v_ltv", "customer_unique_id"),
        "mart_customer_ltv.value_segment accepted": "v_ltv WHERE value_segment NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum')",
        "mart_customer_ltv.is_churned accepted": "v_ltv WHERE is_churned NOT IN (0, 1)",
        "mart_order_metrics.order_id unique": _unique_sql("v_order_metrics", "order_id"),
        "mart_order_metrics.is_late accepted": "v_order_metrics WHERE is_late NOT IN (true, false)",
        "mart_seller_summary.seller_id unique": _unique_sql("v_seller_summary", "seller_id"),
    })


@query("dq_suite", twin("v_ltv v_order_metrics v_seller_summary stg_payments stg_orders m_orders m_customers",
                        " UNION ALL ".join(_T.format(n, x) for n, x in _SUITE.items())))
def q_dq_suite(spark, folder):
    """All thirty declared tests; each frame that several tests share is staged once."""
    m = market(spark, folder)
    facts = stage(m.order_facts())
    lifetime = stage(M.customer_ltv(facts, m.customers, last_purchase(m), LTV_CUTS)
                     .select("customer_unique_id", "total_orders", "total_spent", "value_segment", "is_churned"))
    payments = facts.where(F.col("payment_installments").isNotNull()).select(
        "order_id", "total_payment_cents")
    sellers = stage(M.seller_summary(m.sellers, m.order_items, facts).select("seller_id", "total_orders", "total_revenue"))
    return mart_tests(m.orders_undated, m.customers, facts, M.stg_customers(m.customers), payments,
                      M.order_metrics(facts, m.customers), lifetime, sellers)


_NUMERIC = {"int", "bigint", "double"}


def _profile_sql(table: str) -> str:
    parts = []
    for f in TABLES[table].fields:
        c, kind = f.name, f.dataType.simpleString()
        num = kind in _NUMERIC
        d = f"CAST({c} AS DOUBLE)"

        def stat(x):
            return f"round_even({x} * 1e4, 0) / 1e4" if num else "CAST(NULL AS DOUBLE)"

        def plain(x):
            return x if num else "CAST(NULL AS DOUBLE)"

        parts.append(f"""SELECT '{c}' AS column_name, '{kind}' AS data_type,
    count(*) - count({c}) AS null_count, {plain(f'min({d})')} AS min_value,
    {plain(f'max({d})')} AS max_value, {stat(f'avg({d})')} AS mean_value,
    {stat(f'stddev_samp({d})')} AS std_value, count(*) AS row_count,
    round((count(*) - count({c})) * 1e3 / count(*)) / 1e1 AS null_pct,
    {stat(f'quantile_cont({d}, 0.25)')} AS q25, {stat(f'quantile_cont({d}, 0.5)')} AS q50,
    {stat(f'quantile_cont({d}, 0.75)')} AS q75,
    (SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))
      AS duplicate_rows FROM {table}""")
    return " UNION ALL ".join(parts)


@query("table_profile", _profile_sql("lineitem"))
def q_table_profile(spark, folder):
    return Q.table_profile(market(spark, folder).t.lineitem)


def _key_profile_sql() -> str:
    parts = []
    for t, floor in MIN_ROWS.items():
        nulls = " + ".join(f"(count(*) - count({f.name}))" for f in TABLES[t].fields)
        parts.append(f"""SELECT '{t}' AS table_name, count(*) AS row_count,
    CAST({floor} AS BIGINT) AS min_rows, count(*) >= {floor} AS passed, {nulls} AS null_count,
    CAST(max({KEYS[t]}) - min({KEYS[t]}) AS BIGINT) AS key_range FROM {t}""")
    return " UNION ALL ".join(parts)


def _key_profile(spark, folder):
    t = market(spark, folder).t
    return Q.key_profile({n: (t.scan(n), KEYS[n], floor) for n, floor in MIN_ROWS.items()})


@query("key_profile", _key_profile_sql())
def q_key_profile(spark, folder):
    return _key_profile(spark, folder)


@query("dq_summary", f"""SELECT count(*) AS total, count(CASE WHEN passed THEN 1 END) AS passed,
count(CASE WHEN NOT passed THEN 1 END) AS failed FROM ({_key_profile_sql()})""")
def q_dq_summary(spark, folder):
    return Q.pass_summary(_key_profile(spark, folder))


@query("schema_columns", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type,
    CAST({pos} AS INTEGER) AS position, {str(key).lower()} AS is_key,
    {f"'{ref}'" if ref else "CAST(NULL AS VARCHAR)"} AS references_column,
    count({c}) AS filled_rows FROM {t}""" for t, c, kind, pos, key, ref in schema_columns(CORE)))
def q_schema_columns(spark, folder):
    """Tables, columns, types, keys and references, with the filled rows of each column."""
    t = market(spark, folder).t
    out = None
    for name in CORE:
        filled = t.scan(name).agg(*[F.count(f.name).alias(f.name) for f in TABLES[name].fields])
        rows = filled.select(F.explode(F.array(*[
            F.struct(F.lit(tab).alias("table_name"), F.lit(c).alias("column_name"),
                     F.lit(kind).alias("data_type"), F.lit(pos).alias("position"),
                     F.lit(key).alias("is_key"),
                     F.lit(ref).cast("string").alias("references_column"),
                     F.col(c).alias("filled_rows"))
            for tab, c, kind, pos, key, ref in schema_columns([name])])).alias("r")).select("r.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def _catalog_sql() -> str:
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
             "DATE": "date", "BOOLEAN": "boolean", "FLOAT[]": "array<float>"}
    kind = " ".join(f"WHEN '{duck}' THEN '{spark}'" for duck, spark in kinds.items())
    keys = " OR ".join(f"(table_name = '{t}' AND column_name = '{c}')" for t, c in KEYS.items())
    refs = " ".join(f"WHEN table_name = '{t}' AND column_name = '{c}' THEN '{'.'.join(to)}'" for (t, c), to in FOREIGN_KEYS.items())
    tables = " UNION ALL ".join(f"""SELECT '{t}' AS table_name, column_name, column_type,
        CAST(row_number() OVER () AS INTEGER) AS position FROM (DESCRIBE {t})""" for t in TABLES)
    return f"""SELECT table_name, column_name, CASE column_type {kind} ELSE column_type END AS data_type, position,
        {keys} AS is_key, CASE {refs} END AS references_column FROM ({tables})"""


@query("catalog_columns", _catalog_sql())
def q_catalog_columns(spark, folder):
    """Every column of every table of the folder, read from the session catalog."""
    t = market(spark, folder).t
    database = "quaymart_" + hashlib.md5(t.folder.encode()).hexdigest()[:12]
    register_folder(spark, t.folder, database)
    return with_keys(catalog_columns(spark, database))


_RULES = " UNION ALL ".join(
    f"SELECT '{job}' AS job, '{c['target']}' AS table_name, CAST({c['min_rows']} AS BIGINT) AS min_rows"
    for job, c in CONFIG.items())


@query("config_count_check", f"""
SELECT r.job, r.table_name, c.row_count, r.min_rows,
    coalesce(c.row_count >= r.min_rows, false) AS passed FROM ({_RULES}) r LEFT JOIN (
""" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                         for t in CORE) + ") c ON r.table_name = c.table_name")
def q_config_count_check(spark, folder):
    counts = market(spark, folder).t.inventory(CORE)
    return Q.config_count_check(spark, json.dumps(CONFIG), counts)


@query("tier_values_check", twin("v_tier", """
SELECT count(DISTINCT value_tier) AS tiers_found,
    count(DISTINCT value_tier) FILTER (value_tier IN ('Budget', 'Standard', 'Premium')) = 3
      AND count(DISTINCT value_tier) = 3 AS passed FROM v_tier"""))
def q_tier_values_check(spark, folder):
    """All three tiers, and no other, must occur."""
    found = tiers(rentals(spark, folder)).select("value_tier").distinct()
    known = F.count_if(F.col("value_tier").isin("Budget", "Standard", "Premium"))
    return found.agg(F.count("value_tier").alias("tiers_found"),
                     ((known == 3) & (F.count("value_tier") == 3)).alias("passed"))

