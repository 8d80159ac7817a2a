"""Sources, sinks, jobs and incremental loads over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quaymart.functions import cut_right_closed, ratio
from quaymart.operators import marts as M
from quaymart.operators import rentals as R
from quaymart.operators.incremental import EPOCH, newer_than, read_keyed, stored_mark, upsert_table, watermark
from quaymart.operators.jobs import (
    Job, Model, build_models, read_audit, row_gate,
)
from quaymart.plans.marts import LTV_CUTS, MONTHS_FROM, last_purchase, market, performance
from quaymart.plans.registry import query
from quaymart.plans.rentals import SPEND_EDGES, rentals
from quaymart.plans.twins import r_up, twin
from quaymart.session import scratch_path, stored
from quaymart.sources.files import (
    load_csv_tables, write_csv, write_month_partitions, write_table,
)
from quaymart.sources.tables import TABLES
from quaymart.streaming.incremental import load_new_files, upsert_new_files

LOADED_AT = dt.datetime(2001, 12, 31)
EVENT_CUT = dt.datetime(2024, 1, 20)
ORDER_CUT = dt.datetime(2000, 1, 1)
MONTH = "1997-03-01"
QUARTER = ("1998-01-01", "1998-04-01")
CSV_TABLES = ("customer", "orders", "part")
FULL_LOAD = 500
LOOKBACK_DAYS = 31


@query("scan_count", "SELECT count(*) AS row_count FROM lineitem")
def q_scan_count(spark, folder):
    return market(spark, folder).t.lineitem.agg(F.count(F.lit(1)).alias("row_count"))


@query("param_scan", twin("r_customer r_rental r_payment", f"""
SELECT c.customer_id, c.first_name || ' ' || c.last_name AS full_name,
    count(r.rental_id) AS total_rentals, CAST(sum(p.cents) AS DOUBLE) / 1e2 AS total_spend,
    max(r.rental_date) AS last_rental, TIMESTAMP '{LOADED_AT}' AS load_timestamp
FROM r_customer c LEFT JOIN r_rental r ON c.customer_id = r.customer_id
LEFT JOIN r_payment p ON r.rental_id = p.rental_id GROUP BY ALL"""))
def q_param_scan(spark, folder):
    """SQL text with a named parameter; payments are folded per order first."""
    t = market(spark, folder).t
    return t.sql("""
        WITH paid AS (
          SELECT l_orderkey, count(*) AS n,
            sum((floor(l_extendedprice * 100 + 0.5)
                 * (100 - floor(l_discount * 100 + 0.5)) + 50) div 100) AS cents
          FROM lineitem GROUP BY l_orderkey),
        spent AS (
          SELECT o_custkey, sum(coalesce(n, 1)) AS n, sum(cents) AS cents,
            max(o_orderdate) AS last_rental
          FROM orders LEFT JOIN paid ON o_orderkey = l_orderkey GROUP BY o_custkey)
        SELECT c_custkey AS customer_id, c_name || ' ' || c_mktsegment AS full_name,
          coalesce(n, 0) AS total_rentals, cents / 100.0D AS total_spend, last_rental,
          CAST(:load_timestamp AS TIMESTAMP_NTZ) AS load_timestamp
        FROM customer LEFT JOIN spent ON c_custkey = o_custkey""",
                 ("customer", "orders", "lineitem"), load_timestamp=LOADED_AT)


@query("table_inventory", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({len(s)} AS BIGINT) AS column_count"
    f" FROM {t}" for t, s in TABLES.items()))
def q_table_inventory(spark, folder):
    return market(spark, folder).t.inventory()


@query("csv_roundtrip", "SELECT * FROM orders")
def q_csv_roundtrip(spark, folder):
    """Tables out to CSV, bulk-loaded back with declared schemas; one file is absent."""
    t = market(spark, folder).t
    root = scratch_path(spark, "csv")
    files = {name: write_csv(t.scan(name), f"{root}/in/{name}") for name in CSV_TABLES}
    files["supplier"] = f"{root}/in/absent"
    return load_csv_tables(spark, files, TABLES, f"{root}/raw")["orders"]


@query("sink_roundtrip", """SELECT c_mktsegment, 2 * count(*) AS row_count,
    count(DISTINCT c_custkey) AS customers FROM customer GROUP BY 1""")
def q_sink_roundtrip(spark, folder):
    """Replace twice, append once: what is stored is the table two times."""
    customer = market(spark, folder).t.customer
    path = scratch_path(spark, "sink")
    write_table(customer, path)
    write_table(customer, path, "replace")
    stored = write_table(customer, path, "append")
    return stored.groupBy("c_mktsegment", "c_custkey").agg(F.count(F.lit(1)).alias("n")).groupBy(
        "c_mktsegment").agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("customers"))


def partitioned_metrics(spark, folder):
    """The order mart as a table by month, built once per session."""
    def build():
        m = market(spark, folder)
        return M.order_metrics(m.order_facts(), m.customers).select(
            "order_id", "purchased_at", "order_status", "delivery_days", "is_late", "total_payment",
            "review_score")

    return stored(spark, f"order_metrics {folder}", build,
                  write=lambda df, path: write_month_partitions(df, path, "purchased_at"))


@query("partitioned_month_filter", twin("v_order_metrics", f"""
SELECT count(*) AS orders, {r_up('sum(CAST(review_score AS BIGINT))', 'count(*)', 4, 0)}
    AS avg_review, sum(CAST(round(total_payment * 100) AS BIGINT))::DOUBLE / 1e2 AS payment
FROM v_order_metrics WHERE date_trunc('month', purchased_at) = DATE '{MONTH}'"""))
def q_partitioned_month_filter(spark, folder):
    """One month of the partitioned table: the filter prunes folders."""
    table = partitioned_metrics(spark, folder)
    return table.where(F.col("purchase_month") == F.lit(MONTH).cast("date")).agg(
        F.count(F.lit(1)).alias("orders"),
        ratio(F.sum(M.to_cents("review_score")), F.count("review_score"), 4, 2).alias("avg_review"),
        M.from_cents(F.sum(M.to_cents("total_payment"))).alias("payment"))


@query("partitioned_quarter_filter", twin("v_order_metrics", f"""
SELECT count(*) AS orders, {r_up('sum(delivery_days)', 'count(*)', 4, 0)} AS avg_delivery_days
FROM v_order_metrics WHERE purchased_at >= DATE '{QUARTER[0]}'
  AND purchased_at < DATE '{QUARTER[1]}' AND is_late"""))
def q_partitioned_quarter_filter(spark, folder):
    table = partitioned_metrics(spark, folder)
    month = F.col("purchase_month")
    start, end = (F.lit(d).cast("date") for d in QUARTER)
    return table.where((month >= start) & (month < end) & F.col("is_late")).agg(
        F.count(F.lit(1)).alias("orders"),
        ratio(F.sum("delivery_days"), F.count("delivery_days"), 4).alias("avg_delivery_days"))


class CustomerJob(Job):
    """Customer lifetime spend with segment and load date."""

    source_table, target_table = "customer", "customer_lifetime"

    def __init__(self, spark, folder, target_path, **options):
        super().__init__(spark, target_path, **options)
        self.roles = rentals(spark, folder)

    def extract(self):
        r = self.roles
        return R.customer_lifetime(r.customer, r.rental, r.payment, F.lit(LOADED_AT).cast(
            "timestamp_ntz"))

    def transform(self, df):
        return df.withColumns({
            "value_segment": cut_right_closed("total_spend", SPEND_EDGES),
            "load_date": F.col("load_timestamp").cast("date")})


def run_customer_job(spark, folder):
    audit = scratch_path(spark, "audit")
    job = CustomerJob(spark, folder, scratch_path(spark, "customer-job"), audit_path=audit)
    return job, job.run()


@query("customer_job", twin("v_lifetime", f"""
SELECT *, TIMESTAMP '{LOADED_AT}' AS load_timestamp,
    CASE WHEN total_spend IS NULL OR total_spend <= 0 THEN NULL
      WHEN total_spend <= {SPEND_EDGES[1]} THEN 'Bronze'
      WHEN total_spend <= {SPEND_EDGES[2]} THEN 'Silver'
      WHEN total_spend <= {SPEND_EDGES[3]} THEN 'Gold' ELSE 'Platinum' END AS value_segment,
    CAST(TIMESTAMP '{LOADED_AT}' AS DATE) AS load_date FROM v_lifetime"""))
def q_customer_job(spark, folder):
    return run_customer_job(spark, folder)[0].loaded()


@query("audit_append", """SELECT 'CustomerJob' AS pipeline_name, 'customer' AS source_table,
    'customer_lifetime' AS target_table, count(*) AS rows_loaded, 'success' AS status
FROM customer""")
def q_audit_append(spark, folder):
    job, _ = run_customer_job(spark, folder)
    return read_audit(spark, job.audit_path).select("pipeline_name", "source_table", "target_table",
                                          "rows_loaded", "status")


@query("row_gate", f"""SELECT count(*) AS rows_loaded, CASE WHEN count(*) >= {FULL_LOAD}
    THEN 'validate_full_load' ELSE 'notify_low_count' END AS next_step FROM customer""")
def q_row_gate(spark, folder):
    return row_gate(run_customer_job(spark, folder)[0].loaded(), FULL_LOAD)


@query("incremental_new_rows", f"""SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{EVENT_CUT}')""")
def q_incremental_new_rows(spark, folder):
    """Rows above what an earlier load stored."""
    events = market(spark, folder).t.events.select("event_id", "ts", "user_id", "event_type",
                                                   "value")
    stored = write_table(events.where(F.col("ts") <= F.lit(EVENT_CUT).cast("timestamp_ntz")),
                         scratch_path(spark, "events"))
    return newer_than(events, "ts", watermark(stored, "ts"))


@query("incremental_upsert", twin("v_order_metrics", """SELECT *,
    CAST(date_trunc('month', purchased_at) AS DATE) AS purchase_month FROM v_order_metrics"""))
def q_incremental_upsert(spark, folder):
    """First run up to a cut, second run above the watermark with a look-back.

    The look-back reads a month again, so keys that are already stored come a
    second time and are replaced. The end state equals the mart built at once.
    """
    m = market(spark, folder)

    def metrics(**span):
        return M.order_metrics(m.order_facts(**span), m.customers).withColumn(
            "purchase_month", M.month_start("purchased_at"))

    path = scratch_path(spark, "order-metrics")
    upsert_table(spark, path, metrics(bought_to=ORDER_CUT.isoformat()), "order_id", "purchase_month")
    mark, again = stored_mark(spark, path, "purchased_at") or EPOCH, LOOKBACK_DAYS
    batch = newer_than(metrics(bought_from=(mark - dt.timedelta(days=again)).isoformat()),
                       "purchased_at", mark, lookback_days=again)
    return upsert_table(spark, path, batch, "order_id", "purchase_month", fixed=True)


def two_builds(spark, folder):
    """The order models built on the orders up to a cut, then on all; the folder of the tables."""
    m, root = market(spark, folder), scratch_path(spark, "order-models")
    build_models(spark, order_models(m, ORDER_CUT.isoformat()), root)
    build_models(spark, order_models(m), root)
    return root


@query("incremental_models", twin("v_order_metrics", """SELECT *,
    CAST(date_trunc('month', purchased_at) AS DATE) AS purchase_month FROM v_order_metrics"""))
def q_incremental_models(spark, folder):
    """The order mart after two builds, the second of which sees the stored target."""
    return read_keyed(spark, f"{two_builds(spark, folder)}/mart_order_metrics")


@query("incremental_touched", f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS purchase_month, count(*) AS orders,
    max(o_orderdate) > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{ORDER_CUT}')
      - INTERVAL {LOOKBACK_DAYS} DAY AS written_again
FROM orders GROUP BY 1""")
def q_incremental_touched(spark, folder):
    """Months of the order facts and whether the second build wrote them: its files lie in the newest data folder."""
    table = read_keyed(spark, f"{two_builds(spark, folder)}/order_facts")
    written = F.regexp_extract(F.col("_metadata.file_path"), "/data-([0-9a-f]+)/", 1)
    months = table.groupBy("purchase_month", written.alias("folder")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("_metadata.file_modification_time").alias("at"))
    newest = months.agg(F.max_by("folder", "at")).scalar()
    return months.select("purchase_month", "orders", (F.col("folder") == newest).alias("written_again"))


@query("incremental_stream", "SELECT * FROM events")
def q_incremental_stream(spark, folder):
    """Two runs of the file stream over a folder that grows in between."""
    events = market(spark, folder).t.events
    root = scratch_path(spark, "stream")
    early = F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz")
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").parquet(f"{root}/in")
        out = load_new_files(spark, f"{root}/in", TABLES["events"], f"{root}/out",
                             f"{root}/checkpoint")
    return out


@query("incremental_stream_upsert", """SELECT user_id, event_id, ts, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events) WHERE r = 1""")
def q_incremental_stream_upsert(spark, folder):
    """Latest event per user, kept current by an upserting stream in two runs."""
    events = market(spark, folder).t.events
    root = scratch_path(spark, "stream-upsert")
    early = F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz")
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").parquet(f"{root}/in")
        out = upsert_new_files(spark, f"{root}/in", TABLES["events"], f"{root}/out",
                               f"{root}/checkpoint", "user_id", "ts", ties=["event_id"])
    return out


@query("incremental_late_rows", """SELECT user_id, event_id, ts, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events) WHERE r = 1""")
def q_incremental_late_rows(spark, folder):
    """The same with the newer half of the events first: late rows must not win."""
    events = market(spark, folder).t.events
    root = scratch_path(spark, "late-upsert")
    late = F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz")
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(f"{root}/in")
        out = upsert_new_files(spark, f"{root}/in", TABLES["events"], f"{root}/out",
                               f"{root}/checkpoint", "user_id", "ts", "event_type", ["event_id"])
    return out


def order_models(m, bought_to=None):
    """The order facts and the order mart, each computed only from where its stored rows end.

    The facts take the time into the scan of the orders, and with it into that of
    the lines; the mart reads the facts stored since then.
    """
    def facts(_, since):
        return m.order_facts(since and since.isoformat(), bought_to).withColumn("purchase_month", M.month_start("purchased_at"))

    def metrics(built, since):
        rows = built["order_facts"]
        if since is not None:
            rows = rows.where(F.col("purchased_at") > F.lit(since).cast("timestamp_ntz"))
        return M.order_metrics(rows, built["stg_customers"]).withColumn("purchase_month", M.month_start("purchased_at"))

    kept = {"materialized": "incremental", "key": "order_id", "at": "purchased_at", "partition_by": "purchase_month",
            "lookback_days": LOOKBACK_DAYS}
    return {
        "order_facts": Model(facts, **kept),
        "stg_customers": Model(lambda _: M.stg_customers(m.customers), materialized="view"),
        "mart_order_metrics": Model(metrics, ("order_facts", "stg_customers"), **kept),
    }


def mart_models(m):
    """Staging views and mart tables with their dependencies."""
    since = F.lit(MONTHS_FROM).cast("timestamp_ntz")
    return order_models(m) | {
        "mart_customer_ltv": Model(
            lambda b: M.customer_ltv(b["order_facts"], b["stg_customers"], last_purchase(m),
                                     LTV_CUTS), ("order_facts", "stg_customers")),
        "mart_seller_summary": Model(
            lambda b: M.seller_summary(m.sellers, m.order_items, b["order_facts"]),
            ("order_facts",)),
        "mart_product_metrics": Model(
            lambda b: M.order_product_metrics(b["order_facts"], b["stg_customers"]),
            ("order_facts", "stg_customers")),
        "monthly_revenue": Model(lambda b: M.monthly_revenue(b["order_facts"], since),
                                 ("order_facts",)),
        "mart_seller_performance": Model(lambda _: performance(m)),
        "mart_product_analytics": Model(lambda _: M.product_analytics(
            m.products, m.category_translation, m.order_items, m.orders, m.order_reviews)),
    }


CHAIN_ROWS = """SELECT 'order_facts' AS model, 'incremental' AS materialized, count(*) AS row_count FROM orders
UNION ALL SELECT 'stg_customers', 'view', count(*) FROM m_customers
UNION ALL SELECT 'mart_customer_ltv', 'table', count(*) FROM v_ltv
UNION ALL SELECT 'mart_order_metrics', 'incremental', count(*) FROM v_order_metrics
UNION ALL SELECT 'mart_seller_summary', 'table', count(DISTINCT l_suppkey) FROM lineitem
    JOIN m_orders ON l_orderkey = order_id WHERE order_status = 'delivered'
UNION ALL SELECT 'mart_product_metrics', 'table', count(*) FROM m_orders
    JOIN stg_payments USING (order_id) WHERE order_status = 'delivered'
UNION ALL SELECT 'monthly_revenue', 'table', count(*) FROM v_months
UNION ALL SELECT 'mart_seller_performance', 'table', count(*) FROM v_performance
UNION ALL SELECT 'mart_product_analytics', 'table', count(*) FROM v_products"""


@query("mart_chain", twin("v_ltv v_order_metrics v_months v_performance v_products stg_payments", CHAIN_ROWS))
def q_mart_chain(spark, folder):
    """All models in dependency order; one pass over the line table feeds five marts."""
    models = mart_models(market(spark, folder))
    built = build_models(spark, models, scratch_path(spark, "chain"))
    out = None
    for name, df in built.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), F.lit(models[name].materialized).alias("materialized"),
            "row_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("plain_month_filter", twin("v_order_metrics", f"""
SELECT count(*) AS orders, {r_up('sum(CAST(review_score AS BIGINT))', 'count(*)', 4, 0)}
    AS avg_review, sum(CAST(round(total_payment * 100) AS BIGINT))::DOUBLE / 1e2 AS payment
FROM v_order_metrics WHERE date_trunc('month', purchased_at) = DATE '{MONTH}'"""))
def q_plain_month_filter(spark, folder):
    """The month filter on the unpartitioned mart, to set beside the partitioned one."""
    m = market(spark, folder)
    end = (dt.date.fromisoformat(MONTH) + dt.timedelta(days=31)).isoformat()
    month = M.order_metrics(m.order_facts(MONTH, end), m.customers)
    return month.agg(
        F.count(F.lit(1)).alias("orders"),
        ratio(F.sum(M.to_cents("review_score")), F.count("review_score"), 4, 2).alias("avg_review"),
        M.from_cents(F.sum(M.to_cents("total_payment"))).alias("payment"))


@query("plain_quarter_filter", twin("v_order_metrics", f"""
SELECT count(*) AS orders, {r_up('sum(delivery_days)', 'count(*)', 4, 0)} AS avg_delivery_days
FROM v_order_metrics WHERE purchased_at >= DATE '{QUARTER[0]}'
  AND purchased_at < DATE '{QUARTER[1]}' AND is_late"""))
def q_plain_quarter_filter(spark, folder):
    m = market(spark, folder)
    late = M.order_metrics(m.order_facts(*QUARTER), m.customers).where(F.col("is_late"))
    return late.agg(
        F.count(F.lit(1)).alias("orders"),
        ratio(F.sum("delivery_days"), F.count("delivery_days"), 4).alias("avg_delivery_days"))
