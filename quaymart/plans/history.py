"""Order snapshots over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quaymart.operators import history as H
from quaymart.operators import marts as M
from quaymart.plans.marts import market
from quaymart.plans.registry import query
from quaymart.plans.twins import add_view, twin
from quaymart.session import scratch_path, stage

SEEN = (dt.datetime(1998, 1, 1), dt.datetime(2000, 1, 1), dt.datetime(2002, 1, 1))
CHECKED = ("order_status", "delivered_at")
COLUMNS = ("order_id", "customer_id", "order_status", "purchased_at", "approved_at", "shipped_at",
           "delivered_at", "estimated_delivery_at", "is_late")


def as_seen(orders, at: dt.datetime):
    """The staged orders as they looked at a time.

    Orders bought later are absent; a delivery in the future is not known yet,
    and a delivered order without a known delivery still counts as shipped.
    """
    when = F.lit(at).cast("timestamp_ntz")
    known = F.col("delivered_at") <= when
    waiting = (F.col("order_status") == "delivered") & ~F.coalesce(known, F.lit(False))
    return orders.where(F.col("purchased_at") <= when).select(
        "order_id", "customer_id",
        F.when(waiting, "shipped").otherwise(F.col("order_status")).alias("order_status"),
        "purchased_at", "approved_at", "shipped_at",
        F.when(known, F.col("delivered_at")).alias("delivered_at"), "estimated_delivery_at",
        F.when(known, F.col("is_late")).alias("is_late"))


def snapshots(spark, folder):
    """Three visits to the orders, kept in a snapshot store."""
    orders = stage(M.stg_orders(market(spark, folder).orders).select(*COLUMNS))
    store = H.SnapshotStore(spark, scratch_path(spark, "orders-snapshot"), "order_id", CHECKED)
    for at in SEEN:
        store.visit(as_seen(orders, at), at)
    return store.history()


def _seen_sql(at: dt.datetime) -> str:
    t = f"TIMESTAMP '{at}'"
    return f"""SELECT order_id, customer_id,
    CASE WHEN order_status = 'delivered' AND NOT coalesce(delivered_at <= {t}, false)
      THEN 'shipped' ELSE order_status END AS order_status,
    purchased_at, approved_at, shipped_at,
    CASE WHEN delivered_at <= {t} THEN delivered_at END AS delivered_at, estimated_delivery_at,
    CASE WHEN delivered_at <= {t} THEN is_late END AS is_late, {t} AS seen_at
FROM stg_orders WHERE purchased_at <= {t}"""


# Versions by the plain definition: a visit starts one when it is the first of
# its key or a checked column differs from the visit before.
add_view("v_visits", "stg_orders", " UNION ALL ".join(_seen_sql(at) for at in SEEN))
add_view("v_starts", "v_visits", """SELECT * FROM (SELECT *,
    lag(seen_at) OVER w IS NULL OR order_status IS DISTINCT FROM lag(order_status) OVER w
      OR delivered_at IS DISTINCT FROM lag(delivered_at) OVER w AS starts
  FROM v_visits WINDOW w AS (PARTITION BY order_id ORDER BY seen_at)) WHERE starts""")
add_view("v_snapshot", "v_starts", """SELECT * EXCLUDE (seen_at, starts), seen_at AS dbt_valid_from,
    lead(seen_at) OVER (PARTITION BY order_id ORDER BY seen_at) AS dbt_valid_to,
    coalesce(lead(seen_at) OVER (PARTITION BY order_id ORDER BY seen_at), seen_at)
      AS dbt_updated_at FROM v_starts""")


@query("scd2_snapshot", twin("v_snapshot", "SELECT * FROM v_snapshot"))
def q_scd2_snapshot(spark, folder):
    return snapshots(spark, folder)


@query("scd2_current", twin("v_snapshot", """SELECT order_id, order_status, is_late,
    dbt_valid_from, dbt_valid_to, dbt_updated_at FROM v_snapshot WHERE dbt_valid_to IS NULL
ORDER BY dbt_valid_from DESC NULLS FIRST, order_id LIMIT 10"""))
def q_scd2_current(spark, folder):
    return H.recent_current(snapshots(spark, folder), "order_id").select(
        "order_id", "order_status", "is_late", *H.VALIDITY)


@query("status_changes", twin("v_snapshot", """SELECT s.order_id, s.order_status, s.dbt_valid_from,
    s.dbt_valid_to FROM v_snapshot s JOIN (SELECT order_id FROM v_snapshot GROUP BY 1
    HAVING count(*) > 1) c ON s.order_id = c.order_id"""))
def q_status_changes(spark, folder):
    changed = H.changed_keys(snapshots(spark, folder), "order_id")
    return changed.select("order_id", "order_status", H.VALID_FROM, H.VALID_TO)


@query("snapshot_summary", twin("v_snapshot", """SELECT count(*) AS total_rows,
    count(CASE WHEN dbt_valid_to IS NULL THEN 1 END) AS current_rows,
    count(dbt_valid_to) AS historical_rows, count(DISTINCT order_id) AS unique_orders
FROM v_snapshot"""))
def q_snapshot_summary(spark, folder):
    return H.snapshot_summary(snapshots(spark, folder), "order_id")
