"""Shared text of the SQL twins: role views and rounding as DuckDB SQL.

The twins follow the plain relational definition of each query, with no
pre-aggregation, so they check the rewritten Spark plans independently.
"""

from __future__ import annotations

from quaymart.sources.roles import PROMISE_DAYS

_CTES = {
    "places": ("", """SELECT n_nationkey, n_name, r_name FROM nation
        JOIN region ON n_regionkey = r_regionkey"""),
    "lines": ("", """SELECT *, (CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)
        * (100 - CAST(floor(l_discount * 100 + 0.5) AS BIGINT)) + 50) // 100 AS cents,
        CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS price_cents FROM lineitem"""),
    "m_customers": ("places", """SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
        r_name AS customer_city, n_name AS customer_state,
        c_nationkey AS customer_zip_code_prefix
        FROM customer JOIN places ON c_nationkey = n_nationkey"""),
    "m_sellers": ("places", """SELECT s_suppkey AS seller_id, r_name AS seller_city,
        n_name AS seller_state FROM supplier JOIN places ON s_nationkey = n_nationkey"""),
    "shipped": ("", """SELECT l_orderkey, min(l_shipdate) AS carrier, max(l_shipdate) AS delivered
        FROM lineitem GROUP BY l_orderkey"""),
    "m_orders": ("shipped", f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
             WHEN 'P' THEN 'canceled' END AS order_status,
        o_orderdate AS purchased_at, o_orderdate AS approved_at, carrier AS shipped_at,
        delivered AS delivered_at,
        o_orderdate + INTERVAL {PROMISE_DAYS} DAY AS estimated_delivery_at
        FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey"""),
    "m_items": ("lines", """SELECT l_orderkey AS order_id, l_partkey AS product_id,
        l_suppkey AS seller_id, price_cents FROM lines"""),
    "m_payments": ("lines", """SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
        l_returnflag AS payment_type, cents FROM lines"""),
    "m_reviews": ("", """SELECT o_orderkey AS order_id,
        CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS review_score FROM orders"""),
    "m_products": ("", """SELECT p_partkey AS product_id, p_type AS product_category_name,
        p_size AS product_weight_g FROM part"""),
    "m_translation": ("", """SELECT DISTINCT p_type AS product_category_name,
        lower(p_type) AS product_category_name_english FROM part"""),
    "stg_orders": ("m_orders", """SELECT *, CAST(date_trunc('month', purchased_at) AS DATE)
        AS purchase_month,
        CASE WHEN order_status = 'delivered' AND delivered_at IS NOT NULL
              AND estimated_delivery_at IS NOT NULL
             THEN delivered_at > estimated_delivery_at END AS is_late,
        date_sub('day', purchased_at, delivered_at) AS delivery_days FROM m_orders"""),
    "stg_payments": ("m_payments", """SELECT order_id, sum(cents) AS total_payment_cents,
        count(*) AS payment_installments,
        string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_types
        FROM m_payments GROUP BY order_id"""),
    "stg_items": ("m_items", """SELECT order_id, count(*) AS product_count
        FROM m_items GROUP BY order_id"""),
    "r_customer": ("", """SELECT c_custkey AS customer_id, c_name AS first_name,
        c_mktsegment AS last_name, lower(c_name) AS email,
        CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS active FROM customer"""),
    "r_film": ("", """SELECT p_partkey AS film_id, p_name AS title, p_brand AS rating,
        p_type AS category, p_retailprice AS rental_rate, p_size AS rental_duration,
        CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS rate_cents FROM part"""),
    "r_rental": ("", """SELECT o_orderkey AS rental_id, o_custkey AS customer_id,
        o_orderdate AS rental_date FROM orders"""),
    "r_payment": ("lines", """SELECT l_orderkey AS rental_id, l_partkey AS film_id,
        l_shipdate AS payment_date, cents FROM lines"""),
    "r_item_rental": ("", """SELECT l_orderkey AS rental_id, l_linenumber AS line_no,
        o_custkey AS customer_id, l_partkey AS film_id, l_suppkey AS store_id,
        o_orderdate AS rental_date,
        CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS return_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "r_customer_payment": ("r_payment r_rental", """SELECT p.*, r.customer_id FROM r_payment p
        JOIN r_rental r ON p.rental_id = r.rental_id"""),
}


def add_view(name: str, needs: str, text: str) -> None:
    """A named view other twins may build on."""
    _CTES[name] = (needs, text)


def twin(needs: str, body: str, **views: str) -> str:
    """``WITH <role views> <extra views> body``; views are added with their needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in _CTES[name][0].split():
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    parts = [f"{n} AS ({_CTES[n][1]})" for n in order]
    parts += [f"{n} AS ({text})" for n, text in views.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def r_up(num: str, den: str, digits: int = 2, num_scale: int = 2) -> str:
    """SQL of ``functions.ratio``: num counts 10^-num_scale units."""
    factor = f"* 1e{digits - num_scale}" if digits >= num_scale else f"/ 1e{num_scale - digits}"
    return f"(round(CAST({num} AS DOUBLE) {factor} / nullif(CAST({den} AS DOUBLE), 0)) / 1e{digits})"


def r_even(num: str, den: str, digits: int = 2, num_scale: int = 2) -> str:
    """The same with halves to even (numpy rounding)."""
    factor = f"* 1e{digits - num_scale}" if digits >= num_scale else f"/ 1e{num_scale - digits}"
    return (f"(round_even(CAST({num} AS DOUBLE) {factor} / nullif(CAST({den} AS DOUBLE), 0), 0)"
            f" / 1e{digits})")


def p_up(part: str, total: str, digits: int = 2) -> str:
    return r_up(part, total, digits + 2, 0).replace(f"/ 1e{digits + 2})", f"/ 1e{digits})")


def p_even(part: str, total: str, digits: int = 2) -> str:
    return r_even(part, total, digits + 2, 0).replace(f"/ 1e{digits + 2})", f"/ 1e{digits})")


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 1e2)"
