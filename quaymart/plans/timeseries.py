"""Monthly, weekly and quarterly queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymart.operators import timeseries as S
from quaymart.plans.marts import market, months
from quaymart.plans.registry import query
from quaymart.plans.rentals import rentals
from quaymart.plans.twins import add_view, money, p_even, p_up, r_even, r_up, twin

GAP_MONTHS = ("1997-01-01", "2001-12-01")
LOW_ORDERS = 185

add_view("v_pay_months", "r_payment", """SELECT CAST(date_trunc('month', payment_date) AS DATE)
    AS month, sum(cents) AS cents, count(*) AS payment_count FROM r_payment GROUP BY 1""")
add_view("v_filled", "v_pay_months", f"""SELECT last_day(e.month) AS payment_date,
    coalesce(p.cents, 0) AS cents, coalesce(p.payment_count, 0) AS payment_count,
    {r_even('p.cents', 'p.payment_count', 4)} AS avg_payment
FROM (SELECT CAST(unnest(generate_series((SELECT min(month) FROM v_pay_months),
      (SELECT max(month) FROM v_pay_months), INTERVAL 1 MONTH)) AS DATE) AS month) e
LEFT JOIN v_pay_months p ON e.month = p.month""")


@query("monthly_trend", twin("r_rental r_payment", f"""
SELECT CAST(date_trunc('month', r.rental_date) AS DATE) AS rental_month,
    count(r.rental_id) AS rentals, count(DISTINCT r.customer_id) AS unique_customers,
    {money('sum(p.cents)')} AS monthly_revenue
FROM r_rental r JOIN r_payment p ON r.rental_id = p.rental_id GROUP BY 1"""))
def q_monthly_trend(spark, folder):
    r = rentals(spark, folder)
    return S.monthly_trend(r.rental, r.payment)


@query("monthly_growth", twin("v_pay_months", f"""
SELECT strftime(month, '%Y-%m') AS month, {money('cents')} AS total_revenue, payment_count,
    {r_even('cents', 'payment_count')} AS avg_payment,
    {p_even('(cents - prev)', 'prev')} AS mom_growth_pct
FROM (SELECT *, lag(cents) OVER (ORDER BY month) AS prev FROM v_pay_months)"""))
def q_monthly_growth(spark, folder):
    return S.monthly_growth(rentals(spark, folder).payment)


@query("monthly_filled", twin("v_filled", f"""SELECT payment_date, payment_count, avg_payment,
    {money('cents')} AS total_revenue FROM v_filled"""))
def q_monthly_filled(spark, folder):
    return S.fill_months(rentals(spark, folder).payment)


@query("growth_and_peak", twin("v_filled", f"""
SELECT payment_date, {money('cents')} AS total_revenue, payment_count, avg_payment,
    {p_even('(cents - prev)', 'prev')} AS mom_growth_pct, {money('prev')} AS prev_month_revenue,
    {r_even('(cents * k - s)', 'k')} AS revenue_vs_avg, cents = top AS is_peak_month
FROM (SELECT *, lag(cents) OVER (ORDER BY payment_date) AS prev, sum(cents) OVER () AS s,
      count(*) OVER () AS k, max(cents) OVER () AS top FROM v_filled)"""))
def q_growth_and_peak(spark, folder):
    return S.growth_and_peak(S.fill_months(rentals(spark, folder).payment))


@query("weekly_activity", twin("r_item_rental", """
SELECT CAST(date_trunc('week', rental_date) AS DATE) AS week_start, count(*) AS rental_count,
    count(CASE WHEN return_date IS NULL THEN 1 END) AS still_open,
    (SELECT count(DISTINCT customer_id) FROM r_item_rental) AS unique_customers
FROM r_item_rental GROUP BY 1"""))
def q_weekly_activity(spark, folder):
    return S.weekly_activity(rentals(spark, folder).item_rental)


@query("weekly_peak", twin("r_rental", f"""
SELECT week_start, rental_count, {r_up('sum(rental_count) OVER ()', 'count(*) OVER ()', 2, 0)}
      AS mean_rentals,
    row_number() OVER (ORDER BY rental_count DESC, week_start) = 1 AS is_peak
FROM (SELECT CAST(date_trunc('week', rental_date) AS DATE) AS week_start,
      count(*) AS rental_count FROM r_rental GROUP BY 1)"""))
def q_weekly_peak(spark, folder):
    return S.weekly_peak(rentals(spark, folder).rental)


@query("monthly_gaps", twin("v_months", f"""
SELECT e.month AS expected_month, m.total_revenue, m.total_orders,
    CASE WHEN m.order_month IS NULL THEN 'MISSING' WHEN m.total_orders < {LOW_ORDERS}
      THEN 'LOW VOLUME' ELSE 'NORMAL' END AS status
FROM (WITH RECURSIVE s AS (SELECT DATE '{GAP_MONTHS[0]}' AS month UNION ALL
        SELECT CAST(month + INTERVAL 1 MONTH AS DATE) FROM s WHERE month < DATE '{GAP_MONTHS[1]}')
      SELECT month FROM s) e LEFT JOIN v_months m ON e.month = m.order_month"""))
def q_monthly_gaps(spark, folder):
    m = market(spark, folder)
    return S.month_gaps(S.month_range(spark, *GAP_MONTHS), months(m), LOW_ORDERS)


@query("running_revenue", twin("v_months", f"""
SELECT order_month, total_revenue, {money('sum(c) OVER up')} AS cumulative_revenue,
    {r_up('sum(c) OVER near', 'count(c) OVER near')} AS rolling_3mo_avg
FROM (SELECT *, CAST(round(total_revenue * 100) AS BIGINT) AS c FROM v_months)
WINDOW up AS (ORDER BY order_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    near AS (ORDER BY order_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def q_running_revenue(spark, folder):
    return S.running_revenue(months(market(spark, folder)))


@query("revenue_mom", twin("v_months", f"""
SELECT order_month, {money('c')} AS revenue, {money('prev')} AS prev_month_revenue,
    {money('(c - prev)')} AS revenue_delta, {p_up('(c - prev)', 'prev', 1)} AS mom_growth_pct,
    CASE WHEN c > prev THEN 'Growth' WHEN c < prev THEN 'Decline' ELSE 'Flat' END AS trend
FROM (SELECT order_month, c, lag(c) OVER (ORDER BY order_month) AS prev FROM
  (SELECT *, CAST(round(total_revenue * 100) AS BIGINT) AS c FROM v_months))"""))
def q_revenue_mom(spark, folder):
    return S.revenue_mom(months(market(spark, folder)))


@query("order_volume_trend", twin("v_months", """
SELECT order_month, total_orders, total_revenue,
    round_even(m * 1e6, 0) / 1e6 AS moving_avg_3mo, next_month_orders,
    round_even((total_orders - m) * 1e6, 0) / 1e6 AS orders_vs_moving_avg
FROM (SELECT *, avg(total_orders) OVER (ORDER BY order_month
        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS m,
      lead(total_orders, 1) OVER (ORDER BY order_month) AS next_month_orders FROM v_months)"""))
def q_order_volume_trend(spark, folder):
    return S.order_volume_trend(months(market(spark, folder)))


@query("union_literals", """SELECT id, count(*) AS n FROM (
  SELECT c_nationkey AS id FROM customer UNION ALL SELECT NULL AS id FROM supplier)
WHERE id = 1 GROUP BY id""")
def q_union_literals(spark, folder):
    """Union of keys and rows of NULL literals; the filter drops the NULLs."""
    t = market(spark, folder).t
    keys = t.customer.select(F.col("c_nationkey").alias("id"))
    blanks = t.supplier.select(F.lit(None).cast("int").alias("id"))
    return keys.unionByName(blanks).where(F.col("id") == 1).groupBy("id").agg(
        F.count(F.lit(1)).alias("n"))
