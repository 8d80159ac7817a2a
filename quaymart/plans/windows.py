"""Window queries over the driver tables."""

from __future__ import annotations

from quaymart.operators import marts as M
from quaymart.operators import windows as W
from quaymart.plans.marts import ltv, market, performance
from quaymart.plans.registry import query
from quaymart.plans.rentals import rentals
from quaymart.plans.twins import money, p_even, p_up, r_even, r_up, twin
from quaymart.session import stage


@query("top3_per_state", twin("v_performance", """
SELECT seller_state, seller_id, total_revenue, avg_review, state_rank FROM (
  SELECT seller_state, seller_id, total_revenue, avg_review_score AS avg_review,
    rank() OVER (PARTITION BY seller_state ORDER BY total_revenue DESC NULLS FIRST) AS state_rank
  FROM v_performance WHERE total_revenue > 0) WHERE state_rank <= 3"""))
def q_top3_per_state(spark, folder):
    return W.top_per_state(performance(market(spark, folder)))


@query("spend_percentile", twin("v_ltv", f"""
SELECT customer_unique_id, value_segment, total_spent, avg_order_value,
    ntile(100) OVER (ORDER BY total_spent ASC NULLS LAST, customer_unique_id) AS spend_percentile,
    {p_up('(rank() OVER (ORDER BY total_spent ASC NULLS LAST) - 1)', '(count(*) OVER () - 1)', 1)}
      AS percent_rank,
    rank() OVER (ORDER BY total_spent DESC NULLS FIRST) AS overall_rank
FROM v_ltv ORDER BY total_spent DESC NULLS FIRST, customer_unique_id DESC LIMIT 100"""))
def q_spend_percentile(spark, folder):
    return W.spend_percentile(ltv(market(spark, folder)))


@query("category_revenue_share", twin("v_products", f"""
SELECT product_category_name_english, total_revenue,
    {p_up('c', 'sum(c) OVER ()', 1)} AS revenue_share_pct,
    {money('sum(c) OVER (ORDER BY c DESC NULLS FIRST)')} AS cumulative_revenue,
    {p_up('sum(c) OVER (ORDER BY c DESC NULLS FIRST)', 'sum(c) OVER ()', 1)}
      AS cumulative_share_pct,
    rank() OVER (ORDER BY c DESC NULLS FIRST) AS revenue_rank
FROM (SELECT *, CAST(round(total_revenue * 100) AS BIGINT) AS c FROM v_products)"""))
def q_category_revenue_share(spark, folder):
    m = market(spark, folder)
    return W.category_revenue_share(
        M.category_revenue(m.products, m.category_translation, m.order_items))


@query("seller_quartiles", twin("v_performance", """
SELECT *, revenue_quartile + rating_quartile + ontime_quartile AS overall_score FROM (
  SELECT seller_id, seller_state, total_revenue, avg_review_score, on_time_delivery_rate,
    ntile(4) OVER (ORDER BY total_revenue DESC NULLS FIRST, seller_id) AS revenue_quartile,
    ntile(4) OVER (ORDER BY avg_review_score DESC NULLS FIRST, seller_id) AS rating_quartile,
    ntile(4) OVER (ORDER BY on_time_delivery_rate DESC NULLS FIRST, seller_id) AS ontime_quartile
  FROM v_performance) WHERE total_revenue > 0"""))
def q_seller_quartiles(spark, folder):
    return W.seller_quartiles(performance(market(spark, folder)))


@query("customer_cohort", twin("m_customers m_orders m_payments", f"""
SELECT cohort_month, count(*) AS cohort_size, {r_up('sum(cents)', 'count(cents)')} AS avg_ltv,
    CAST(sum(count(*)) OVER (ORDER BY cohort_month) AS BIGINT) AS cumulative_customers,
    round(avg(avg(CAST(cents AS DOUBLE))) OVER (ORDER BY cohort_month
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) / 1e2 AS rolling_avg_ltv
FROM (SELECT c.customer_unique_id,
      CAST(date_trunc('month', min(o.purchased_at)) AS DATE) AS cohort_month,
      sum(p.cents) AS cents
  FROM m_customers c JOIN m_orders o ON c.customer_id = o.customer_id
  JOIN m_payments p ON o.order_id = p.order_id WHERE o.order_status = 'delivered' GROUP BY 1)
GROUP BY cohort_month"""))
def q_customer_cohort(spark, folder):
    m = market(spark, folder)
    return W.customer_cohort(m.order_facts(), m.customers)


@query("top_category_quarterly", twin("v_products m_items m_orders m_products m_translation", f"""
SELECT category, quarter, {money('cents')} AS quarterly_revenue,
    {money('prev')} AS prev_quarter_revenue, {money('(cents - prev)')} AS qoq_change
FROM (SELECT *, lag(cents) OVER (PARTITION BY category ORDER BY quarter) AS prev FROM (
  SELECT t.product_category_name_english AS category,
    CAST(date_trunc('quarter', o.purchased_at) AS DATE) AS quarter, sum(i.price_cents) AS cents
  FROM m_items i JOIN m_orders o ON i.order_id = o.order_id
  JOIN m_products p ON i.product_id = p.product_id
  JOIN m_translation t ON p.product_category_name = t.product_category_name
  WHERE t.product_category_name_english IN (SELECT product_category_name_english FROM v_products
      ORDER BY total_revenue DESC, product_category_name_english LIMIT 5)
    AND o.order_status = 'delivered' GROUP BY 1, 2))"""))
def q_top_category_quarterly(spark, folder):
    m = market(spark, folder)
    return W.category_quarters(m.products, m.category_translation, m.order_items,
                               m.orders_undated)


@query("above_group_avg", twin("v_performance", f"""
SELECT s.seller_id, s.seller_state, s.total_revenue AS seller_revenue, a.state_avg_revenue,
    {money('(s.c - a.c)')} AS revenue_above_avg, {p_up('(s.c - a.c)', 'a.c', 1)} AS pct_above_avg,
    a.sellers_in_state
FROM (SELECT *, CAST(round(total_revenue * 100) AS BIGINT) AS c FROM v_performance) s
JOIN (SELECT *, CAST(round(state_avg_revenue * 100) AS BIGINT) AS c FROM (
    SELECT seller_state, {r_up('sum(CAST(round(total_revenue * 100) AS BIGINT))',
                               'count(total_revenue)')} AS state_avg_revenue,
      count(*) AS sellers_in_state FROM v_performance GROUP BY 1)) a
  ON s.seller_state = a.seller_state
WHERE s.c > a.c ORDER BY pct_above_avg DESC NULLS FIRST, s.seller_id LIMIT 50"""))
def q_above_group_avg(spark, folder):
    m = market(spark, folder)
    return W.above_group_avg(stage(M.seller_revenue(m.sellers, m.order_items)))


@query("review_improvement", twin("m_customers m_orders m_reviews", """
SELECT a.customer_unique_id, CAST(a.review_score AS BIGINT) AS first_review,
    CAST(b.review_score AS BIGINT) AS last_review,
    CAST(b.review_score - a.review_score AS BIGINT) AS improvement
FROM cr a JOIN cr b ON a.customer_unique_id = b.customer_unique_id
  AND a.seq_asc = 1 AND b.seq_desc = 1 AND a.order_id <> b.order_id
WHERE b.review_score > a.review_score""", cr="""
SELECT c.customer_unique_id, o.order_id, r.review_score,
    row_number() OVER (PARTITION BY c.customer_unique_id
      ORDER BY o.purchased_at, o.order_id) AS seq_asc,
    row_number() OVER (PARTITION BY c.customer_unique_id
      ORDER BY o.purchased_at DESC, o.order_id DESC) AS seq_desc
FROM m_customers c JOIN m_orders o ON c.customer_id = o.customer_id
JOIN m_reviews r ON o.order_id = r.order_id
WHERE r.review_score IS NOT NULL AND o.order_status = 'delivered'"""))
def q_review_improvement(spark, folder):
    m = market(spark, folder)
    return W.review_improvement(m.orders_undated, m.order_reviews, m.customers)


@query("group_stats_rows", twin("r_customer_payment", f"""
SELECT customer_id, rental_id, payment_date, {money('cents')} AS amount,
    {money('s')} AS customer_total_spend, {r_even('s', 'n', 4)} AS customer_avg_payment,
    n AS customer_payment_count,
    CAST(CASE WHEN {money('cents')} > {r_even('s', 'n', 4)} THEN 1 ELSE 0 END AS BIGINT)
      AS above_avg_flag,
    {p_even('cents', 's')} AS pct_of_customer_total
FROM (SELECT *, sum(cents) OVER (PARTITION BY customer_id) AS s,
      count(*) OVER (PARTITION BY customer_id) AS n FROM r_customer_payment)"""))
def q_group_stats_rows(spark, folder):
    return W.group_stats_rows(rentals(spark, folder).customer_payment)


@query("rolling_by_customer", twin("r_customer_payment", f"""
SELECT customer_id, rental_id, film_id, payment_date, {money('cents')} AS amount,
    {r_even('sum(cents) OVER near', 'count(cents) OVER near', 4)} AS rolling_3_avg,
    {money('sum(cents) OVER up')} AS cumulative_spend,
    {money('max(cents) OVER up')} AS running_max_payment
FROM r_customer_payment
WINDOW up AS (PARTITION BY customer_id ORDER BY payment_date, rental_id, film_id, cents
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  near AS (PARTITION BY customer_id ORDER BY payment_date, rental_id, film_id, cents
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def q_rolling_by_customer(spark, folder):
    return W.rolling_by_customer(rentals(spark, folder).customer_payment)


@query("payment_ranks", twin("r_customer_payment", f"""
SELECT p.customer_id, p.rental_id, p.payment_date, {money('p.cents')} AS amount,
    dense_rank() OVER (PARTITION BY p.customer_id ORDER BY p.cents DESC)
      AS payment_rank_within_customer, t.spend_rank
FROM r_customer_payment p LEFT JOIN (SELECT customer_id,
    dense_rank() OVER (ORDER BY sum(cents) DESC) AS spend_rank
    FROM r_customer_payment GROUP BY customer_id) t ON p.customer_id = t.customer_id"""))
def q_payment_ranks(spark, folder):
    return W.payment_ranks(rentals(spark, folder).customer_payment)


@query("top_spenders", twin("r_customer_payment r_customer", f"""
SELECT t.spend_rank, t.customer_id, c.first_name || ' ' || c.last_name AS customer_name,
    {money('t.cents')} AS total_spend
FROM (SELECT customer_id, sum(cents) AS cents,
      dense_rank() OVER (ORDER BY sum(cents) DESC) AS spend_rank
    FROM r_customer_payment GROUP BY customer_id) t JOIN r_customer c
  ON t.customer_id = c.customer_id
WHERE spend_rank <= 5 ORDER BY spend_rank, t.customer_id LIMIT 5"""))
def q_top_spenders(spark, folder):
    r = rentals(spark, folder)
    return W.top_spenders(r.customer_payment, r.customer)
