"""Rental-domain joins and aggregates over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymart.operators import rentals as R
from quaymart.plans.registry import query
from quaymart.plans.twins import add_view, money, r_up, twin
from quaymart.sources import Rentals, Tables

TIER_CUTS = (925.0, 975.0)
SPEND_EDGES = (0, 1_500_000, 2_000_000, 2_500_000)
CLUSTER_WIDTH = 2500


def rentals(spark, folder) -> Rentals:
    return Rentals(Tables(spark, folder))


def clusters(r: Rentals):
    """Fixed labels: equal-width buckets of the account balance."""
    return r.t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(F.col("c_acctbal") / CLUSTER_WIDTH).alias("cluster"))


def films_with_category(r: Rentals):
    return (r.film.drop("category"), r.film.select("film_id", "category"))


def tiers(r: Rentals):
    return R.item_tier(*films_with_category(r), cuts=TIER_CUTS)


def summary(r: Rentals):
    latest = r.payment.agg(F.max("payment_date")).scalar()
    return R.customer_summary(r.customer, r.customer_payment, latest, SPEND_EDGES)


_TIER = f"""CASE WHEN rental_rate <= {TIER_CUTS[0]} THEN 'Budget'
    WHEN rental_rate <= {TIER_CUTS[1]} THEN 'Standard' ELSE 'Premium' END"""
add_view("v_tier", "r_film", f"SELECT * EXCLUDE (rate_cents), {_TIER} AS value_tier FROM r_film")
add_view("v_score", "r_film", """SELECT film_id, title, category, rating, rental_rate,
    rental_duration, rental_count,
    round_even((raw - min(raw) OVER ()) / nullif(max(raw) OVER () - min(raw) OVER (), 0) * 100
      * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS value_score
FROM (SELECT f.film_id, f.title, f.category, f.rating, f.rental_rate, f.rental_duration,
      count(l_partkey) AS rental_count,
      f.rental_rate / f.rental_duration * ln(1 + count(l_partkey)) AS raw
  FROM r_film f LEFT JOIN lineitem ON film_id = l_partkey GROUP BY 1, 2, 3, 4, 5, 6)""")
add_view("v_summary", "r_customer r_customer_payment", f"""
SELECT c.customer_id, c.first_name || ' ' || c.last_name AS full_name, c.email,
    CAST(c.active AS BOOLEAN) AS is_active,
    CASE WHEN coalesce(s.cents, 0) <= 0 THEN NULL
      WHEN s.cents <= {SPEND_EDGES[1]}00 THEN 'Bronze' WHEN s.cents <= {SPEND_EDGES[2]}00 THEN 'Silver'
      WHEN s.cents <= {SPEND_EDGES[3]}00 THEN 'Gold' ELSE 'Platinum' END AS segment,
    s.total_rentals, {money('s.cents')} AS total_spend, s.first_payment, s.last_payment,
    date_sub('day', s.last_payment, max(s.last_payment) OVER ()) AS days_since_last_payment
FROM r_customer c LEFT JOIN (SELECT customer_id, count(rental_id) AS total_rentals,
    sum(cents) AS cents, min(payment_date) AS first_payment, max(payment_date) AS last_payment
    FROM r_customer_payment GROUP BY 1) s ON c.customer_id = s.customer_id""")
add_view("v_lifetime", "r_customer r_rental r_payment", f"""
SELECT c.customer_id, c.first_name || ' ' || c.last_name AS full_name, c.email,
    count(r.rental_id) AS total_rentals, {money('sum(p.cents)')} AS total_spend,
    {r_up('sum(p.cents)', 'count(p.cents)')} AS avg_spend_per_rental,
    max(r.rental_date) AS last_rental_date, min(r.rental_date) AS first_rental_date
FROM r_customer c LEFT JOIN r_rental r ON c.customer_id = r.customer_id
LEFT JOIN r_payment p ON r.rental_id = p.rental_id GROUP BY ALL""")


@query("revenue_by_class", twin("r_film r_payment", f"""
SELECT f.rating, count(DISTINCT f.film_id) AS film_count, count(p.rental_id) AS total_rentals,
    {money('sum(p.cents)')} AS total_revenue, {r_up('sum(p.cents)', 'count(p.cents)')} AS avg_payment
FROM r_film f JOIN r_payment p ON f.film_id = p.film_id GROUP BY 1"""))
def q_revenue_by_class(spark, folder):
    r = rentals(spark, folder)
    return R.revenue_by_rating(r.film, r.payment)


@query("category_popularity", twin("r_film r_payment r_rental", f"""
SELECT f.category AS category_name, count(r.rental_id) AS total_rentals,
    {money('sum(p.cents)')} AS total_revenue,
    {r_up('sum(f.rate_cents)', 'count(f.rate_cents)', 4, 2)} AS avg_rental_rate,
    count(DISTINCT f.film_id) AS film_count
FROM r_film f JOIN r_payment p ON f.film_id = p.film_id
JOIN r_rental r ON p.rental_id = r.rental_id
GROUP BY 1 ORDER BY total_rentals DESC, category_name LIMIT 10"""))
def q_category_popularity(spark, folder):
    r = rentals(spark, folder)
    return R.category_popularity(r.film, r.payment)


@query("top_customers", twin("r_customer r_rental r_payment", f"""
SELECT c.customer_id, concat(c.first_name, ' ', c.last_name) AS full_name, c.email,
    {money('sum(p.cents)')} AS total_spend, count(r.rental_id) AS rental_count,
    {r_up('sum(p.cents)', 'count(p.cents)')} AS avg_spend_per_rental
FROM r_customer c JOIN r_rental r ON c.customer_id = r.customer_id
JOIN r_payment p ON r.rental_id = p.rental_id
GROUP BY ALL ORDER BY total_spend DESC NULLS FIRST, c.customer_id LIMIT 10"""))
def q_top_customers(spark, folder):
    r = rentals(spark, folder)
    return R.top_customers(r.customer, r.rental, r.payment)


def _overdue_sql(where: str) -> str:
    over = "epoch_us(return_date) - epoch_us(due_date)"
    return twin("r_item_rental r_customer r_film", f"""
SELECT rental_id, customer_name, film_title, rental_date, due_date, return_date, days_overdue
FROM (SELECT *, {r_up(over, '86400000000', 2, 0)} AS days_overdue
  FROM (SELECT r.rental_id, r.line_no, r.film_id, r.store_id,
      concat(c.first_name, ' ', c.last_name) AS customer_name, f.title AS film_title,
      r.rental_date, r.rental_date + to_days(f.rental_duration) AS due_date, r.return_date
    FROM r_item_rental r JOIN r_customer c ON c.customer_id = r.customer_id
    JOIN r_film f ON r.film_id = f.film_id WHERE r.return_date IS NOT NULL) {where})
ORDER BY days_overdue DESC NULLS FIRST, rental_id, line_no, film_id, store_id LIMIT 20""")


@query("overdue_items", _overdue_sql(""))
def q_overdue_items(spark, folder):
    r = rentals(spark, folder)
    return R.overdue(r.item_rental, r.customer, r.film)


@query("overdue_items_late_only", _overdue_sql("WHERE return_date > due_date"))
def q_overdue_items_late_only(spark, folder):
    r = rentals(spark, folder)
    return R.overdue(r.item_rental, r.customer, r.film, late_only=True)


@query("customer_lifetime", twin("v_lifetime", "SELECT * FROM v_lifetime"))
def q_customer_lifetime(spark, folder):
    r = rentals(spark, folder)
    return R.customer_lifetime(r.customer, r.rental, r.payment)


@query("customer_summary", twin("v_summary", "SELECT * FROM v_summary"))
def q_customer_summary(spark, folder):
    return summary(rentals(spark, folder))


@query("film_value_score", twin("v_score", "SELECT * FROM v_score"))
def q_film_value_score(spark, folder):
    r = rentals(spark, folder)
    return R.film_value_score(r.film, r.payment)


@query("item_tier", twin("v_tier", "SELECT * FROM v_tier"))
def q_item_tier(spark, folder):
    return tiers(rentals(spark, folder))


@query("top_by_count", twin("r_customer r_rental", """
SELECT c.customer_id, c.first_name || ' ' || c.last_name AS full_name,
    count(r.rental_id) AS rental_count
FROM r_customer c JOIN r_rental r ON c.customer_id = r.customer_id
GROUP BY ALL ORDER BY rental_count DESC, c.customer_id LIMIT 10"""))
def q_top_by_count(spark, folder):
    r = rentals(spark, folder)
    return R.top_by_count(r.customer, r.rental)


@query("cluster_spend", twin("r_rental r_payment", f"""
SELECT c.cluster, count(*) AS customer_count, {r_up('sum(s.cents)', 'count(s.cents)')} AS avg_spend,
    {r_up('sum(s.rentals)', 'count(*)', 2, 0)} AS avg_rentals
FROM (SELECT c_custkey AS customer_id,
        CAST(floor(c_acctbal / {CLUSTER_WIDTH}) AS BIGINT) AS cluster FROM customer) c
JOIN (SELECT r.customer_id, count(*) AS rentals, sum(p.cents) AS cents
      FROM r_rental r LEFT JOIN r_payment p ON r.rental_id = p.rental_id GROUP BY 1) s
  ON c.customer_id = s.customer_id GROUP BY 1"""))
def q_cluster_spend(spark, folder):
    r = rentals(spark, folder)
    return R.cluster_spend(clusters(r), R.customer_totals(r.rental, r.payment))


@query("item_tier_score", twin("v_tier v_score", """
SELECT t.film_id, t.title, t.rating, t.category, t.rental_rate, t.rental_duration, t.value_tier,
    s.rental_count, s.value_score FROM v_tier t JOIN v_score s ON t.film_id = s.film_id"""))
def q_item_tier_score(spark, folder):
    r = rentals(spark, folder)
    scores = R.film_value_score(r.film, r.payment).select("film_id", "rental_count", "value_score")
    return tiers(r).join(scores, "film_id")
