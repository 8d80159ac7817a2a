"""Filters, facets and top-k queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymart.functions import ratio
from quaymart.operators import marts as M
from quaymart.operators.filters import facets, top_k
from quaymart.plans.loading import partitioned_metrics
from quaymart.plans.marts import ltv, market, performance
from quaymart.plans.registry import query
from quaymart.plans.rentals import rentals
from quaymart.plans.twins import twin
from quaymart.session import stored

RATE_FLOOR = 990.0
FACET = {"rating": ["Brand#1", "Brand#5", "Brand#9", "Brand#13", "Brand#17"], "rate": 920.0,
         "search": "RING"}
LATE_MONTH = ("1997-03-01", "1997-04-01")
TOP_SEGMENT = "Gold"
TOP_STATE = "NATION_9"
ON_TIME_FLOOR, ON_TIME_PERCENT, REVENUE_FLOOR = 0.9, 76, 30_000_000


@query("top_priced", twin("r_film", f"""SELECT film_id, title, rating, rental_rate, rental_duration
FROM r_film WHERE rental_rate > {RATE_FLOOR}
ORDER BY rental_rate DESC NULLS FIRST, title ASC NULLS LAST, film_id LIMIT 10"""))
def q_top_priced(spark, folder):
    film = rentals(spark, folder).film.where(F.col("rental_rate") > RATE_FLOOR)
    return top_k(film.select("film_id", "title", "rating", "rental_rate", "rental_duration"), 10,
                 F.col("rental_rate").desc_nulls_first(), F.col("title").asc_nulls_last(),
                 "film_id")


@query("active_count", twin("r_customer",
                            "SELECT count(*) AS active_customers FROM r_customer WHERE active = 1"))
def q_active_count(spark, folder):
    return rentals(spark, folder).customer.where(F.col("active") == 1).agg(
        F.count(F.lit(1)).alias("active_customers"))


@query("faceted_filter", twin("r_film", f"""SELECT film_id, title, rating, rental_rate
FROM r_film WHERE rating IN ({', '.join(repr(v) for v in FACET['rating'])})
  AND rental_rate >= {FACET['rate']} AND lower(title) LIKE '%ring%'"""))
def q_faceted_filter(spark, folder):
    film = rentals(spark, folder).film.select("film_id", "title", "rating", "rental_rate")
    return facets(film, isin={"rating": FACET["rating"], "title": []},
                  at_least={"rental_rate": FACET["rate"]}, search={"title": FACET["search"]})


@query("like_filter", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red %'")
def q_like_filter(spark, folder):
    part = market(spark, folder).t.part
    return part.where(F.col("p_name").like("red %")).select("p_partkey", "p_name")


@query("late_in_month", twin("v_order_metrics", f"""
SELECT order_id, delivery_days, review_score FROM v_order_metrics
WHERE purchased_at >= DATE '{LATE_MONTH[0]}' AND purchased_at < DATE '{LATE_MONTH[1]}'
  AND is_late"""))
def q_late_in_month(spark, folder):
    month = F.lit(LATE_MONTH[0]).cast("date")
    late = partitioned_metrics(spark, folder).where((F.col("purchase_month") == month) & F.col("is_late"))
    return late.select("order_id", "delivery_days", "review_score").orderBy(
        F.col("delivery_days").desc_nulls_first(), "order_id")


@query("segment_top_spend", twin("v_ltv", f"""
SELECT customer_unique_id, total_spent, avg_review_score FROM v_ltv
WHERE value_segment = '{TOP_SEGMENT}'
ORDER BY total_spent DESC NULLS FIRST, customer_unique_id LIMIT 50"""))
def q_segment_top_spend(spark, folder):
    table = stored(spark, f"ltv {folder}", lambda: ltv(market(spark, folder)).select(
        "customer_unique_id", "total_spent", "avg_review_score", "value_segment"), ["value_segment"], ["total_spent"])
    gold = table.where(F.col("value_segment") == TOP_SEGMENT)
    return top_k(gold.select("customer_unique_id", "total_spent", "avg_review_score"), 50,
                 F.col("total_spent").desc_nulls_first(), "customer_unique_id")


@query("state_top_sellers", twin("v_performance", f"""
SELECT seller_id, seller_state, total_revenue FROM v_performance
WHERE seller_state = '{TOP_STATE}' ORDER BY total_revenue DESC NULLS FIRST, seller_id LIMIT 10"""))
def q_state_top_sellers(spark, folder):
    table = stored(spark, f"sellers {folder}", lambda: performance(market(spark, folder)).select(
        "seller_id", "seller_state", "total_revenue"), sort_by=["seller_state", "total_revenue"])
    here = table.where(F.col("seller_state") == TOP_STATE)
    return top_k(here.select("seller_id", "seller_state", "total_revenue"), 10,
                 F.col("total_revenue").desc_nulls_first(), "seller_id")


def _reliable(spark, folder, floor):
    m = market(spark, folder)
    return performance(m).where(
        (F.col("on_time_delivery_rate") >= floor) & (F.col("total_revenue") > REVENUE_FLOOR)
    ).select("seller_id", "total_revenue", "avg_review_score")


def _reliable_sql(floor):
    return twin("v_performance", f"""SELECT seller_id, total_revenue, avg_review_score
FROM v_performance WHERE on_time_delivery_rate >= {floor} AND total_revenue > {REVENUE_FLOOR}""")


@query("reliable_sellers", _reliable_sql(ON_TIME_FLOOR))
def q_reliable_sellers(spark, folder):
    """The share is 0..100, the floor is 0.9: kept as the query is written."""
    return _reliable(spark, folder, ON_TIME_FLOOR)


@query("reliable_sellers_percent", _reliable_sql(ON_TIME_PERCENT))
def q_reliable_sellers_percent(spark, folder):
    """The same with the floor in percent, the unit of the column."""
    return _reliable(spark, folder, ON_TIME_PERCENT)


@query("recent_n", """SELECT event_id, ts, user_id, event_type, value FROM events
ORDER BY ts DESC NULLS FIRST, event_id LIMIT 20""")
def q_recent_n(spark, folder):
    events = market(spark, folder).t.events.select("event_id", "ts", "user_id", "event_type",
                                                   "value")
    return top_k(events, 20, F.col("ts").desc_nulls_first(), "event_id")


@query("segment_counts", twin("v_ltv", """
SELECT value_segment, count(*) AS customer_count,
    round(CAST(sum(spent_cents) AS DOUBLE) / count(*)) / 1e2 AS avg_spend,
    CASE value_segment WHEN 'Bronze' THEN 1 WHEN 'Silver' THEN 2 WHEN 'Gold' THEN 3
      WHEN 'Platinum' THEN 4 END AS sort_key
FROM v_ltv WHERE value_segment IS NOT NULL GROUP BY 1"""))
def q_segment_counts(spark, folder):
    m = market(spark, folder)
    counts = ltv(m).where(F.col("value_segment").isNotNull()).groupBy("value_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum(M.to_cents("total_spent")).alias("cents"))
    rank = F.when(F.col("value_segment") == "Bronze", 1)
    for at, name in enumerate(("Silver", "Gold", "Platinum"), start=2):
        rank = rank.when(F.col("value_segment") == name, at)
    return counts.select("value_segment", "customer_count",
                         ratio("cents", "customer_count", 2, 2).alias("avg_spend"),
                         rank.alias("sort_key")).orderBy("sort_key")
