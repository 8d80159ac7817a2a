"""Aggregate queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymart.functions import rint_to
from quaymart.operators import aggregate as A
from quaymart.operators import marts as M
from quaymart.operators.quantiles import exact_median, exact_quantiles, histogram
from quaymart.plans.marts import LTV_CUTS, MONTHS_FROM, last_purchase, ltv, market, performance
from quaymart.plans.registry import query
from quaymart.plans.rentals import rentals, summary, tiers
from quaymart.plans.twins import money, p_even, p_up, r_even, r_up, twin
from quaymart.session import stage

# The event types of the driver's events table.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
HIGH_VALUE = 200
BINS = 30
MIN_RENTALS, MIN_CUSTOMERS = 15_000, 500


@query("tier_analysis", twin("v_tier", f"""
SELECT value_tier, n AS film_count, {r_even('s', 'n', 4)} AS avg_rental_rate,
    {r_even('s', 'n', 2)} AS avg_replacement_cost, {p_even('n', 'sum(n) OVER ()')} AS pct_of_total
FROM (SELECT value_tier, count(*) AS n,
      sum(CAST(round(rental_rate * 100) AS BIGINT)) AS s FROM v_tier GROUP BY 1)"""))
def q_tier_analysis(spark, folder):
    films = tiers(rentals(spark, folder)).withColumn("replacement_cost", F.col("rental_rate"))
    return A.tier_summary(films)


@query("tier_rates", twin("v_tier", f"""
SELECT value_tier, count(*) AS film_count,
    {r_up('sum(CAST(round(rental_rate * 100) AS BIGINT))', 'count(*)')} AS avg_rate
FROM v_tier WHERE value_tier IS NOT NULL GROUP BY 1"""))
def q_tier_rates(spark, folder):
    return A.tier_rates(tiers(rentals(spark, folder)))


@query("category_rollup", twin("v_score", f"""
SELECT category, count(*) AS film_count,
    {r_up('sum(CAST(round(rental_rate * 100) AS BIGINT))', 'count(*)')} AS avg_rate,
    {money('sum(CAST(round(rental_rate * 100) AS BIGINT))')} AS rate_sum,
    CAST(sum(rental_count) AS BIGINT) AS total_rentals FROM v_score GROUP BY 1"""))
def q_category_rollup(spark, folder):
    r = rentals(spark, folder)
    counts = r.payment.groupBy("film_id").agg(F.count(F.lit(1)).alias("rental_count"))
    films = r.film.join(counts, "film_id", "left").withColumn(
        "rental_count", F.coalesce("rental_count", F.lit(0)))
    return A.category_rollup(films)


@query("status_pivot", "SELECT user_id, " + ", ".join(
    f"count(CASE WHEN event_type = '{v}' THEN 1 END) AS \"{v}\"" for v in EVENT_TYPES)
    + ", count(CASE WHEN event_type IN (" + ", ".join(f"'{v}'" for v in EVENT_TYPES)
    + ") THEN NULL ELSE 1 END) AS other FROM events GROUP BY user_id")
def q_status_pivot(spark, folder):
    return A.status_pivot(market(spark, folder).t.events, "user_id", "event_type", EVENT_TYPES)


@query("run_summary", f"""
SELECT *, coalesce({p_up('successful', 'total_runs')}, 0) AS success_rate FROM (
  SELECT count(*) AS total_runs, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS successful,
    count(CASE WHEN event_type = 'error' THEN 1 END) AS failed,
    {money('sum(CAST(floor(value * 100 + 0.5) AS BIGINT))')} AS total_value,
    max(ts) AS latest_run FROM events)""")
def q_run_summary(spark, folder):
    return A.run_summary(market(spark, folder).t.events, "event_type", "purchase", "error",
                         "value", "ts")


@query("kpi_row", twin("v_ltv v_order_metrics v_months", f"""
SELECT l.*, o.*, m.* FROM
  (SELECT count(*) AS total_customers, {r_up('sum(spent_cents)', 'count(*)')} AS avg_ltv,
     count(CASE WHEN is_churned = 0 THEN 1 END) AS repeat_customers FROM v_ltv) l,
  (SELECT count(*) AS total_orders, {r_up('sum(CAST(review_score AS BIGINT))', 'count(*)', 2, 0)}
     AS avg_review_score,
     {p_up('count(CASE WHEN is_late THEN 1 END)', 'count(*)')} AS late_delivery_rate
   FROM v_order_metrics) o,
  (SELECT CAST(sum(total_orders) AS BIGINT) AS orders_count,
     {money('sum(CAST(round(total_revenue * 100) AS BIGINT))')} AS total_revenue FROM v_months) m"""))
def q_kpi_row(spark, folder):
    """The per-order facts feed all three marts, so they are staged once."""
    m = market(spark, folder)
    facts = stage(m.order_facts())
    return A.kpi_row(M.customer_ltv(facts, m.customers, last_purchase(m), LTV_CUTS),
                     M.order_metrics(facts, m.customers),
                     M.monthly_revenue(facts, F.lit(MONTHS_FROM).cast("timestamp_ntz")))


@query("repeat_rate", twin("v_ltv", f"""
SELECT count(*) AS total_customers,
    {p_up('count(CASE WHEN total_orders > 1 THEN 1 END)', 'count(*)')} AS repeat_rate,
    {r_up('sum(spent_cents)', 'count(*)')} AS avg_ltv,
    {r_up('sum(CAST(round(avg_review_score * 100) AS BIGINT))', 'count(avg_review_score)')}
      AS avg_review FROM v_ltv"""))
def q_repeat_rate(spark, folder):
    return A.repeat_rate(ltv(market(spark, folder)))


@query("high_value_churned", twin("v_ltv", f"""
SELECT customer_unique_id, total_orders, total_spent, value_segment, days_since_last_order
FROM v_ltv WHERE is_churned = 1 AND total_spent > {HIGH_VALUE}"""))
def q_high_value_churned(spark, folder):
    return ltv(market(spark, folder)).where(
        (F.col("is_churned") == 1) & (F.col("total_spent") > HIGH_VALUE)).select(
        "customer_unique_id", "total_orders", "total_spent", "value_segment",
        "days_since_last_order")


@query("late_review_gap", twin("v_order_metrics", f"""
SELECT count(*) AS total_orders,
    {p_up('count(CASE WHEN is_late THEN 1 END)', 'count(*)')} AS late_rate,
    {r_up('sum(delivery_days)', 'count(delivery_days)', 2, 0)} AS avg_delivery_days,
    {r_up('sum(CASE WHEN is_late THEN CAST(review_score AS BIGINT) END)',
          'count(CASE WHEN is_late THEN review_score END)', 2, 0)} AS late_avg_review,
    {r_up('sum(CASE WHEN NOT is_late THEN CAST(review_score AS BIGINT) END)',
          'count(CASE WHEN NOT is_late THEN review_score END)', 2, 0)} AS on_time_avg_review
FROM v_order_metrics"""))
def q_late_review_gap(spark, folder):
    m = market(spark, folder)
    return A.late_review_gap(M.order_metrics(m.order_facts(), m.customers))


@query("ontime_by_state", twin("v_performance", f"""
SELECT seller_state, {r_up('sum(CAST(round(on_time_delivery_rate * 100) AS BIGINT))',
                           'count(*)', 4)} AS on_time_delivery_rate
FROM v_performance GROUP BY 1"""))
def q_ontime_by_state(spark, folder):
    return A.ontime_by_state(performance(market(spark, folder)))


@query("spend_histogram", twin("v_ltv", f"""
SELECT b.bin, lo + b.bin * w AS lower, lo + (b.bin + 1) * w AS upper,
    coalesce(h.n, 0) AS n, mean_spend, median_spend
FROM (SELECT unnest(range({BINS})) AS bin) b,
  (SELECT min(total_spent) AS lo, (max(total_spent) - min(total_spent)) / {BINS}.0::DOUBLE AS w,
     {r_up('sum(spent_cents)', 'count(*)')} AS mean_spend,
     round_even(quantile_cont(total_spent, 0.5) * 1e4, 0) / 1e4 AS median_spend FROM v_ltv) s
LEFT JOIN (SELECT least(CAST(floor((total_spent - lo) / w) AS BIGINT), {BINS - 1}) AS bin,
    count(*) AS n FROM v_ltv, (SELECT min(total_spent) AS lo,
      (max(total_spent) - min(total_spent)) / {BINS}.0::DOUBLE AS w FROM v_ltv) GROUP BY 1) h
  ON b.bin = h.bin"""))
def q_spend_histogram(spark, folder):
    """Bins with the mean and the exact median; the mart is staged for the passes."""
    spend = stage(ltv(market(spark, folder)).select("total_spent"))
    mean = spend.agg(A.ratio(F.sum(A.to_cents("total_spent")), F.count("total_spent"), 2, 2)).scalar()
    return histogram(spend, "total_spent", BINS).withColumns({
        "mean_spend": mean, "median_spend": rint_to(exact_median(spend, "total_spent"), 4)})


def _box(df, value, by):
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], [by])
    ends = df.where(F.col(value).isNotNull()).groupBy(by).agg(
        F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))
    return q.join(ends, by).select(by, "n", "low", *[
        rint_to(F.col(f"q{i}"), 4).alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "high")


def _box_sql(value, by, table):
    qs = ", ".join(f"round_even(quantile_cont({value}, {p}) * 1e4, 0) / 1e4 AS q{int(p * 100)}"
                   for p in (0.25, 0.5, 0.75))
    return (f"SELECT {by}, count({value}) AS n, CAST(min({value}) AS DOUBLE) AS low, {qs}, "
            f"CAST(max({value}) AS DOUBLE) AS high FROM {table} GROUP BY {by}")


@query("box_stats", twin("r_film", _box_sql("rental_rate", "rating", "r_film")))
def q_box_stats(spark, folder):
    return _box(rentals(spark, folder).film, "rental_rate", "rating")


@query("line_price_box", _box_sql("l_extendedprice", "l_returnflag", "lineitem"))
def q_line_price_box(spark, folder):
    """Quartiles of very large groups (three flags over all lines)."""
    return _box(market(spark, folder).t.lineitem, "l_extendedprice", "l_returnflag")


@query("late_review_box", twin("v_order_metrics", _box_sql(
    "CAST(review_score AS DOUBLE)", "is_late", "v_order_metrics")))
def q_late_review_box(spark, folder):
    m = market(spark, folder)
    orders = stage(M.order_metrics(m.order_facts(), m.customers).select("is_late", "review_score"))
    return _box(orders, "review_score", "is_late")


@query("rental_stats", twin("r_item_rental", f"""
SELECT *, CASE WHEN total_rentals >= {MIN_RENTALS} AND unique_customers >= {MIN_CUSTOMERS}
    THEN 'validation_passed' ELSE 'validation_failed' END AS verdict
FROM (SELECT count(*) AS total_rentals, count(CASE WHEN return_date IS NULL THEN 1 END)
      AS open_rentals, count(return_date) AS returned_rentals,
      count(DISTINCT customer_id) AS unique_customers FROM r_item_rental)"""))
def q_rental_stats(spark, folder):
    return A.rental_stats(rentals(spark, folder).item_rental, MIN_RENTALS, MIN_CUSTOMERS)


@query("segment_value_counts", twin("v_summary",
                                    "SELECT segment, count(*) AS n FROM v_summary GROUP BY 1"))
def q_segment_value_counts(spark, folder):
    return A.value_counts(summary(rentals(spark, folder)), "segment")


@query("spend_trend", twin("v_summary", """
SELECT segment, count(*) AS n,
    round_even(regr_slope(total_rentals, total_spend / 1e6) * 1e6, 0) / 1e6 AS slope,
    round_even(regr_intercept(total_rentals, total_spend / 1e6) * 1e6, 0) / 1e6 AS intercept,
    round_even(corr(total_spend / 1e6, total_rentals) * 1e6, 0) / 1e6 AS corr
FROM v_summary WHERE total_spend IS NOT NULL GROUP BY 1"""))
def q_spend_trend(spark, folder):
    """Rentals against spend in millions."""
    totals = summary(rentals(spark, folder)).where(F.col("total_spend").isNotNull()).select(
        "segment", (F.col("total_spend") / 1e6).alias("spend"),
        F.col("total_rentals").cast("double").alias("rentals"))
    return A.spend_trend(totals, "segment", "spend", "rentals")

