"""Rental analytics over film, customer, rental and payment frames.

Payments are folded to one row per rental, film or customer before they meet
a dimension, so a key that holds a large part of the payments is combined
map-side and never travels as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.functions import (
    concat_skip_null, cut_right_closed, from_cents, price_tier, ratio, rint_to, to_cents,
    whole_days,
)
from quaymart.functions.binning import SPEND_EDGES, TIER_CUTS
from quaymart.functions.temporal import MICROS_PER_DAY, micros_between
from quaymart.operators.filters import top_k


def _fold(payment: DataFrame, key: str) -> DataFrame:
    return payment.groupBy(key).agg(
        F.count(F.lit(1)).alias("rentals"), F.sum(to_cents("amount")).alias("cents"),
        F.count("amount").alias("payments"))


def revenue_by_rating(film: DataFrame, payment: DataFrame) -> DataFrame:
    sold = film.join(_fold(payment, "film_id"), "film_id")
    out = sold.groupBy("rating").agg(
        F.count(F.lit(1)).alias("film_count"), F.sum("rentals").alias("total_rentals"),
        F.sum("cents").alias("cents"), F.sum("payments").alias("payments"))
    return out.select("rating", "film_count", "total_rentals",
                      from_cents("cents").alias("total_revenue"),
                      ratio("cents", "payments", 2, 2).alias("avg_payment"))


def category_popularity(film: DataFrame, payment: DataFrame, limit: int = 10) -> DataFrame:
    """The average rate is taken over rentals, as the joined rows would give."""
    sold = film.join(_fold(payment, "film_id"), "film_id")
    rate = to_cents("rental_rate")
    out = sold.groupBy("category").agg(
        F.sum("rentals").alias("total_rentals"), F.sum("cents").alias("cents"),
        F.sum(rate * F.col("rentals")).alias("rate_cents"),
        F.sum(F.when(rate.isNotNull(), F.col("rentals"))).alias("rated"),
        F.count(F.lit(1)).alias("film_count"))
    out = out.select(F.col("category").alias("category_name"), "total_rentals",
                     from_cents("cents").alias("total_revenue"),
                     ratio("rate_cents", "rated", 4, 2).alias("avg_rental_rate"), "film_count")
    return top_k(out, limit, F.col("total_rentals").desc(), "category_name")


def customer_totals(rental: DataFrame, payment: DataFrame) -> DataFrame:
    """Per customer: joined rental rows, spend, payments, first and last rental.

    A rental without payments counts one row; with payments one row each.
    """
    paid = _fold(payment, "rental_id").withColumnRenamed("rentals", "rows")
    joined = rental.join(paid, "rental_id", "left")
    return joined.groupBy("customer_id").agg(
        F.sum(F.coalesce("rows", F.lit(1))).alias("rentals"), F.sum("cents").alias("cents"),
        F.sum("rows").alias("paid_rows"), F.sum("payments").alias("payments"),
        F.max("rental_date").alias("last_rental"), F.min("rental_date").alias("first_rental"))


def top_customers(customer: DataFrame, rental: DataFrame, payment: DataFrame,
                  limit: int = 10) -> DataFrame:
    """Biggest spenders; only rentals that have payments count."""
    totals = customer_totals(rental, payment).where(F.col("paid_rows") > 0)
    out = customer.join(totals, "customer_id").select(
        "customer_id", concat_skip_null("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", from_cents("cents").alias("total_spend"),
        F.col("paid_rows").alias("rental_count"),
        ratio("cents", "payments", 2, 2).alias("avg_spend_per_rental"))
    return top_k(out, limit, F.col("total_spend").desc_nulls_first(), "customer_id")


def customer_lifetime(customer: DataFrame, rental: DataFrame, payment: DataFrame,
                      loaded_at: Column | None = None) -> DataFrame:
    """Every customer, also without rentals: spend, rentals, first and last date."""
    totals = customer_totals(rental, payment)
    extra = [] if loaded_at is None else [loaded_at.alias("load_timestamp")]
    return customer.join(totals, "customer_id", "left").select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", F.coalesce("rentals", F.lit(0)).cast("bigint").alias("total_rentals"),
        from_cents("cents").alias("total_spend"),
        ratio("cents", "payments", 2, 2).alias("avg_spend_per_rental"),
        F.col("last_rental").alias("last_rental_date"),
        F.col("first_rental").alias("first_rental_date"), *extra)


def customer_summary(customer: DataFrame, payment: DataFrame, latest: Column,
                     edges: Sequence[float] = SPEND_EDGES) -> DataFrame:
    """Customers with segment, recency against the data's last payment, active flag."""
    spend = payment.groupBy("customer_id").agg(
        F.count("rental_id").alias("total_rentals"), F.sum(to_cents("amount")).alias("cents"),
        F.min("payment_date").alias("first_payment"), F.max("payment_date").alias("last_payment"))
    spent = from_cents("cents")
    return customer.join(spend, "customer_id", "left").select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", F.col("active").cast("boolean").alias("is_active"),
        cut_right_closed(F.coalesce(spent, F.lit(0.0)), edges).alias("segment"),
        "total_rentals", spent.alias("total_spend"), "first_payment", "last_payment",
        whole_days(F.col("last_payment"), latest).alias("days_since_last_payment"))


def overdue(rental: DataFrame, customer: DataFrame, film: DataFrame, limit: int = 20,
            late_only: bool = False) -> DataFrame:
    """Longest days past due (start + allowed days).

    Returned items only. ``late_only`` adds the filter that the query's
    description asks for. The cut is made on keys; names join afterwards to
    ``limit`` rows.
    """
    due = F.col("rental_date") + F.make_dt_interval(F.col("rental_duration"))
    over = micros_between(due, F.col("return_date"))
    rows = (rental.where(F.col("return_date").isNotNull())
            .join(film.select("film_id", "title", "rental_duration"), "film_id")
            .select("rental_id", "line_no", "store_id", "film_id", "customer_id",
                    F.col("title").alias("film_title"), "rental_date",
                    due.alias("due_date"), "return_date",
                    ratio(over, F.lit(MICROS_PER_DAY), 2).alias("days_overdue")))
    if late_only:
        rows = rows.where(F.col("return_date") > F.col("due_date"))
    cut = top_k(rows, limit, F.col("days_overdue").desc_nulls_first(), "rental_id", "line_no",
                "film_id", "store_id")
    return cut.join(customer, "customer_id").select(
        "rental_id", concat_skip_null("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "film_title", "rental_date", "due_date", "return_date", "days_overdue")


def film_value_score(film: DataFrame, rental: DataFrame) -> DataFrame:
    """(rate / duration) * ln(1 + rentals), scaled to 0..100 over all films.

    The extremes are scalar subqueries over the same per-film aggregate; they
    reuse its shuffle.
    """
    counts = rental.groupBy("film_id").agg(F.count(F.lit(1)).alias("n"))
    scored = film.join(counts, "film_id", "left").select(
        "film_id", "title", "category", "rating", "rental_rate", "rental_duration",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("rental_count"),
        (F.col("rental_rate") / F.nullif(F.col("rental_duration").cast("double"), F.lit(0.0))
         * F.log1p(F.coalesce("n", F.lit(0)).cast("double"))).alias("raw"))
    low = scored.agg(F.min("raw")).scalar()
    high = scored.agg(F.max("raw")).scalar()
    score = (F.col("raw") - low) / F.nullif(high - low, F.lit(0.0)) * 100
    return scored.select("film_id", "title", "category", "rating", "rental_rate",
                         "rental_duration", "rental_count", rint_to(score, 2).alias("value_score"))


def item_tier(film: DataFrame, category: DataFrame, cuts: Sequence[float] = TIER_CUTS) -> DataFrame:
    """Films with their category, if any, and price tier."""
    return film.join(category, "film_id", "left").withColumn(
        "value_tier", price_tier("rental_rate", cuts))


def top_by_count(customer: DataFrame, rental: DataFrame, limit: int = 10) -> DataFrame:
    counts = rental.groupBy("customer_id").agg(F.count("rental_id").alias("rental_count"))
    out = customer.join(counts, "customer_id").select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "rental_count")
    return top_k(out, limit, F.col("rental_count").desc(), "customer_id")


def cluster_spend(clusters: DataFrame, totals: DataFrame) -> DataFrame:
    """Customers, average spend and rentals per cluster label."""
    out = clusters.join(totals, "customer_id").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("cents").alias("cents"),
        F.count("cents").alias("n"), F.sum("rentals").alias("rentals"))
    return out.select("cluster", "customer_count", ratio("cents", "n", 2, 2).alias("avg_spend"),
                      ratio("rentals", "customer_count", 2).alias("avg_rentals"))
