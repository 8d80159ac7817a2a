"""Summaries: tiers, pivots, KPI rows, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.functions import from_cents, pct, ratio, rint_to, to_cents
from quaymart.operators.timeseries import distinct_count


def tier_summary(films: DataFrame) -> DataFrame:
    """Films, average rate and cost, and share of all films per tier."""
    rate, cost = to_cents("rental_rate"), to_cents("replacement_cost")
    out = films.groupBy("value_tier").agg(
        F.count("rental_rate").alias("film_count"), F.sum(rate).alias("rate"),
        F.sum(cost).alias("cost"), F.count("replacement_cost").alias("costed"))
    total = F.sum("film_count").over(Window.partitionBy())
    return out.select(
        "value_tier", "film_count",
        ratio("rate", "film_count", 4, 2, half="even").alias("avg_rental_rate"),
        ratio("cost", "costed", 2, 2, half="even").alias("avg_replacement_cost"),
        pct("film_count", total, 2, half="even").alias("pct_of_total"))


def tier_rates(films: DataFrame) -> DataFrame:
    return films.where(F.col("value_tier").isNotNull()).groupBy("value_tier").agg(
        F.count(F.lit(1)).alias("film_count"),
        ratio(F.sum(to_cents("rental_rate")), F.count("rental_rate"), 2, 2).alias("avg_rate"))


def category_rollup(films: DataFrame) -> DataFrame:
    """``rate_sum`` is what one version calls its rental total; ``total_rentals``
    is the sum of rental counts that the column name promises."""
    rate = to_cents("rental_rate")
    return films.where(F.col("category").isNotNull()).groupBy("category").agg(
        F.count(F.lit(1)).alias("film_count"),
        ratio(F.sum(rate), F.count("rental_rate"), 2, 2).alias("avg_rate"),
        from_cents(F.sum(rate)).alias("rate_sum"), F.sum("rental_count").alias("total_rentals"))


def status_pivot(runs: DataFrame, name: str, status: str, values: Sequence[str]) -> DataFrame:
    """Counts per name, one column per status; absent pairs are 0.

    The statuses are given, so the pivot needs no pass to find them and is one
    combining aggregate. Any other status, NULL too, counts in ``other``.
    """
    known = F.coalesce(F.col(status).isin(*values), F.lit(False))
    return runs.groupBy(name).agg(
        *[F.count_if(F.col(status) == v).alias(v) for v in values], F.count_if(~known).alias("other"))


def run_summary(runs: DataFrame, status: str, good: str, bad: str, value: str, at: str) -> DataFrame:
    """Runs, successes, failures, volume, latest run, success share (0 when empty)."""
    one = runs.agg(
        F.count(F.lit(1)).alias("total_runs"), F.count_if(F.col(status) == good).alias("successful"),
        F.count_if(F.col(status) == bad).alias("failed"),
        from_cents(F.sum(to_cents(value))).alias("total_value"), F.max(at).alias("latest_run"))
    return one.withColumn("success_rate", F.coalesce(pct("successful", "total_runs", 2),
                                                     F.lit(0.0)))


def repeat_rate(ltv: DataFrame) -> DataFrame:
    return ltv.agg(
        F.count(F.lit(1)).alias("total_customers"),
        pct(F.count_if(F.col("total_orders") > 1), F.count(F.lit(1)), 2).alias("repeat_rate"),
        ratio(F.sum(to_cents("total_spent")), F.count("total_spent"), 2, 2).alias("avg_ltv"),
        ratio(F.sum(to_cents("avg_review_score")), F.count("avg_review_score"), 2, 2)
        .alias("avg_review"))


def late_review_gap(orders: DataFrame) -> DataFrame:
    """Mean review of late and of on-time orders, late share, mean days."""
    score = to_cents("review_score")
    late = F.col("is_late")
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        pct(F.count_if(late), F.count(late), 2).alias("late_rate"),
        ratio(F.sum("delivery_days"), F.count("delivery_days"), 2).alias("avg_delivery_days"),
        ratio(F.sum(F.when(late, score)), F.count(F.when(late, score)), 2, 2)
        .alias("late_avg_review"),
        ratio(F.sum(F.when(~late, score)), F.count(F.when(~late, score)), 2, 2)
        .alias("on_time_avg_review"))


def ontime_by_state(performance: DataFrame) -> DataFrame:
    rate = to_cents("on_time_delivery_rate")
    return performance.groupBy("seller_state").agg(
        ratio(F.sum(rate), F.count("on_time_delivery_rate"), 4, 2).alias("on_time_delivery_rate"))


def rental_stats(rental: DataFrame, min_rentals: int, min_customers: int) -> DataFrame:
    """Totals, open and returned rentals, customers, and the threshold verdict.

    Folded per customer first: the distinct count is then a row count and no
    row is multiplied for it.
    """
    per = rental.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("return_date").isNull()).alias("open"))
    one = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rentals"),
                  F.coalesce(F.sum("open"), F.lit(0)).alias("open_rentals"),
                  F.count("customer_id").alias("unique_customers"))
    ok = ((F.col("total_rentals") >= min_rentals) & (F.col("unique_customers") >= min_customers))
    return one.select("total_rentals", "open_rentals",
                      (F.col("total_rentals") - F.col("open_rentals")).alias("returned_rentals"),
                      "unique_customers",
                      F.when(ok, "validation_passed").otherwise("validation_failed")
                      .alias("verdict"))


def spend_trend(totals: DataFrame, segment: str, x: str, y: str) -> DataFrame:
    """Straight-line fit and correlation per segment, from mergeable sums."""
    return totals.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n"),
        rint_to(F.regr_slope(y, x), 6).alias("slope"),
        rint_to(F.regr_intercept(y, x), 6).alias("intercept"),
        rint_to(F.corr(x, y), 6).alias("corr"))


def kpi_row(ltv: DataFrame, orders: DataFrame, months: DataFrame) -> DataFrame:
    """One row of headline figures, one scan per mart."""
    score = to_cents("review_score")
    base = ltv.agg(
        F.count(F.lit(1)).alias("total_customers"),
        ratio(F.sum(to_cents("total_spent")), F.count("total_spent"), 2, 2).alias("avg_ltv"),
        F.count_if(F.col("is_churned") == 0).alias("repeat_customers"))
    order = orders.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        ratio(F.sum(score), F.count("review_score"), 2, 2).alias("review"),
        pct(F.count_if("is_late"), F.count("is_late"), 2).alias("late"))).scalar()
    month = months.agg(F.struct(
        F.sum("total_orders").alias("n"),
        from_cents(F.sum(to_cents("total_revenue"))).alias("revenue"))).scalar()
    return base.withColumns({"o": order, "m": month}).select(
        "total_customers", F.col("o.n").alias("total_orders"), F.col("m.n").alias("orders_count"),
        F.col("m.revenue").alias("total_revenue"), F.col("o.review").alias("avg_review_score"),
        F.col("o.late").alias("late_delivery_rate"), "avg_ltv", "repeat_customers")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


__all__ = ["category_rollup", "distinct_count", "kpi_row", "late_review_gap", "ontime_by_state",
           "rental_stats", "repeat_rate", "run_summary", "spend_trend", "status_pivot",
           "tier_rates", "tier_summary", "value_counts"]
