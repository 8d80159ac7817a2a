"""Bucketing, calendars, growth. Windows here run over one row per period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.functions import (
    from_cents, month_label, month_start, pct, pct_change, ratio, rint_to, to_cents, week_start,
)


def monthly_trend(rental: DataFrame, payment: DataFrame) -> DataFrame:
    """Rentals, distinct customers and revenue per month of the rental.

    Folded to (month, customer) first, so the distinct count is a row count.
    """
    paid = payment.groupBy("rental_id").agg(
        F.count(F.lit(1)).alias("rentals"), F.sum(to_cents("amount")).alias("cents"))
    per = rental.join(paid, "rental_id").groupBy(
        month_start("rental_date").alias("rental_month"), "customer_id").agg(
        F.sum("rentals").alias("rentals"), F.sum("cents").alias("cents"))
    return per.groupBy("rental_month").agg(
        F.sum("rentals").alias("rentals"), F.count("customer_id").alias("unique_customers"),
        F.sum("cents").alias("cents")).select(
        "rental_month", "rentals", "unique_customers", from_cents("cents").alias("monthly_revenue"))


def payment_months(payment: DataFrame) -> DataFrame:
    return payment.groupBy(month_start("payment_date").alias("month")).agg(
        F.sum(to_cents("amount")).alias("cents"), F.count("amount").alias("payment_count"))


def monthly_growth(payment: DataFrame) -> DataFrame:
    """Months that occur, labelled ``yyyy-MM``, with growth over the previous row."""
    months = payment_months(payment).withColumn(
        "prev", F.lag("cents").over(Window.orderBy("month")))
    return months.select(
        month_label("month").alias("month"), from_cents("cents").alias("total_revenue"),
        "payment_count", ratio("cents", "payment_count", 2, 2, half="even").alias("avg_payment"),
        pct_change("cents", "prev").alias("mom_growth_pct"))


def calendar(months: DataFrame, month: str = "month") -> DataFrame:
    """Every month from the first to the last one present."""
    span = months.agg(F.min(month).alias("a"), F.max(month).alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias(month))


def month_range(spark, first: str, last: str, name: str = "month") -> DataFrame:
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"),
                      F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(span).alias(name))


def fill_months(payment: DataFrame) -> DataFrame:
    """Month-end labels; months without rows stay, with zero sum and count."""
    months = payment_months(payment)
    filled = calendar(months).join(months, "month", "left")
    cents = F.coalesce("cents", F.lit(0))
    return filled.select(
        F.last_day("month").alias("payment_date"), from_cents(cents).alias("total_revenue"),
        F.coalesce("payment_count", F.lit(0)).cast("bigint").alias("payment_count"),
        ratio("cents", "payment_count", 4, 2, half="even").alias("avg_payment"))


def growth_and_peak(months: DataFrame) -> DataFrame:
    """Growth, previous value, distance to the mean, peak flag."""
    cents = to_cents("total_revenue")
    by_time, all_rows = Window.orderBy("payment_date"), Window.partitionBy()
    wide = months.withColumns({"c": cents}).withColumns({
        "prev": F.lag("c").over(by_time), "s": F.sum("c").over(all_rows),
        "k": F.count("c").over(all_rows), "top": F.max("c").over(all_rows)})
    return wide.select(
        "payment_date", "total_revenue", "payment_count", "avg_payment",
        pct_change("c", "prev").alias("mom_growth_pct"),
        from_cents("prev").alias("prev_month_revenue"),
        ratio(F.col("c") * F.col("k") - F.col("s"), "k", 2, 2, half="even").alias("revenue_vs_avg"),
        (F.col("c") == F.col("top")).alias("is_peak_month"))


def distinct_count(df: DataFrame, col: str) -> Column:
    """Exact distinct count as a scalar subquery, in two combining steps."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().agg(F.count(F.lit(1))).scalar()


def weekly_activity(rental: DataFrame) -> DataFrame:
    """Rentals and open rentals per week, next to the overall customer count."""
    weeks = rental.groupBy(week_start("rental_date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("rental_count"),
        F.count_if(F.col("return_date").isNull()).alias("still_open"))
    return weeks.withColumn("unique_customers", distinct_count(rental, "customer_id"))


def weekly_peak(rental: DataFrame) -> DataFrame:
    """Weekly counts with their mean and the first week of the maximum."""
    weeks = rental.groupBy(week_start("rental_date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("rental_count"))
    all_rows = Window.partitionBy()
    top = F.max(F.struct("rental_count", (-F.unix_date("week_start")).alias("d"))).over(all_rows)
    mean = ratio(F.sum("rental_count").over(all_rows), F.count(F.lit(1)).over(all_rows), 2)
    return weeks.select("week_start", "rental_count", mean.alias("mean_rentals"),
                        (F.unix_date("week_start") == -top["d"]).alias("is_peak"))


def month_gaps(expected: DataFrame, months: DataFrame, low: int) -> DataFrame:
    """Expected months against actual ones: MISSING, LOW VOLUME or NORMAL."""
    status = (F.when(F.col("order_month").isNull(), "MISSING")
              .when(F.col("total_orders") < low, "LOW VOLUME").otherwise("NORMAL"))
    return expected.join(months, F.col("month") == F.col("order_month"), "left").select(
        F.col("month").alias("expected_month"), "total_revenue", "total_orders",
        status.alias("status"))


def running_revenue(months: DataFrame) -> DataFrame:
    cents = to_cents("total_revenue")
    by_time = Window.orderBy("order_month")
    recent = by_time.rowsBetween(-2, 0)
    return months.select(
        "order_month", "total_revenue",
        from_cents(F.sum(cents).over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .alias("cumulative_revenue"),
        ratio(F.sum(cents).over(recent), F.count(cents).over(recent), 2, 2)
        .alias("rolling_3mo_avg"))


TREND_LABELS = ("Growth", "Decline", "Flat")


def revenue_mom(months: DataFrame) -> DataFrame:
    """Change over the previous month; the first row counts as flat."""
    wide = months.select("order_month", to_cents("total_revenue").alias("c")).withColumn(
        "prev", F.lag("c").over(Window.orderBy("order_month")))
    delta = F.col("c") - F.col("prev")
    up, down, flat = TREND_LABELS
    return wide.select(
        "order_month", from_cents("c").alias("revenue"),
        from_cents("prev").alias("prev_month_revenue"), from_cents(delta).alias("revenue_delta"),
        pct(delta, "prev", 1).alias("mom_growth_pct"),
        F.when(delta > 0, up).when(delta < 0, down).otherwise(flat).alias("trend"))


def order_volume_trend(months: DataFrame) -> DataFrame:
    by_time = Window.orderBy("order_month")
    recent = F.avg("total_orders").over(by_time.rowsBetween(-2, 0))
    wide = months.select("order_month", "total_orders", "total_revenue", recent.alias("m"),
                         F.lead("total_orders", 1).over(by_time).alias("next_month_orders"))
    return wide.select(
        "order_month", "total_orders", "total_revenue", rint_to(F.col("m"), 6).alias("moving_avg_3mo"),
        "next_month_orders",
        rint_to(F.col("total_orders") - F.col("m"), 6).alias("orders_vs_moving_avg"))
