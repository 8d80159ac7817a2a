"""Window analytics over marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.functions import (
    from_cents, month_start, pct, quarter_start, ratio, to_cents,
)
from quaymart.operators.ranking import dense_ranks, global_rank, with_ntile
from quaymart.operators.running import group_stats, running_by_key
from quaymart.session import stage


def top_per_state(performance: DataFrame, n: int = 3) -> DataFrame:
    """Ranked sellers per state. The rank filter is applied per task before the
    shuffle (WindowGroupLimit), so a large state sends only its best rows."""
    best = Window.partitionBy("seller_state").orderBy(F.col("total_revenue").desc_nulls_first())
    return (performance.where(F.col("total_revenue") > 0)
            .select("seller_state", "seller_id", "total_revenue",
                    F.col("avg_review_score").alias("avg_review"),
                    F.rank().over(best).alias("r"))
            .where(F.col("r") <= n)
            .select("seller_state", "seller_id", "total_revenue", "avg_review",
                    F.col("r").cast("bigint").alias("state_rank")))


def spend_percentile(ltv: DataFrame, limit: int = 100) -> DataFrame:
    """Percentile tile, percent rank and rank over all customers; biggest first."""
    ranked = global_rank(ltv.select("customer_unique_id", "value_segment", "total_spent",
                                    "avg_order_value"),
                         "total_spent", "customer_unique_id", tiles=100)
    return ranked.select(
        "customer_unique_id", "value_segment", "total_spent", "avg_order_value",
        F.col("tile").alias("spend_percentile"),
        pct(F.col("rank_asc") - 1, F.col("row_total") - 1, 1).alias("percent_rank"),
        F.col("rank_desc").alias("overall_rank"),
    ).orderBy(F.col("total_spent").desc_nulls_first(),
              F.col("customer_unique_id").desc()).limit(limit)


def category_revenue_share(categories: DataFrame) -> DataFrame:
    """Share, running sum with peers and rank; one row per category."""
    total = F.sum("cents").over(Window.partitionBy())
    down = Window.orderBy(F.col("cents").desc_nulls_first())
    upto = F.sum("cents").over(down)
    return categories.select(
        "product_category_name_english", "total_revenue",
        pct("cents", total, 1).alias("revenue_share_pct"),
        from_cents(upto).alias("cumulative_revenue"),
        pct(upto, total, 1).alias("cumulative_share_pct"),
        F.rank().over(down).cast("bigint").alias("revenue_rank"))


def seller_quartiles(performance: DataFrame) -> DataFrame:
    """Three quartiles over all sellers and their sum; the revenue filter comes last."""
    out = performance.select("seller_id", "seller_state", "total_revenue", "avg_review_score",
                             "on_time_delivery_rate")
    for metric, name in (("total_revenue", "revenue_quartile"),
                         ("avg_review_score", "rating_quartile"),
                         ("on_time_delivery_rate", "ontime_quartile")):
        out = with_ntile(out, 4, [F.col(metric).desc_nulls_first(), "seller_id"], name)
    score = F.col("revenue_quartile") + F.col("rating_quartile") + F.col("ontime_quartile")
    return out.withColumn("overall_score", score).where(F.col("total_revenue") > 0)


def customer_cohort(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers by month of their first delivered order."""
    done = facts.where((F.col("order_status") == "delivered")
                       & F.col("payment_installments").isNotNull())
    firsts = (done.groupBy("customer_id").agg(
        F.min("purchased_at").alias("first_at"), F.sum("total_payment_cents").alias("cents"))
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id").agg(F.min("first_at").alias("first_at"),
                                           F.sum("cents").alias("cents")))
    cohorts = firsts.groupBy(month_start("first_at").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("cohort_size"), F.sum("cents").alias("cents"),
        F.count("cents").alias("n"))
    by_time = Window.orderBy("cohort_month")
    mean = F.col("cents").cast("double") / F.nullif("n", F.lit(0))
    rolling = F.avg("mean").over(by_time.rowsBetween(-2, 0))
    return cohorts.withColumn("mean", mean).select(
        "cohort_month", "cohort_size", ratio("cents", "n", 2, 2).alias("avg_ltv"),
        F.sum("cohort_size").over(by_time).alias("cumulative_customers"),
        (F.round(rolling, 0) / 100.0).alias("rolling_avg_ltv"))


def category_quarters(products: DataFrame, translation: DataFrame, items: DataFrame,
                      orders: DataFrame, top: int = 5) -> DataFrame:
    """Quarterly delivered revenue of the top categories with its change.

    One pass over the items yields (category, quarter, delivered) totals; both
    the choice of the top categories and the trend come from that small table.
    """
    named = products.join(translation, "product_category_name").select(
        "product_id", F.col("product_category_name_english").alias("category"))
    sold = items.join(named, "product_id").groupBy("order_id", "category").agg(
        F.sum(to_cents("price")).alias("cents"))
    cells = (sold.join(orders, "order_id").groupBy(
        "category", quarter_start("order_purchase_timestamp").alias("quarter"),
        (F.col("order_status") == "delivered").alias("done"))
        .agg(F.sum("cents").alias("cents")))
    whole = cells.withColumn("all_cents", F.sum("cents").over(Window.partitionBy("category")))
    order = Window.orderBy(F.col("all_cents").desc(), "category")
    ranked = whole.withColumn("place", F.dense_rank().over(order))
    chosen = ranked.where((F.col("place") <= top) & F.col("done"))
    prev = F.lag("cents").over(Window.partitionBy("category").orderBy("quarter"))
    return chosen.withColumn("prev", prev).select(
        "category", "quarter", from_cents("cents").alias("quarterly_revenue"),
        from_cents("prev").alias("prev_quarter_revenue"),
        from_cents(F.col("cents") - F.col("prev")).alias("qoq_change"))


def above_group_avg(performance: DataFrame, limit: int = 50) -> DataFrame:
    """Sellers above the rounded average of their state.

    Expects a staged mart: it is aggregated and joined to itself.
    """
    wide = performance.select("seller_id", "seller_state", "total_revenue",
                              to_cents("total_revenue").alias("cents"))
    states = wide.groupBy("seller_state").agg(
        ratio(F.sum("cents"), F.count("cents"), 2, 2).alias("state_avg_revenue"),
        F.count(F.lit(1)).alias("sellers_in_state"))
    avg_cents = to_cents("state_avg_revenue")
    above = F.col("cents") - avg_cents
    return (wide.join(states, "seller_state").where(F.col("cents") > avg_cents).select(
        "seller_id", "seller_state", F.col("total_revenue").alias("seller_revenue"),
        "state_avg_revenue", from_cents(above).alias("revenue_above_avg"),
        pct(above, avg_cents, 1).alias("pct_above_avg"), "sellers_in_state")
        .orderBy(F.col("pct_above_avg").desc_nulls_first(), "seller_id").limit(limit))


def review_improvement(orders: DataFrame, reviews: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers whose last delivered order got a better score than their first.

    First and last come from one aggregate (min_by / max_by) instead of two
    numbered copies joined to each other; equal times are ordered by order id.
    """
    scored = (orders.where(F.col("order_status") == "delivered")
              .join(reviews.where(F.col("review_score").isNotNull()), "order_id")
              .select("customer_id", F.struct("order_purchase_timestamp", "order_id").alias("at"),
                      F.col("review_score").cast("bigint").alias("score")))
    ends = scored.groupBy("customer_id").agg(
        F.min("at").alias("first_at"), F.max("at").alias("last_at"),
        F.min_by("score", "at").alias("first_review"), F.max_by("score", "at").alias("last_review"))
    ends = (ends.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
            .groupBy("customer_unique_id").agg(
                F.min("first_at").alias("a"), F.max("last_at").alias("b"),
                F.min_by("first_review", "first_at").alias("first_review"),
                F.max_by("last_review", "last_at").alias("last_review")))
    return ends.where((F.col("a.order_id") != F.col("b.order_id"))
                      & (F.col("last_review") > F.col("first_review"))).select(
        "customer_unique_id", "first_review", "last_review",
        (F.col("last_review") - F.col("first_review")).alias("improvement"))


def group_stats_rows(payment: DataFrame) -> DataFrame:
    """Each payment with its customer's sum, mean and count, and its share."""
    rows = group_stats(payment.withColumn("cents", to_cents("amount")), "customer_id", "cents")
    mean = ratio("group_sum", "group_n", 4, 2, half="even")
    return rows.select(
        "customer_id", "rental_id", "payment_date", "amount",
        from_cents("group_sum").alias("customer_total_spend"), mean.alias("customer_avg_payment"),
        F.col("group_n").alias("customer_payment_count"),
        F.when(F.col("amount") > mean, 1).otherwise(0).cast("bigint").alias("above_avg_flag"),
        pct("cents", "group_sum", 2, half="even").alias("pct_of_customer_total"))


def rolling_by_customer(payment: DataFrame, **options) -> DataFrame:
    """Rolling-3 mean, running sum and running maximum of a customer's payments."""
    rows = running_by_key(
        payment.withColumn("cents", to_cents("amount")), "customer_id",
        ["payment_date", "rental_id", "film_id", "cents"], "cents", **options)
    return rows.select(
        "customer_id", "rental_id", "film_id", "payment_date", "amount",
        ratio("roll_sum", "roll_n", 4, 2, half="even").alias("rolling_3_avg"),
        from_cents("run_sum").alias("cumulative_spend"),
        from_cents("run_max").alias("running_max_payment"))


def payment_ranks(payment: DataFrame) -> DataFrame:
    """Dense rank of each payment for its customer, and of the customer's total.

    Rows without an amount have no rank for their customer, and customers
    without any amount none at all; both stay, as do rows without a customer,
    which count as one.
    """
    rows = stage(payment.withColumn("cents", to_cents("amount")))
    inside = dense_ranks(rows, ["customer_id"], "cents", "payment_rank_within_customer")
    totals = rows.groupBy("customer_id").agg(F.sum("cents").alias("total_cents"))
    order = dense_ranks(totals, [], "total_cents", "spend_rank")
    ranked = stage(totals.join(order, "total_cents").select(F.col("customer_id").alias("__customer"), "spend_rank"))
    inside = stage(inside.withColumnsRenamed({"customer_id": "__id", "cents": "__cents"}))
    same = F.col("customer_id").eqNullSafe(F.col("__id")) & (F.col("cents") == F.col("__cents"))
    return (rows.join(inside, same, "left")
            .join(ranked, F.col("customer_id").eqNullSafe(F.col("__customer")), "left")
            .select("customer_id", "rental_id", "payment_date", "amount",
                    "payment_rank_within_customer", "spend_rank"))


def top_spenders(payment: DataFrame, customer: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` first customers by dense spend rank (``nsmallest`` on the rank)."""
    totals = payment.groupBy("customer_id").agg(F.sum(to_cents("amount")).alias("total_cents"))
    order = dense_ranks(totals, [], "total_cents", "spend_rank").where(F.col("spend_rank") <= n)
    best = totals.join(order, "total_cents").orderBy("spend_rank", "customer_id").limit(n)
    return best.join(customer, "customer_id").select(
        "spend_rank", "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        from_cents("total_cents").alias("total_spend"))

