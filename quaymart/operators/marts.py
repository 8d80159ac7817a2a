"""Commerce marts.

The many-sides of an order (payments, items, reviews) are aggregated to one row
per order before any join. Variants named ``*_raw`` reproduce results in which
payments repeat per review row; they do so by multiplying with row counts, not
by building the repeated rows, so their cost is that of the clean form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.functions import (
    distinct_list, floor_segment, from_cents, month_start, pct, ratio, to_cents, whole_days,
)
from quaymart.functions.binning import LTV_CUTS


# --- staging ----------------------------------------------------------------

def stg_orders(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed order times, purchase month, three-valued lateness, whole days."""
    bought, due = F.col("order_purchase_timestamp"), F.col("order_estimated_delivery_date")
    got = F.col("order_delivered_customer_date")
    known = (F.col("order_status") == "delivered") & got.isNotNull() & due.isNotNull()
    ntz = "timestamp_ntz"
    return orders.select(
        "order_id", "customer_id", "order_status",
        bought.cast(ntz).alias("purchased_at"),
        F.col("order_approved_at").cast(ntz).alias("approved_at"),
        F.col("order_delivered_carrier_date").cast(ntz).alias("shipped_at"),
        got.cast(ntz).alias("delivered_at"),
        due.cast(ntz).alias("estimated_delivery_at"),
        month_start(bought).alias("purchase_month"),
        F.when(known, got.cast(ntz) > due.cast(ntz)).alias("is_late"),
        whole_days(bought, got).alias("delivery_days"), *keep)


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", "customer_city",
                            "customer_state", "customer_zip_code_prefix")


def stg_order_payments(payments: DataFrame) -> DataFrame:
    """One row per order: total, number of payments, payment types."""
    return payments.groupBy("order_id").agg(
        F.sum(to_cents("payment_value")).alias("total_payment_cents"),
        F.count(F.lit(1)).alias("payment_installments"),
        distinct_list("payment_type").alias("payment_types"))


def order_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.sum(F.col("review_score").cast("bigint")).alias("review_sum"),
        F.count("review_score").alias("review_count"))


def order_item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.count("product_id").alias("product_count"))


def order_facts(orders: DataFrame, payments: DataFrame, reviews: DataFrame,
                items: DataFrame) -> DataFrame:
    """Every order with its payments, reviews and items pre-aggregated.

    All sides are hashed on ``order_id`` by their own aggregate, so the joins
    add one shuffle only, for the orders.
    """
    return (stg_orders(orders)
            .join(stg_order_payments(payments), "order_id", "left")
            .join(order_reviews(reviews), "order_id", "left")
            .join(order_item_counts(items), "order_id", "left"))


def _review_rows() -> Column:
    """How often a left join with the reviews repeats the order."""
    return F.greatest(F.coalesce("review_count", F.lit(0)), F.lit(1)).cast("bigint")


def _order_review() -> Column:
    return F.try_divide("review_sum", "review_count")


def _paid_orders(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("payment_installments").isNotNull())


# --- customer lifetime value ------------------------------------------------

def _ltv_columns(cuts: Sequence[float]) -> dict[str, Column]:
    return {
        "value_segment": floor_segment(F.col("total_spent"), cuts),
        "is_churned": F.when(F.col("total_orders") == 1, 1).otherwise(0).cast("bigint"),
        "avg_order_value": ratio("spent_cents", "total_orders", 2, 2),
    }


def _roll_up_customers(per_customer: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """customer_id totals -> (customer, city, state) totals."""
    sums = ["total_orders", "spent_cents", "review_total", "review_n", "delivered_orders",
            "cancelled_orders"]
    place = ["customer_unique_id", "customer_city", "customer_state"]
    named = customers.select("customer_id", *place).join(per_customer, "customer_id")
    return named.groupBy(*place).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    ).withColumns({
        "total_spent": from_cents("spent_cents"),
        "days_since_last_order": whole_days(F.col("last_order_date"), as_of),
        "avg_review_score": ratio("review_total", "review_n", 2),
    })


LTV_COLUMNS = ["customer_unique_id", "customer_city", "customer_state", "total_orders",
               "total_spent", "first_order_date", "last_order_date", "days_since_last_order",
               "avg_review_score", "delivered_orders", "cancelled_orders", "value_segment",
               "is_churned", "avg_order_value"]


def customer_ltv(facts: DataFrame, customers: DataFrame, as_of: Column,
                 cuts: Sequence[float] = LTV_CUTS) -> DataFrame:
    """One row per customer: the place with the highest spend."""
    per_customer = _paid_orders(facts).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_payment_cents").alias("spent_cents"),
        F.sum(_order_review()).alias("review_total"), F.count(_order_review()).alias("review_n"),
        F.count_if(F.col("order_status") == "delivered").alias("delivered_orders"),
        F.count_if(F.col("order_status") == "canceled").alias("cancelled_orders"),
        F.min("purchased_at").alias("first_order_date"),
        F.max("purchased_at").alias("last_order_date"))
    ltv = _roll_up_customers(per_customer, customers, as_of).withColumns(_ltv_columns(cuts))
    best = Window.partitionBy("customer_unique_id").orderBy(
        F.col("total_spent").desc_nulls_first(), "customer_city", "customer_state")
    return (ltv.withColumn("rn", F.row_number().over(best).cast("bigint"))
            .where(F.col("rn") == 1).select(*LTV_COLUMNS[:13], "rn", "avg_order_value"))


def customer_ltv_raw(facts: DataFrame, customers: DataFrame, as_of: Column,
                     cuts: Sequence[float] = LTV_CUTS) -> DataFrame:
    """The same mart with payments repeated per review row.

    Order counts by status count joined rows, and the status looked for is
    spelt 'cancelled', which never occurs.
    """
    rows = F.col("payment_installments") * _review_rows()
    per_customer = _paid_orders(facts).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.col("total_payment_cents") * _review_rows()).alias("spent_cents"),
        F.sum(F.col("review_sum") * F.col("payment_installments")).alias("review_total"),
        F.sum(F.coalesce("review_count", F.lit(0)) * F.col("payment_installments"))
        .alias("review_n"),
        F.sum(F.when(F.col("order_status") == "delivered", rows).otherwise(0))
        .alias("delivered_orders"),
        F.sum(F.when(F.col("order_status") == "cancelled", rows).otherwise(0))
        .alias("cancelled_orders"),
        F.min("purchased_at").alias("first_order_date"),
        F.max("purchased_at").alias("last_order_date"))
    return (_roll_up_customers(per_customer, customers, as_of)
            .withColumns(_ltv_columns(cuts)).select(*LTV_COLUMNS))


# --- orders -----------------------------------------------------------------

def _with_customer(facts: DataFrame, customers: DataFrame) -> DataFrame:
    return facts.join(customers.select("customer_id", "customer_unique_id"), "customer_id")


def order_metrics(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered orders that have payments and items, one row each."""
    done = _paid_orders(facts).where(
        (F.col("order_status") == "delivered") & F.col("product_count").isNotNull())
    return _with_customer(done, customers).select(
        "order_id", "customer_unique_id", "order_status", "purchased_at", "delivered_at",
        "estimated_delivery_at", "delivery_days",
        F.coalesce("is_late", F.lit(False)).alias("is_late"),
        from_cents("total_payment_cents").alias("total_payment"), "payment_types",
        ratio("review_sum", "review_count", 2).alias("review_score"), "product_count")


def order_product_metrics(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered, paid orders; the item count may be missing; no reviews."""
    done = _paid_orders(facts).where(F.col("order_status") == "delivered")
    return _with_customer(done, customers).select(
        "order_id", "customer_unique_id", "order_status", "purchased_at", "delivered_at",
        "estimated_delivery_at", "delivery_days",
        from_cents("total_payment_cents").alias("total_payment"), "payment_types",
        "product_count", F.coalesce("is_late", F.lit(False)).alias("is_late"))


def order_metrics_raw(orders: DataFrame, customers: DataFrame, payments: DataFrame,
                      reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered orders with their first payment; distinct rows.

    ``order_purchase_date`` is the day of the month, as in the mart this
    stands for; ``purchase_date`` is the true date.
    """
    done = orders.where(F.col("order_status") == "delivered")
    first_payment = payments.where(F.col("payment_sequential") == 1).select(
        "order_id", F.col("payment_value").cast("double").alias("payment_value"),
        "payment_type").distinct()
    counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("product_count"))
    scores = reviews.select("order_id", "review_score").distinct()
    bought, due = F.col("order_purchase_timestamp"), F.col("order_estimated_delivery_date")
    got = F.col("order_delivered_customer_date")
    joined = (done.join(first_payment, "order_id").join(counts, "order_id")
              .join(scores, "order_id", "left")
              .join(customers.select("customer_id", "customer_unique_id"), "customer_id"))
    return joined.select(
        "order_id", "customer_unique_id", "order_status",
        F.dayofmonth(bought.cast("date")).cast("bigint").alias("order_purchase_date"),
        bought.cast("date").alias("purchase_date"),
        due.alias("order_estimated_delivery_date"), got.alias("order_delivered_customer_date"),
        whole_days(bought, due).alias("delivery_days_estimated"),
        whole_days(bought, got).alias("delivery_days_actual"),
        F.when(got > due, 1).otherwise(0).cast("bigint").alias("is_late"),
        whole_days(due, got).alias("days_late"), "payment_value", "payment_type",
        F.col("review_score").cast("bigint").alias("review_score"), "product_count")


# --- sellers ----------------------------------------------------------------

def seller_performance(sellers: DataFrame, items: DataFrame, orders: DataFrame,
                       reviews: DataFrame) -> DataFrame:
    """Orders, revenue, review, on-time share, products and months per seller.

    Three distinct counts in one aggregate would multiply the item rows by
    four. Instead items are folded to (seller, order) inside the partitioning
    the order join needs anyway, then to (seller, month); distinct products
    come from the distinct (seller, product) pairs.
    """
    per_order = items.groupBy("order_id", "seller_id").agg(
        F.count("order_id").alias("units"), F.sum(to_cents("price")).alias("cents"),
        F.count("price").alias("priced"))
    dated = orders.select(
        "order_id", month_start("order_purchase_timestamp").alias("month"),
        F.coalesce(F.col("order_delivered_customer_date")
                   <= F.col("order_estimated_delivery_date"), F.lit(False)).alias("on_time"))
    rows = _review_rows()
    monthly = (per_order.join(dated, "order_id")
               .join(order_reviews(reviews), "order_id", "left")
               .groupBy("seller_id", "month").agg(
                   F.count(F.lit(1)).alias("orders"),
                   F.sum(F.col("units") * rows).alias("units"),
                   F.sum(F.col("cents") * rows).alias("cents"),
                   F.sum(F.col("priced") * rows).alias("priced"),
                   F.sum(F.when(F.col("on_time"), F.col("units") * rows).otherwise(0))
                   .alias("on_time_units"),
                   F.sum(F.col("review_sum") * F.col("units")).alias("review_total"),
                   F.sum(F.col("review_count") * F.col("units")).alias("review_n")))
    totals = monthly.groupBy("seller_id").agg(
        *[F.sum(c).alias(c) for c in ("orders", "units", "cents", "priced", "on_time_units",
                                      "review_total", "review_n")],
        F.count("month").alias("active_months"))
    # Pairs without a matching order must not count: keep only items that join.
    products = (items.select("order_id", "seller_id", "product_id")
                .join(orders.select("order_id"), "order_id", "left_semi")
                .where(F.col("product_id").isNotNull())
                .select("seller_id", "product_id").distinct()
                .groupBy("seller_id").agg(F.count(F.lit(1)).alias("unique_products")))
    return (sellers.join(totals, "seller_id").join(products, "seller_id", "left").select(
        "seller_id", "seller_city", "seller_state", F.col("orders").alias("total_orders"),
        from_cents("cents").alias("total_revenue"),
        ratio("cents", "priced", 2, 2).alias("avg_order_value"),
        ratio("review_total", "review_n", 2).alias("avg_review_score"),
        pct("on_time_units", "units", 2).alias("on_time_delivery_rate"),
        F.col("units").alias("total_products_sold"),
        F.coalesce("unique_products", F.lit(0)).cast("bigint").alias("unique_products"),
        "active_months"))


def seller_revenue(sellers: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per seller alone, for queries that need nothing else."""
    cents = items.groupBy("seller_id").agg(F.sum(to_cents("price")).alias("cents"))
    return sellers.join(cents, "seller_id").select(
        "seller_id", "seller_city", "seller_state", from_cents("cents").alias("total_revenue"))


def seller_summary(sellers: DataFrame, items: DataFrame, facts: DataFrame,
                   corrected: bool = False) -> DataFrame:
    """Delivered orders per seller.

    As reproduced, the order's whole payment counts once per item row and the
    on-time share divides item rows by orders, so it can exceed 100. With
    ``corrected`` each order counts once and revenue is the seller's own items.
    """
    per_order = items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("units"), F.sum(to_cents("price")).alias("own_cents"))
    done = _paid_orders(facts).where(F.col("order_status") == "delivered").select(
        "order_id", "total_payment_cents", "delivery_days", "is_late")
    late = F.coalesce("is_late", F.lit(False))
    weight = F.lit(1).cast("bigint") if corrected else F.col("units")
    revenue = F.col("own_cents") if corrected else F.col("total_payment_cents") * F.col("units")
    totals = per_order.join(done, "order_id").groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum(revenue).alias("cents"),
        F.sum(F.col("delivery_days") * weight).alias("days"),
        F.sum(F.when(F.col("delivery_days").isNotNull(), weight)).alias("dated"),
        F.sum(F.when(late, weight).otherwise(0)).alias("late_order_count"),
        F.sum(F.when(late, F.lit(0)).otherwise(weight)).alias("on_time"))
    return sellers.join(totals, "seller_id").select(
        "seller_id", "seller_state", "total_orders", from_cents("cents").alias("total_revenue"),
        ratio("days", "dated", 2).alias("avg_delivery_days"), "late_order_count",
        pct("on_time", "total_orders", 2).alias("on_time_rate"))


def state_revenue_rank(performance: DataFrame) -> DataFrame:
    """Sellers, revenue, review, rank and share per state.

    The unpartitioned windows run over one row per state.
    """
    states = performance.groupBy("seller_state").agg(
        F.count(F.lit(1)).alias("seller_count"),
        F.sum(to_cents("total_revenue")).alias("cents"),
        F.sum(to_cents("avg_review_score")).alias("review_total"),
        F.count("avg_review_score").alias("review_n"))
    total = F.sum("cents").over(Window.partitionBy())
    rank = F.rank().over(Window.orderBy(F.col("cents").desc_nulls_first()))
    return states.select(
        "seller_state", "seller_count", from_cents("cents").alias("state_revenue"),
        ratio("review_total", "review_n", 2, 2).alias("avg_review"),
        rank.cast("bigint").alias("revenue_rank"), pct("cents", total, 2).alias("revenue_share_pct"))


# --- products ---------------------------------------------------------------

def product_analytics(products: DataFrame, translation: DataFrame, items: DataFrame,
                      orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per translated category; untranslated products drop out.

    Items are folded to (category, order) before they meet the orders, and the
    distinct products are counted on the product side.
    """
    named = products.join(translation, "product_category_name").select(
        "product_id", F.col("product_category_name_english").alias("category"),
        F.col("product_weight_g").cast("bigint").alias("weight"))
    known = items.join(orders.select("order_id"), "order_id", "left_semi")
    sold = known.select("product_id").distinct().join(named, "product_id").groupBy(
        "category").agg(F.count(F.lit(1)).alias("total_products"))
    per_order = items.join(named, "product_id").groupBy("order_id", "category").agg(
        F.count(F.lit(1)).alias("units"), F.sum(to_cents("price")).alias("cents"),
        F.count("price").alias("priced"), F.sum("weight").alias("weight"),
        F.count("weight").alias("weighed"))
    rows = _review_rows()
    totals = (per_order.join(orders.select("order_id", "order_status"), "order_id")
              .join(order_reviews(reviews), "order_id", "left")
              .groupBy("category").agg(
                  F.count(F.lit(1)).alias("total_orders"),
                  F.sum(F.col("units") * rows).alias("units"),
                  F.sum(F.col("cents") * rows).alias("cents"),
                  F.sum(F.col("priced") * rows).alias("priced"),
                  F.sum(F.col("weight") * rows).alias("weight"),
                  F.sum(F.col("weighed") * rows).alias("weighed"),
                  F.sum(F.col("review_sum") * F.col("units")).alias("review_total"),
                  F.sum(F.col("review_count") * F.col("units")).alias("review_n"),
                  F.sum(F.when(F.col("order_status") == "canceled", F.col("units") * rows)
                        .otherwise(0)).alias("canceled")))
    return totals.join(sold, "category").select(
        F.col("category").alias("product_category_name_english"), "total_products",
        "total_orders", from_cents("cents").alias("total_revenue"),
        ratio("cents", "priced", 2, 2).alias("avg_price"),
        ratio("review_total", "review_n", 2).alias("avg_review_score"),
        ratio("weight", "weighed", 2).alias("avg_product_weight_g"),
        pct("canceled", "units", 2).alias("return_rate"))


def category_revenue(products: DataFrame, translation: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per translated category, folded per product before the join."""
    per_product = items.groupBy("product_id").agg(F.sum(to_cents("price")).alias("cents"))
    return (per_product.join(products, "product_id").join(translation, "product_category_name")
            .groupBy("product_category_name_english")
            .agg(F.sum("cents").alias("cents"))
            .select("product_category_name_english", "cents",
                    from_cents("cents").alias("total_revenue")))


# --- months -----------------------------------------------------------------

def monthly_revenue(facts: DataFrame, since: Column | None = None) -> DataFrame:
    """Orders, revenue, review, status counts and on-time share per month.

    Sums and shares run over payment rows repeated per review row.
    """
    paid = _paid_orders(facts)
    if since is not None:
        paid = paid.where(F.col("purchased_at") >= since)
    rows = F.col("payment_installments") * _review_rows()
    on_time = F.col("delivered_at") <= F.col("estimated_delivery_at")
    months = paid.groupBy("purchase_month").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.col("total_payment_cents") * _review_rows()).alias("cents"),
        F.sum(rows).alias("rows"),
        F.sum(F.col("review_sum") * F.col("payment_installments")).alias("review_total"),
        F.sum(F.col("review_count") * F.col("payment_installments")).alias("review_n"),
        F.count_if(F.col("order_status") == "delivered").alias("delivered_count"),
        F.count_if(F.col("order_status") == "canceled").alias("cancelled_count"),
        F.sum(F.when(on_time, rows).otherwise(0)).alias("on_time"))
    return months.select(
        F.col("purchase_month").alias("order_month"), "total_orders",
        from_cents("cents").alias("total_revenue"),
        ratio("cents", "rows", 2, 2).alias("avg_order_value"),
        ratio("review_total", "review_n", 2).alias("avg_review_score"),
        "delivered_count", "cancelled_count", pct("on_time", "rows", 2).alias("on_time_rate"))
