"""Role frames: the driver tables seen as marketplace and rental tables.

The plans are written against marketplace column names (``order_id``,
``payment_value`` ...). This module maps real columns, or fixed expressions of
them, to those roles; a user with marketplace tables passes them directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.functions import distinct_list
from quaymart.sources.tables import Tables

# Promised delivery time: chosen so that late orders are the smaller class.
PROMISE_DAYS = 1500

# Order status codes of the driver tables and their role names.
STATUS_NAMES = {"F": "delivered", "O": "shipped", "P": "canceled"}


def paid_cents():
    """Line amount after discount in whole cents, by integer arithmetic."""
    price = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    keep = 100 - F.floor(F.col("l_discount") * 100 + 0.5)
    return F.call_function("div", price * keep + 50, F.lit(100).cast("bigint"))


def paid():
    return paid_cents() / 100.0


class Marketplace:
    """Orders, payments, items, reviews, sellers and products as role frames."""

    def __init__(self, tables: Tables, promise_days: int = PROMISE_DAYS):
        self.t = tables
        self.promise_days = promise_days

    def _places(self, frame: DataFrame, nation_key: str) -> DataFrame:
        nation = self.t.nation.join(self.t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return frame.join(nation, F.col(nation_key) == F.col("n_nationkey"))

    @property
    def customers(self) -> DataFrame:
        return self._places(self.t.customer, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.col("r_name").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"))

    @property
    def sellers(self) -> DataFrame:
        return self._places(self.t.supplier, "s_nationkey").select(
            F.col("s_suppkey").alias("seller_id"), F.col("r_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"))

    def _order_columns(self) -> list:
        status = F.lit(None).cast("string")
        for code, name in STATUS_NAMES.items():
            status = F.when(F.col("o_orderstatus") == code, name).otherwise(status)
        promised = F.col("o_orderdate") + F.make_dt_interval(F.lit(self.promise_days))
        return [
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.col("o_orderdate").alias("order_approved_at"),
            promised.alias("order_estimated_delivery_date"),
        ]

    @property
    def orders_undated(self) -> DataFrame:
        """Orders without delivery dates: no pass over the line table."""
        return self.t.orders.select(*self._order_columns())

    @property
    def orders(self) -> DataFrame:
        shipped = self.t.lineitem.groupBy(F.col("l_orderkey").alias("shipped_order")).agg(
            F.min("l_shipdate").alias("order_delivered_carrier_date"),
            F.max("l_shipdate").alias("order_delivered_customer_date"))
        return (self.t.orders.join(shipped, F.col("o_orderkey") == F.col("shipped_order"), "left")
                .select(*self._order_columns(), "order_delivered_carrier_date",
                        "order_delivered_customer_date"))

    @property
    def order_items(self) -> DataFrame:
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"), F.col("l_extendedprice").alias("price"))

    @property
    def order_payments(self) -> DataFrame:
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"), paid().alias("payment_value"))

    @property
    def order_reviews(self) -> DataFrame:
        return self.t.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"))

    @property
    def products(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"),
            F.col("p_size").alias("product_weight_g"))

    @property
    def category_translation(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english")).distinct()

    def order_facts(self, bought_from: str | None = None, bought_to: str | None = None) -> DataFrame:
        """All per-order facts in one pass over the line table.

        With a purchase range only lines of orders in it are aggregated: the
        orders are filtered at their scan and cut the lines by a semi join.

        Payments, items and shipping dates all live in the line table here, so
        one aggregate replaces three scans and three shuffles by order. The
        result has the columns of ``operators.marts.order_facts``.
        """
        from quaymart.operators.marts import stg_orders

        orders, lineitem = self.t.orders, self.t.lineitem
        if bought_from is not None:
            orders = orders.where(F.col("o_orderdate") >= F.lit(bought_from).cast("timestamp_ntz"))
        if bought_to is not None:
            orders = orders.where(F.col("o_orderdate") < F.lit(bought_to).cast("timestamp_ntz"))
        if bought_from is not None or bought_to is not None:
            lineitem = lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey")),
                                     "l_orderkey", "left_semi")
        lines = lineitem.groupBy(F.col("l_orderkey").alias("line_order")).agg(
            F.min("l_shipdate").alias("order_delivered_carrier_date"),
            F.max("l_shipdate").alias("order_delivered_customer_date"),
            F.sum(paid_cents()).alias("total_payment_cents"),
            F.count(F.lit(1)).alias("payment_installments"),
            distinct_list("l_returnflag").alias("payment_types"),
            F.count("l_partkey").alias("product_count"))
        joined = orders.join(lines, F.col("o_orderkey") == F.col("line_order"), "left")
        score = F.substring("o_orderpriority", 1, 1).cast("bigint")
        extra = ["total_payment_cents", "payment_installments", "payment_types", "product_count"]
        return stg_orders(
            joined.select(*self._order_columns(), "order_delivered_carrier_date",
                          "order_delivered_customer_date", *extra,
                          score.alias("review_sum"),
                          F.when(score.isNotNull(), 1).cast("bigint").alias("review_count")),
            keep=[*extra, "review_sum", "review_count"])


class Rentals:
    """Film, customer, rental and payment roles over the driver tables."""

    def __init__(self, tables: Tables):
        self.t = tables

    @property
    def customer(self) -> DataFrame:
        return self.t.customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"), F.lower("c_name").alias("email"),
            F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("active"))

    @property
    def film(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"),
            F.col("p_brand").alias("rating"), F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("rental_rate"),
            F.col("p_size").alias("rental_duration"))

    @property
    def rental(self) -> DataFrame:
        """One rental per order; its payments are the order's lines."""
        return self.t.orders.select(
            F.col("o_orderkey").alias("rental_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("rental_date"))

    @property
    def payment(self) -> DataFrame:
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("rental_id"), F.col("l_partkey").alias("film_id"),
            F.col("l_shipdate").alias("payment_date"), paid().alias("amount"))

    @property
    def item_rental(self) -> DataFrame:
        """One rental per line: start = order date, open unless the line is closed."""
        lines = self.t.lineitem.select(
            "l_orderkey", "l_linenumber", F.col("l_partkey").alias("film_id"),
            F.col("l_suppkey").alias("store_id"),
            F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("return_date"))
        return lines.join(self.t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_orderkey").alias("rental_id"), F.col("l_linenumber").alias("line_no"),
            F.col("o_custkey").alias("customer_id"), "film_id", "store_id",
            F.col("o_orderdate").alias("rental_date"), "return_date")

    @property
    def customer_payment(self) -> DataFrame:
        """Payments with their customer (the payment table of the rental schema)."""
        return self.payment.join(self.rental.select("rental_id", "customer_id"), "rental_id")
