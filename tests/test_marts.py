"""Marts on hand-made frames with fan-out, missing sides and duplicate places."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaymart.operators import marts as M
from quaymart.operators import timeseries as S
from quaymart.operators import windows as W

D = dt.datetime


@pytest.fixture(scope="module")
def shop(spark):
    make = spark.createDataFrame
    orders = make([
        (1, 10, "delivered", D(2017, 1, 5), D(2017, 1, 9, 23), D(2017, 1, 8)),
        (2, 10, "canceled", D(2017, 1, 20), None, D(2017, 1, 30)),
        (3, 11, "delivered", D(2017, 3, 2), D(2017, 3, 3, 1, 59), D(2017, 3, 20)),
        (4, 12, "delivered", D(2017, 3, 9), None, D(2017, 3, 20)),
        (5, 13, "delivered", D(2017, 3, 9), D(2017, 3, 10), D(2017, 3, 20)),
    ], "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp "
       "timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
       "order_estimated_delivery_date timestamp_ntz")
    orders = orders.withColumns({
        "order_approved_at": F.col("order_purchase_timestamp"),
        "order_delivered_carrier_date": F.col("order_purchase_timestamp")})
    payments = make([
        (1, 1, "card", 60.00), (1, 2, "voucher", 40.00), (2, 1, "card", 10.00),
        (3, 1, "card", 300.00), (4, 1, "card", 5.55),
    ], "order_id bigint, payment_sequential int, payment_type string, payment_value double")
    reviews = make([(1, 5), (1, 2), (3, 4)], "order_id bigint, review_score int")
    items = make([
        (1, 100, 7, 30.0), (1, 101, 8, 70.0), (2, 100, 7, 10.0), (3, 102, 7, 300.0),
        (9, 100, 7, 1.0),
    ], "order_id bigint, product_id bigint, seller_id bigint, price double")
    customers = make([
        (10, "u1", "x", "S1", "0"), (11, "u1", "y", "S2", "0"), (12, "u2", "x", "S1", "0"),
        (13, "u3", "x", "S1", "0"),
    ], "customer_id bigint, customer_unique_id string, customer_city string, "
       "customer_state string, customer_zip_code_prefix string")
    sellers = make([(7, "c", "S1"), (8, "c", "S2"), (9, "c", "S3")],
                   "seller_id bigint, seller_city string, seller_state string")
    products = make([(100, "a", 5), (101, "b", None), (102, "zz", 9)],
                    "product_id bigint, product_category_name string, product_weight_g int")
    names = make([("a", "A"), ("b", "B")],
                 "product_category_name string, product_category_name_english string")
    facts = M.order_facts(orders, payments, reviews, items)
    return dict(orders=orders, payments=payments, reviews=reviews, items=items, facts=facts,
                customers=customers, sellers=sellers, products=products, names=names)


def as_of():
    return F.lit(D(2017, 4, 1)).cast("timestamp_ntz")


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_staging(shop):
    got = rows(M.stg_orders(shop["orders"]), "order_id")
    assert got[1]["is_late"] is True and got[3]["is_late"] is False
    assert got[2]["is_late"] is None and got[4]["is_late"] is None
    assert [got[i]["delivery_days"] for i in (1, 3, 4)] == [4, 1, None]
    assert got[1]["purchase_month"] == dt.date(2017, 1, 1)
    paid = rows(M.stg_order_payments(shop["payments"]), "order_id")
    assert paid[1]["payment_types"] == "card, voucher" and paid[1]["payment_installments"] == 2


def test_ltv_clean_keeps_best_place(shop):
    got = rows(M.customer_ltv(shop["facts"], shop["customers"], as_of()), "customer_unique_id")
    assert set(got) == {"u1", "u2"}  # u3 has no payment
    best = got["u1"]
    assert (best["customer_city"], best["total_spent"], best["total_orders"]) == ("y", 300.0, 1)
    assert best["value_segment"] == "Gold" and best["is_churned"] == 1 and best["rn"] == 1
    assert best["days_since_last_order"] == 30 and best["avg_review_score"] == 4.0
    assert got["u2"]["avg_review_score"] is None and got["u2"]["value_segment"] == "Bronze"


def test_ltv_raw_repeats_payments_per_review(shop):
    got = {(r["customer_unique_id"], r["customer_city"]): r for r in
           M.customer_ltv_raw(shop["facts"], shop["customers"], as_of()).collect()}
    r = got["u1", "x"]  # order 1: 2 payments x 2 reviews, order 2: 1 x 1
    assert r["total_spent"] == 210.0 and r["total_orders"] == 2
    assert r["delivered_orders"] == 4 and r["cancelled_orders"] == 0
    assert r["avg_review_score"] == 3.5 and r["avg_order_value"] == 105.0
    assert ("u1", "y") in got  # one row per place


def test_order_metrics(shop):
    got = rows(M.order_metrics(shop["facts"], shop["customers"]), "order_id")
    assert set(got) == {1, 3}  # 4 has no items, 5 no payment
    assert got[1]["total_payment"] == 100.0 and got[1]["review_score"] == 3.5
    assert got[1]["product_count"] == 2 and got[1]["is_late"] is True
    assert set(rows(M.order_product_metrics(shop["facts"], shop["customers"]), "order_id")) == {
        1, 3, 4}


def test_order_metrics_raw(shop):
    got = M.order_metrics_raw(shop["orders"], shop["customers"], shop["payments"],
                              shop["reviews"], shop["items"]).collect()
    assert sorted((r["order_id"], r["review_score"]) for r in got) == [(1, 2), (1, 5), (3, 4)]
    first = [r for r in got if r["order_id"] == 1][0]
    assert first["payment_value"] == 60.0 and first["order_purchase_date"] == 5
    assert first["days_late"] == 1 and first["is_late"] == 1


def test_seller_performance(shop):
    got = rows(M.seller_performance(shop["sellers"], shop["items"], shop["orders"],
                                    shop["reviews"]), "seller_id")
    assert set(got) == {7, 8}
    s = got[7]  # order 1 twice (two reviews), 2 and 3 once; order 9 does not exist
    assert (s["total_orders"], s["total_products_sold"], s["unique_products"]) == (3, 4, 2)
    assert s["total_revenue"] == 370.0 and s["avg_order_value"] == 92.5
    assert s["on_time_delivery_rate"] == 25.0 and s["active_months"] == 2
    assert s["avg_review_score"] == 3.67


def test_seller_summary_can_exceed_hundred(shop, spark):
    items = spark.createDataFrame([(3, 1, 7, 1.0), (3, 2, 7, 2.0)],
                                  "order_id bigint, product_id bigint, seller_id bigint, price double")
    raw = M.seller_summary(shop["sellers"], items, shop["facts"]).first()
    fixed = M.seller_summary(shop["sellers"], items, shop["facts"], corrected=True).first()
    assert (raw["total_revenue"], raw["on_time_rate"]) == (600.0, 200.0)
    assert (fixed["total_revenue"], fixed["on_time_rate"]) == (3.0, 100.0)


def test_untranslated_category_drops(shop):
    got = rows(M.product_analytics(shop["products"], shop["names"], shop["items"], shop["orders"],
                                   shop["reviews"]), "product_category_name_english")
    assert set(got) == {"A", "B"}
    assert got["A"]["total_orders"] == 2 and got["A"]["return_rate"] == 33.33
    assert got["A"]["total_revenue"] == 70.0 and got["B"]["avg_product_weight_g"] is None


def test_monthly_revenue_and_gaps(shop, spark):
    months = M.monthly_revenue(shop["facts"])
    got = rows(months, "order_month")
    jan = got[dt.date(2017, 1, 1)]
    assert jan["total_orders"] == 2 and jan["total_revenue"] == 210.0 and jan["on_time_rate"] == 0.0
    gaps = S.month_gaps(S.month_range(spark, "2017-01-01", "2017-04-01"), months, 2)
    assert [r["status"] for r in gaps.orderBy("expected_month").collect()] == [
        "NORMAL", "MISSING", "NORMAL", "MISSING"]


def test_fill_months_keeps_empty_ones(spark):
    df = spark.createDataFrame([(D(2020, 1, 31), 2.0), (D(2020, 4, 1), 4.0)],
                               "payment_date timestamp_ntz, amount double")
    got = sorted(tuple(r) for r in S.fill_months(df).collect())
    assert got == [(dt.date(2020, 1, 31), 2.0, 1, 2.0), (dt.date(2020, 2, 29), 0.0, 0, None),
                   (dt.date(2020, 3, 31), 0.0, 0, None), (dt.date(2020, 4, 30), 4.0, 1, 4.0)]
    growth = {r["payment_date"]: r for r in S.growth_and_peak(S.fill_months(df)).collect()}
    assert growth[dt.date(2020, 1, 31)]["mom_growth_pct"] is None
    assert growth[dt.date(2020, 3, 31)]["mom_growth_pct"] is None  # zero base
    assert growth[dt.date(2020, 4, 30)]["is_peak_month"] is True
    assert growth[dt.date(2020, 2, 29)]["mom_growth_pct"] == -100.0


def test_revenue_mom_first_row_is_flat(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 10.0), (dt.date(2020, 2, 1), 15.0),
                                (dt.date(2020, 3, 1), 15.0), (dt.date(2020, 4, 1), 3.0)],
                               "order_month date, total_revenue double")
    got = [r["trend"] for r in S.revenue_mom(df).orderBy("order_month").collect()]
    assert got == ["Flat", "Growth", "Flat", "Decline"]


def test_review_improvement_needs_two_orders(spark):
    orders = spark.createDataFrame([
        (1, 1, "delivered", D(2020, 1, 1)), (2, 1, "delivered", D(2020, 1, 1)),
        (3, 2, "delivered", D(2020, 1, 1)), (4, 1, "shipped", D(2021, 1, 1))],
        "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz")
    reviews = spark.createDataFrame([(1, 2), (2, 4), (3, 5), (4, 5)],
                                    "order_id bigint, review_score int")
    customers = spark.createDataFrame([(1, "a"), (2, "b")],
                                      "customer_id bigint, customer_unique_id string")
    got = [tuple(r) for r in W.review_improvement(orders, reviews, customers).collect()]
    assert got == [("a", 2, 4, 2)]


def test_shares_sum_to_hundred(spark):
    df = spark.createDataFrame([("a", 10.0, 1000), ("b", 10.0, 1000), ("c", 20.0, 2000)],
                               "product_category_name_english string, total_revenue double, cents bigint")
    got = W.category_revenue_share(df).collect()
    assert sum(r["revenue_share_pct"] for r in got) == 100.0
    last = {r["product_category_name_english"]: r for r in got}
    assert last["a"]["cumulative_revenue"] == last["b"]["cumulative_revenue"] == 40.0  # peers
    assert last["a"]["revenue_rank"] == last["b"]["revenue_rank"] == 2
