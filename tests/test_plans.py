"""Physical plans: pruned and filtered scans, no all-pairs joins, no row funnels."""

import pytest
from compare import plan_of

from quaymart.plans import registry

registry.load_all()
# Queries that build their plan without training or writing tables first.
LAZY = ("customer_ltv", "customer_ltv_raw", "order_metrics", "order_metrics_raw",
        "seller_performance", "seller_summary", "product_analytics", "monthly_revenue",
        "customer_lifetime", "customer_summary", "film_value_score", "category_popularity",
        "monthly_trend", "monthly_filled", "weekly_activity", "review_improvement",
        "group_stats_rows", "top_category_quarterly", "rental_stats", "dq_relationship",
        "kpi_row", "payment_ranks", "spend_percentile", "seller_quartiles")


@pytest.mark.parametrize("name", LAZY)
def test_no_all_pairs_join_and_no_row_multiplying(spark, small, name):
    text = plan_of(registry.QUERIES[name](spark, small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
        assert bad not in text, bad


def test_filter_and_columns_reach_the_scan(spark, small):
    text = plan_of(registry.QUERIES["top_priced"](spark, small))
    assert "GreaterThan(p_retailprice" in text and "TakeOrderedAndProject" in text
    assert "p_type" not in text
    text = plan_of(registry.QUERIES["late_in_month"](spark, small))
    assert "PartitionFilters: [isnotnull(purchase_month" in text and "EqualTo(is_late,true)" in text
    text = plan_of(registry.QUERIES["state_top_sellers"](spark, small))
    assert "EqualTo(seller_state" in text and "TakeOrderedAndProject" in text


def test_monthly_revenue_reads_lines_once(spark, small):
    text = plan_of(registry.QUERIES["monthly_revenue"](spark, small))
    assert text.count("lineitem.parquet") == 1 and text.count("orders.parquet") == 1


def test_top_per_state_limits_before_the_shuffle(spark, small):
    text = plan_of(registry.QUERIES["top3_per_state"](spark, small))
    assert text.count("WindowGroupLimit") >= 2  # partial and final


def test_tables_fail_loudly(spark, small):
    from quaymart.sources import Tables

    with pytest.raises(AttributeError):
        Tables(spark, small).nothing
