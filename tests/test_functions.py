"""Rounding, dates, text and binning on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaymart import functions as X


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_cents_are_exact(spark):
    got = one(spark, X.to_cents("x"), [(1.15,), (10.07,), (0.29,), (104949.5,), (-846.69,), (None,)],
              "x double")
    assert got == [115, 1007, 29, 10494950, -84669, None]
    got = one(spark, X.to_cents(F.col("x").cast("decimal(12,2)")), [(1.15,), (-3.01,)], "x double")
    assert got == [115, -301]


def test_ratio_rounds_true_halves_up_and_even(spark):
    rows = [(115, 2), (117, 2), (-115, 2), (1, 3), (5, 0), (None, 2), (5, None)]
    assert one(spark, X.ratio("a", "b", 2, 2), rows, "a bigint, b bigint") == [
        0.58, 0.59, -0.58, 0.0, None, None, None]
    assert one(spark, X.ratio("a", "b", 2, 2, half="even"), rows, "a bigint, b bigint") == [
        0.58, 0.58, -0.58, 0.0, None, None, None]


def test_pct_and_growth(spark):
    rows = [(1, 8), (150, 100), (0, 0), (5, 0)]
    assert one(spark, X.pct("a", "b", 1), rows, "a bigint, b bigint") == [12.5, 150.0, None, None]
    assert one(spark, X.pct_change("a", "b"), rows, "a bigint, b bigint") == [
        -87.5, 50.0, None, None]


def test_whole_days_truncate_toward_zero(spark):
    day = dt.datetime(2020, 1, 10, 12)
    rows = [(day, day + dt.timedelta(hours=h, minutes=m)) for h, m in
            ((23, 59), (24, 0), (47, 59), (-23, -59), (-24, 0), (-49, 0))] + [(day, None)]
    got = one(spark, X.whole_days("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz")
    assert got == [0, 1, 1, 0, -1, -2, None]


def test_fractional_days(spark):
    day = dt.datetime(2020, 1, 1)
    rows = [(day, day + dt.timedelta(hours=36)), (day, day - dt.timedelta(hours=6))]
    assert one(spark, X.frac_days("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz") == [1.5, -0.25]


def test_calendar_starts(spark):
    rows = [(dt.datetime(2024, 2, 29, 23, 59),), (dt.datetime(2024, 1, 1),)]
    schema = "t timestamp_ntz"
    assert one(spark, X.month_start("t"), rows, schema) == [dt.date(2024, 2, 1), dt.date(2024, 1, 1)]
    assert one(spark, X.week_start("t"), rows, schema) == [dt.date(2024, 2, 26), dt.date(2024, 1, 1)]
    assert one(spark, X.quarter_start("t"), rows, schema) == [dt.date(2024, 1, 1)] * 2
    assert one(spark, X.month_label("t"), rows, schema) == ["2024-02", "2024-01"]


def test_concat_rules(spark):
    rows = [("a", "b"), ("a", None)]
    assert one(spark, X.concat_skip_null("x", F.lit(" "), "y"), rows, "x string, y string") == [
        "a b", "a "]
    assert one(spark, F.concat("x", F.lit(" "), "y"), rows, "x string, y string") == ["a b", None]


def test_contains_ignores_case_and_null(spark):
    assert one(spark, X.contains_ci("x", "RiNg"), [("Earring",), ("bolt",), (None,)], "x string") == [
        True, False, False]


def test_distinct_list(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, x string")
    got = {r[0]: r[1] for r in df.groupBy("k").agg(X.distinct_list("x")).collect()}
    assert got == {1: "a, b", 2: None}


@pytest.mark.parametrize("x,want", [(0.0, None), (-1.0, None), (0.01, "Bronze"), (50.0, "Bronze"),
                                    (50.01, "Silver"), (100.0, "Silver"), (150.0, "Gold"),
                                    (150.01, "Platinum"), (None, None)])
def test_right_closed_bins(spark, x, want):
    assert one(spark, X.cut_right_closed("x"), [(x,)], "x double") == [want]


@pytest.mark.parametrize("x,want", [(99.99, "Bronze"), (100.0, "Silver"), (200.0, "Gold"),
                                    (499.99, "Gold"), (500.0, "Platinum"), (None, "Bronze")])
def test_floor_segments(spark, x, want):
    assert one(spark, X.floor_segment("x"), [(x,)], "x double") == [want]


@pytest.mark.parametrize("x,want", [(0.99, "Budget"), (1.0, "Standard"), (2.99, "Standard"),
                                    (3.0, "Premium"), (None, "Premium")])
def test_price_tiers(spark, x, want):
    assert one(spark, X.price_tier("x"), [(x,)], "x double") == [want]


def test_ordinal_default(spark):
    rows = [("Bronze",), ("Platinum",), ("Tin",), (None,)]
    assert one(spark, X.ordinal("x"), rows, "x string") == [0, 3, 0, 0]
