"""Checks, generic tests and profiles on edge frames."""

from pyspark.sql import functions as F

from quaymart.operators import aggregate as A
from quaymart.operators import models as L
from quaymart.operators import quality as Q
from quaymart.operators.filters import facets


def test_a_broken_check_does_not_stop_the_rest(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 3.0)], "id bigint, amount double")
    got = {r["check_name"]: r for r in Q.run_checks({"t": df}, [
        Q.Check("rows", "t", F.count(F.lit(1)), 2),
        Q.Check("negative", "t", F.count_if(F.col("amount") < 0), 0),
        Q.Check("bad column", "t", F.count("nope"), 0),
        Q.Check("bad table", "u", F.count(F.lit(1)), 0)]).collect()}
    assert got["rows"]["status"] == "PASS" and got["negative"]["status"] == "FAIL"
    assert got["negative"]["value"] == 1
    assert got["bad column"]["status"] == got["bad table"]["status"] == "ERROR"
    totals = Q.check_totals(spark.createDataFrame([(g["status"],) for g in got.values()],
                                                  "status string")).first()
    assert tuple(totals) == (1, 3)


def test_generic_tests(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", None), (None, None, 9), (None, "z", 9)],
                               "k int, s string, ref int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in Q.not_unique(df, "k").collect()] == [(1, 2)]
    assert Q.is_null(df, "k").count() == 2
    assert Q.is_null(df, "k", where=F.col("s") == "z").count() == 1
    assert [tuple(r) for r in Q.not_accepted(df, "s", ["a", "b"]).collect()] == [("z", 1)]
    assert [tuple(r) for r in Q.orphans(df, "ref", parent, "id").collect()] == [(9, 2)]
    got = {r["test_name"]: r["passed"] for r in Q.run_tests({
        "u": Q.not_unique(df, "k"), "n": Q.is_null(df, "s", F.col("k") == 1)}).collect()}
    assert got == {"u": False, "n": True}


def test_null_share(spark):
    df = spark.createDataFrame([(None,)] * 1 + [(1,)] * 19, "x int")
    assert Q.null_share(df, "x", 5).first()["status"] == "OK"
    assert Q.null_share(df, "x", 4.9).first()["status"] == "WARNING"


def test_profile_counts_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (None, "b")],
                               "x int, s string")
    got = {r["column_name"]: r for r in Q.table_profile(df).collect()}
    assert got["x"]["duplicate_rows"] == 2 and got["x"]["row_count"] == 5
    assert got["x"]["null_count"] == 1 and got["x"]["null_pct"] == 20.0
    assert (got["x"]["q25"], got["x"]["q50"], got["x"]["q75"]) == (1.0, 1.0, 1.25)
    assert got["s"]["mean_value"] is None and got["s"]["null_count"] == 1


def test_config_target_without_table_fails(spark):
    counts = spark.createDataFrame([("a", 10)], "table_name string, row_count bigint")
    text = '{"x": {"target": "a", "min_rows": 10}, "y": {"target": "none", "min_rows": 0}}'
    got = {r["job"]: r["passed"] for r in Q.config_count_check(spark, text, counts).collect()}
    assert got == {"x": True, "y": False}


def test_facets_skip_absent_filters(spark):
    df = spark.createDataFrame([("Red Ring", 5), ("bolt", 9), (None, 1)], "t string, n int")
    assert facets(df).count() == 3
    assert facets(df, isin={"t": []}, at_least={"n": None}, search={"t": ""}).count() == 3
    assert facets(df, at_least={"n": 5}, search={"t": "rING"}).count() == 1


def test_empty_run_summary_has_zero_rate(spark):
    df = spark.createDataFrame([], "s string, v double, t timestamp_ntz")
    got = A.run_summary(df, "s", "ok", "bad", "v", "t").first()
    assert got["total_runs"] == 0 and got["success_rate"] == 0.0


def test_status_pivot_fills_zero(spark):
    df = spark.createDataFrame([("p", "ok"), ("p", "ok"), ("q", "bad")], "n string, s string")
    got = {r["n"]: (r["ok"], r["bad"]) for r in A.status_pivot(df, "n", "s", ["ok", "bad"]).collect()}
    assert got == {"p": (2, 0), "q": (0, 1)}


def test_drift_bounds_are_decimal(spark):
    df = spark.createDataFrame([(0.95, 0.90), (0.95, 0.93), (0.95, 0.9301), (None, 0.91)],
                               "baseline_accuracy double, current_accuracy double")
    got = [r["status"] for r in L.drift_verdict(df).collect()]
    assert got == ["drift", "warning", "ok", "ok"]
    assert L.drift_log(L.drift_verdict(df)).count() == 2


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(1, 1)] * 2
    got = L.classification_metrics(spark.createDataFrame(pairs, "y int, p int"), "y", "p").first()
    assert got["accuracy"] == 0.7 and got["recall_0"] == 0.8333 and got["recall_1"] == 0.5
    assert got["precision"] == 0.6952 and got["recall"] == 0.7 and got["f1"] == 0.6901


def test_churn_feature_rules(spark):
    df = spark.createDataFrame([
        (1, 4, 10.0, 3, "Gold", True), (2, None, 0.0, None, None, False), (3, 2, 30.0, 30, "x", True),
        (4, 5, None, 1, "Gold", True)],
        "customer_id bigint, total_rentals bigint, total_spend double, "
        "days_since_last_payment bigint, segment string, is_active boolean")
    got = {r["customer_id"]: r for r in L.churn_features(df).collect()}
    assert sorted(got) == [1, 2, 3]    # a customer without any spend is left out
    assert got[2]["days_since_last_payment"] == 999 and got[2]["avg_spend_per_rental"] == 0.0
    assert [got[i]["is_high_value"] for i in (1, 2, 3)] == [0, 0, 1]
    assert [got[i]["is_recent"] for i in (1, 2, 3)] == [1, 0, 0]
    assert [got[i]["segment_encoded"] for i in (1, 2, 3)] == [2, 0, 0]
    assert got[1]["rental_frequency"] == 1.0 and got[2]["target"] == 0


def test_failing_check_does_not_stop_the_others(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    got = {r.check_name: r for r in Q.run_checks({"t": df}, [
        Q.Check("rows", "t", F.count(F.lit(1)), 2), Q.Check("cast", "t", F.sum(F.col("v").cast("int")), 1),
        Q.Check("column", "t", F.max("nope"), 1), Q.Check("table", "u", F.count(F.lit(1)), 1)]).collect()}
    assert {n: r.status for n, r in got.items()} == {"rows": "PASS", "cast": "ERROR", "column": "ERROR", "table": "ERROR"}
    assert got["cast"].error == "CAST_INVALID_INPUT"


def test_row_tests_share_one_aggregate(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id bigint, v string")
    out = Q.count_violations(df, {"id": F.col("id").isNull(), "v": ~F.col("v").isin("a"), "none": F.lit(False)})
    assert sorted(tuple(r) for r in out.collect()) == [("id", 1, False), ("none", 0, True), ("v", 1, False)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Expand" not in plan


def test_profile_scans_rows_not_cells(spark, monkeypatch):
    """Many values in the brackets, ties, a constant and an empty column; the rows are not multiplied by the columns."""
    from quaymart.operators import quantiles

    df = spark.range(60_000).selectExpr("id", "pmod(xxhash64(id), 1L << 30) / 3.0D AS x", "id % 3 AS t", "7 AS one", "CAST(NULL AS int) AS none", "'s' AS s")
    monkeypatch.setattr(quantiles, "ONE_TASK_VALUES", 100)
    counted = []
    whole = quantiles._running
    monkeypatch.setattr(quantiles, "_running", lambda c, *rest: counted.append(c.count()) or whole(c, *rest))
    got = {r.column_name: r for r in Q.table_profile(df).collect()}
    want = df.agg(*[F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in ("id", "x", "t", "one")]).first()
    for c in ("id", "x", "t", "one"):
        assert [got[c].q25, got[c].q50, got[c].q75] == [round(v, 4) for v in want[c]]
    assert got["none"].q50 is None and got["s"].q50 is None and got["none"].null_count == 60_000
    assert 100 < counted[0] < 1_000
