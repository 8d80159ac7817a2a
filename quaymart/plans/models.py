"""Feature, training and scoring queries over the driver tables."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from quaymart.functions import rint_to
from quaymart.operators import marts as M
from quaymart.operators import models as L
from quaymart.operators.balance import SEED, smote, split_counts
from quaymart.operators.jobs import Outcome, append_audit, build_models, read_audit
from quaymart.plans.loading import CHAIN_ROWS, mart_models
from quaymart.plans.marts import ltv, market
from quaymart.plans.registry import query
from quaymart.plans.rentals import CLUSTER_WIDTH, clusters, rentals, summary
from quaymart.plans.twins import add_view, r_even, twin
from quaymart.session import scratch_path, stage
from quaymart.sources.files import write_table

SCORED_ON = dt.date(2001, 12, 31)
TRAINED_AT = dt.datetime(2001, 12, 31)
# A customer whose last order is older than this counts as lost.
CHURN_CUT = dt.datetime(2001, 1, 1)
# The recency of the last order decides that label, so training leaves it out.
TRAIN_LTV = tuple(c for c in L.LTV_FEATURES if c != "days_since_last_order")
# Sizes of the churn and the delay forest.
CHURN_FOREST = {"trees": 100, "depth": L.UNLIMITED}
DELAY_FOREST = {"trees": 50, "depth": 10}
NAME_CUTS = (2_500_000, 2_300_000, 0.8)
SLOW_DAYS = 1400


def churn_frame(spark, folder):
    return L.churn_features(stage(summary(rentals(spark, folder))))


def ltv_frame(spark, folder):
    lost = F.col("last_order_date") < F.lit(CHURN_CUT).cast("timestamp_ntz")
    return L.ltv_features(ltv(market(spark, folder)), lost.cast("int"))


def raw_orders(spark, folder):
    m = market(spark, folder)
    return M.order_metrics_raw(m.orders, m.customers, m.order_payments, m.order_reviews,
                               m.order_items)


def delay_frame(spark, folder):
    return L.delay_features(stage(raw_orders(spark, folder).select(
        "order_id", "delivery_days_estimated", "payment_value", "product_count", "is_late")))


def _r6(x):
    return f"round_even(({x}) * 1e6, 0) / 1e6"


add_view("v_churn", "v_summary", """SELECT customer_id, total_rentals, total_spend,
    days_since_last_payment, coalesce(total_spend / nullif(total_rentals, 0), 0)
      AS avg_spend_per_rental, ln(1 + total_spend) AS log_total_spend,
    ln(1 + total_rentals) AS log_total_rentals, segment_encoded,
    CAST(CASE WHEN total_spend > quantile_cont(total_spend, 0.5) OVER () THEN 1 ELSE 0 END
      AS BIGINT) AS is_high_value,
    CAST(CASE WHEN days_since_last_payment < 30 THEN 1 ELSE 0 END AS BIGINT) AS is_recent,
    round_even(total_rentals / (days_since_last_payment + 1) * 1e4, 0) / 1e4 AS rental_frequency,
    target
FROM (SELECT customer_id, CAST(coalesce(total_rentals, 0) AS DOUBLE) AS total_rentals,
    coalesce(total_spend, 0) AS total_spend,
    CAST(coalesce(days_since_last_payment, 999) AS DOUBLE) AS days_since_last_payment,
    CAST(CASE segment WHEN 'Silver' THEN 1 WHEN 'Gold' THEN 2 WHEN 'Platinum' THEN 3 ELSE 0 END
      AS BIGINT) AS segment_encoded, CAST(is_active AS BIGINT) AS target FROM v_summary
  WHERE total_spend IS NOT NULL)""")


@query("churn_features", twin("v_churn", f"""SELECT * REPLACE (
    {_r6('log_total_spend')} AS log_total_spend, {_r6('log_total_rentals')} AS log_total_rentals)
FROM v_churn"""))
def q_churn_features(spark, folder):
    return churn_frame(spark, folder).withColumns({
        c: rint_to(F.col(c), 6) for c in ("log_total_spend", "log_total_rentals")})


@query("ltv_features", twin("v_ltv", f"""
SELECT customer_unique_id, total_spent, avg_order_value,
    CAST(days_since_last_order AS DOUBLE) AS days_since_last_order,
    coalesce(avg_review_score, 3.0) AS avg_review_score,
    {r_even('cancelled_orders', 'CASE WHEN total_orders = 0 THEN 1 ELSE total_orders END', 4, 0)}
      AS cancel_rate, {_r6('ln(1 + total_spent)')} AS log_total_spent,
    CAST(last_order_date < TIMESTAMP '{CHURN_CUT}' AS BIGINT) AS target FROM v_ltv"""))
def q_ltv_features(spark, folder):
    return ltv_frame(spark, folder).withColumn("log_total_spent",
                                               rint_to(F.col("log_total_spent"), 6))


add_view("v_delay", "m_orders m_payments m_items m_reviews", f"""SELECT * FROM (SELECT DISTINCT o.order_id,
      CAST(date_sub('day', o.purchased_at, o.estimated_delivery_at) AS DOUBLE) AS days,
      CAST(p.cents AS DOUBLE) / 1e2 AS payment_value, p.payment_type, r.review_score,
      CAST(i.product_count AS DOUBLE) AS product_count,
      CAST(CASE WHEN o.delivered_at > o.estimated_delivery_at THEN 1 ELSE 0 END AS BIGINT) AS target
  FROM m_orders o LEFT JOIN m_reviews r ON o.order_id = r.order_id
  JOIN m_payments p ON o.order_id = p.order_id AND p.payment_sequential = 1
  JOIN (SELECT order_id, count(*) AS product_count FROM m_items GROUP BY 1) i
    ON o.order_id = i.order_id WHERE o.order_status = 'delivered')""")


@query("delay_features", twin("v_delay", f"""
SELECT order_id, coalesce(days, quantile_cont(days, 0.5) OVER ()) AS delivery_days_estimated,
    payment_value, product_count, {_r6('ln(1 + payment_value)')} AS log_payment_value,
    CAST(CASE WHEN payment_value > quantile_cont(payment_value, 0.5) OVER () THEN 1 ELSE 0 END
      AS BIGINT) AS is_expensive, target
FROM v_delay"""))
def q_delay_features(spark, folder):
    return delay_frame(spark, folder).withColumn("log_payment_value",
                                                 rint_to(F.col("log_payment_value"), 6))


_STATS = " UNION ALL ".join(f"""SELECT '{c}' AS feature,
    round_even(avg(CAST({c} AS DOUBLE)) * 1e4, 0) / 1e4 AS mean,
    round_even(stddev_pop(CAST({c} AS DOUBLE)) * 1e4, 0) / 1e4 AS std,
    CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high,
    round_even(corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE)) * 1e4, 0) / 1e4 AS corr
    FROM v_churn""" for c in L.CHURN_FEATURES if not c.startswith("log_"))


@query("feature_stats", twin("v_churn", _STATS))
def q_feature_stats(spark, folder):
    return L.feature_stats(churn_frame(spark, folder),
                           [c for c in L.CHURN_FEATURES if not c.startswith("log_")])


_Z = L.CLUSTER_FEATURES


@query("zscores", twin("v_churn", "SELECT customer_id, " + ", ".join(
    f"coalesce({_r6(f'({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0)')}, 0) AS {c}"
    for c in _Z) + " FROM v_churn"))
def q_zscores(spark, folder):
    scored = L.zscores(churn_frame(spark, folder), "customer_id", _Z)
    return scored.select("customer_id", *[rint_to(F.col(c), 6).alias(c) for c in _Z])


def in_train_sql(key):
    """``balance.in_train`` as DuckDB SQL."""
    return f"CAST(('0x' || substr(md5('{SEED}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 80"


@query("stratified_split", twin("v_delay", f"""SELECT target,
    count(CASE WHEN {in_train_sql('order_id')} THEN 1 END) AS train_rows,
    count(CASE WHEN NOT ({in_train_sql('order_id')}) THEN 1 END) AS test_rows FROM v_delay GROUP BY target"""))
def q_stratified_split(spark, folder):
    """Rows per class and side of the hash split."""
    return split_counts(delay_frame(spark, folder), "order_id", "target")


def rule_predictions(spark, folder):
    """A fixed rule as predictor: late if the delivery took longer than a bound."""
    m = market(spark, folder)
    return M.order_metrics(m.order_facts(), m.customers).select(
        "order_id", "purchased_at", F.col("is_late").cast("int").alias("label"),
        F.when(F.col("delivery_days") > SLOW_DAYS - F.coalesce(
            F.col("review_score"), F.lit(0.0)) * 60, 1).otherwise(0).alias("prediction"))


add_view("v_rule", "v_order_metrics", f"""SELECT order_id, purchased_at,
    CAST(is_late AS INTEGER) AS label,
    CASE WHEN delivery_days > {SLOW_DAYS} - coalesce(review_score, 0) * 60 THEN 1 ELSE 0 END
      AS prediction FROM v_order_metrics""")


def _r4(x):
    return f"round_even(({x}) * 1e4, 0) / 1e4"


@query("confusion_metrics", twin("v_rule", f"""
SELECT {_r4('(c00 + c11) / n')} AS accuracy,
    {_r4('(coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * n0 + coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * n1) / n')} AS f1,
    {_r4('(p0 * n0 + p1 * n1) / n')} AS precision, {_r4('(r0 * n0 + r1 * n1) / n')} AS recall,
    {_r4('r0')} AS recall_0, {_r4('r1')} AS recall_1
FROM (SELECT *, c00 / (c00 + c10) AS p0, c11 / (c11 + c01) AS p1, c00 / n0 AS r0, c11 / n1 AS r1
  FROM (SELECT *, c00 + c01 AS n0, c10 + c11 AS n1, c00 + c01 + c10 + c11 AS n FROM (
    SELECT CAST(count(CASE WHEN label = 0 AND prediction = 0 THEN 1 END) AS DOUBLE) AS c00,
      CAST(count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) AS DOUBLE) AS c01,
      CAST(count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) AS DOUBLE) AS c10,
      CAST(count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS DOUBLE) AS c11
    FROM v_rule)))"""))
def q_confusion_metrics(spark, folder):
    return L.classification_metrics(rule_predictions(spark, folder), "label", "prediction")


@query("confusion_matrix", twin("v_rule", """SELECT CAST(label AS BIGINT) AS label,
    CAST(prediction AS BIGINT) AS prediction, count(*) AS n FROM v_rule GROUP BY 1, 2"""))
def q_confusion_matrix(spark, folder):
    return L.confusion(rule_predictions(spark, folder), "label", "prediction")


_VERDICTS = f"""
SELECT month, CAST(b AS DOUBLE) AS baseline_accuracy, CAST(c AS DOUBLE) AS current_accuracy,
    CAST(b - c AS DOUBLE) AS delta,
    CASE WHEN b - c >= 0.05 THEN 'drift' WHEN b - c >= 0.02 THEN 'warning' ELSE 'ok' END AS status,
    b - c >= 0.05 AS drift_detected, b - c < 0.05 AND b - c >= 0.02 AS warning_only,
    CASE WHEN b - c >= 0.05 THEN 'retrain: ' WHEN b - c >= 0.02 THEN 'watch: ' ELSE 'stable: ' END
      || CAST(CAST((b - c) * 100 AS DECIMAL(6,1)) AS VARCHAR) || ' points below '
      || CAST(b AS VARCHAR) || ' at ' || CAST(c AS VARCHAR) AS message
FROM (SELECT month, CAST(c AS DECIMAL(6,4)) AS c, CAST(b AS DECIMAL(6,4)) AS b FROM (
  SELECT CAST(date_trunc('month', purchased_at) AS DATE) AS month,
    {_r4('count(CASE WHEN label = prediction THEN 1 END) / CAST(count(*) AS DOUBLE)')} AS c
  FROM v_rule GROUP BY 1), (SELECT
    {_r4('count(CASE WHEN label = prediction THEN 1 END) / CAST(count(*) AS DOUBLE)')} AS b
  FROM v_rule))"""


@query("drift_verdict", twin("v_rule", _VERDICTS))
def q_drift_verdict(spark, folder):
    """Accuracy of each month against the accuracy over all months."""
    rows = rule_predictions(spark, folder)
    hit = F.count_if(F.col("label") == F.col("prediction"))
    by_month = rows.groupBy(M.month_start("purchased_at").alias("month")).agg(
        hit.alias("hit"), F.count(F.lit(1)).alias("n"))
    baseline = rows.agg(rint_to(hit / F.count(F.lit(1)).cast("double"), 4)).scalar()
    return L.drift_verdict(by_month.select(
        "month", baseline.alias("baseline_accuracy"),
        rint_to(F.col("hit") / F.col("n").cast("double"), 4).alias("current_accuracy")))


@query("drift_log", twin("v_rule", f"SELECT * FROM ({_VERDICTS}) WHERE status <> 'ok'"))
def q_drift_log(spark, folder):
    return L.drift_log(q_drift_verdict(spark, folder))


# Three checks, each of the orders of one year.
CHECKED_AT = {dt.datetime(y, 12, 31, 6): y for y in (1996, 1998, 2000)}
_YEAR_ACCURACY = f"""SELECT year(purchased_at) AS y, CAST({_r4('count(CASE WHEN label = prediction THEN 1 END) / CAST(count(*) AS DOUBLE)')}
    AS DECIMAL(6,4)) AS c FROM v_rule WHERE year(purchased_at) IN ({', '.join(map(str, CHECKED_AT.values()))}) GROUP BY 1"""


@query("drift_runs", twin("v_rule", f"""
SELECT make_timestamp(y, 12, 31, 6, 0, 0) AS checked_at, CAST(b AS DOUBLE) AS baseline_accuracy, CAST(c AS DOUBLE) AS current_accuracy,
    CAST(b - c AS DOUBLE) AS delta, CASE WHEN b - c >= 0.05 THEN 'drift' ELSE 'warning' END AS status,
    CASE WHEN b - c >= 0.05 THEN 'retrain: ' ELSE 'watch: ' END || CAST(CAST((b - c) * 100 AS DECIMAL(6,1)) AS VARCHAR) || ' points below '
      || CAST(b AS VARCHAR) || ' at ' || CAST(c AS VARCHAR) AS message
FROM (SELECT y, c, CASE WHEN y = min(y) OVER () THEN CAST({L.FIRST_BASELINE} AS DECIMAL(6,4)) ELSE first_value(c) OVER (ORDER BY y) END AS b
  FROM ({_YEAR_ACCURACY})) WHERE b - c >= 0.02"""))
def q_drift_runs(spark, folder):
    """The log after three checks: the first sets the baseline that the others are held against."""
    rows = rule_predictions(spark, folder)
    hit = F.count_if(F.col("label") == F.col("prediction"))
    by_year = rows.groupBy(F.year("purchased_at").alias("y")).agg(rint_to(hit / F.count(F.lit(1)).cast("double"), 4).alias("accuracy"))
    accuracy = {r["y"]: r["accuracy"] for r in by_year.where(F.col("y").isin(*CHECKED_AT.values())).collect()}
    monitor = L.DriftMonitor(spark, scratch_path(spark, "drift"))
    for at, year in CHECKED_AT.items():
        monitor.check(accuracy[year], at)
    return monitor.log()


@query("smote_balance", twin("v_ltv", """SELECT target, false AS synthetic, n FROM sides
UNION ALL SELECT target, true, (SELECT max(n) FROM sides) - n FROM sides
WHERE n > 1 AND n < (SELECT max(n) FROM sides)""", sides=f"""SELECT target, count(*) AS n FROM (
    SELECT CAST(last_order_date < TIMESTAMP '{CHURN_CUT}' AS BIGINT) AS target FROM v_ltv
    WHERE {in_train_sql('customer_unique_id')}) GROUP BY 1"""))
def q_smote_balance(spark, folder):
    """Rows per class and origin after balancing the whole training side."""
    train, _ = L.split(ltv_frame(spark, folder), "customer_unique_id")
    made = smote(train, "customer_unique_id", TRAIN_LTV, "target")
    return made.groupBy("target", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("logistic_coefficients")
def q_logistic_coefficients(spark, folder):
    data = stage(churn_frame(spark, folder))
    train, _ = L.split(data, "customer_id")
    model = L.fit_logistic(train, L.CHURN_FEATURES)
    return spark.createDataFrame(L.coefficients(model, L.CHURN_FEATURES),
                                 "feature string, coefficient double")


@query("forest_importances")
def q_forest_importances(spark, folder):
    data = stage(delay_frame(spark, folder))
    train, _ = L.split(data, "order_id")
    model = L.fit_balanced_forest(train, "order_id", L.DELAY_FEATURES, **DELAY_FOREST)
    return spark.createDataFrame(L.importances(model, L.DELAY_FEATURES),
                                 "feature string, importance double")


@query("grid_search")
def q_grid_search(spark, folder):
    """The full grid by 5-fold cross validation on the training side; the best setting's F1 on the test side."""
    train, test = L.split(stage(churn_frame(spark, folder)), "customer_id")
    best, scores = L.grid_search(stage(train), "customer_id", L.CHURN_FEATURES)
    held = L.positive_f1(best.transform(test), "target", "prediction").first()[0]
    return scores.withColumn("best_on_test", F.lit(held).cast("double"))


@query("cross_scores")
def q_cross_scores(spark, folder):
    data = stage(ltv_frame(spark, folder))
    scores = L.cross_scores(data, "customer_unique_id", TRAIN_LTV, 5, **CHURN_FOREST)
    return scores.agg(F.count(F.lit(1)).alias("folds"), F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"),
                      F.avg("f1_positive").alias("f1_positive_mean"), F.stddev_pop("f1_positive").alias("f1_positive_std"))


@query("variant_comparison")
def q_variant_comparison(spark, folder):
    data = stage(ltv_frame(spark, folder))
    return L.compare_variants(data, "customer_unique_id", TRAIN_LTV, **CHURN_FOREST)


def _churn_model(data):
    train, _ = L.split(data, "customer_unique_id")
    return L.fit_balanced_forest(train, "customer_unique_id", TRAIN_LTV, **CHURN_FOREST)


@query("churn_scores")
def q_churn_scores(spark, folder):
    """Every customer scored by a model that was stored and loaded again."""
    data = stage(ltv_frame(spark, folder))
    path = scratch_path(spark, "models")
    L.save_model(_churn_model(data), path, "churn", TRAIN_LTV, data.count(), TRAINED_AT)
    return L.score(L.load_model(path, "churn"), data, "customer_unique_id", SCORED_ON)


@query("delay_scores")
def q_delay_scores(spark, folder):
    data = stage(delay_frame(spark, folder))
    train, _ = L.split(data, "order_id")
    model = L.fit_balanced_forest(train, "order_id", L.DELAY_FEATURES, **DELAY_FOREST)
    return L.score(model, data, "order_id", SCORED_ON)


@query("model_metadata", twin("v_ltv", f"""SELECT 'churn' AS model_name, '{TRAINED_AT:%Y%m%d_%H%M%S}' AS version,
    TIMESTAMP '{TRAINED_AT}' AS trained_at, '{','.join(TRAIN_LTV)}' AS features,
    CAST({len(TRAIN_LTV)} AS BIGINT) AS n_features, count(*) AS n_samples, CAST(NULL AS DOUBLE) AS baseline_accuracy FROM v_ltv"""))
def q_model_metadata(spark, folder):
    data = stage(ltv_frame(spark, folder))
    saved = L.save_model(_churn_model(data), scratch_path(spark, "models"), "churn", TRAIN_LTV,
                         data.count(), TRAINED_AT)
    return saved.withColumn("features", F.array_join("features", ","))


@query("risk_summary")
def q_risk_summary(spark, folder):
    return L.risk_summary(q_churn_scores(spark, folder))


def cluster_input(spark, folder):
    customers = stage(summary(rentals(spark, folder)))
    return L.scaled_vectors(customers, L.CLUSTER_FEATURES)


@query("cluster_scores")
def q_cluster_scores(spark, folder):
    return L.cluster_scores(cluster_input(spark, folder))


@query("cluster_map")
def q_cluster_map(spark, folder):
    """Cluster and two principal components of every customer."""
    vectors = cluster_input(spark, folder)
    placed, shares = L.project_2d(L.assign_clusters(vectors, 3))
    return placed.select("customer_id", "cluster", "pc1", "pc2",
                         F.lit(sum(shares)).alias("explained"))


@query("cluster_profile", twin("v_summary", f"""
SELECT *, CASE WHEN avg_spend > {NAME_CUTS[0]} THEN 'High Value'
    WHEN avg_spend > {NAME_CUTS[1]} THEN 'Medium Value'
    WHEN active_rate < {NAME_CUTS[2]} THEN 'At Risk' ELSE 'Standard' END AS cluster_name
FROM (SELECT c.cluster, count(s.customer_id) AS customer_count,
    {r_even('sum(CAST(round(total_spend * 100) AS BIGINT))', 'count(total_spend)')} AS avg_spend,
    {r_even('sum(total_rentals)', 'count(total_rentals)', 2, 0)} AS avg_rentals,
    {r_even('sum(days_since_last_payment)', 'count(days_since_last_payment)', 2, 0)}
      AS avg_days_since_payment,
    {r_even('count(CASE WHEN is_active THEN 1 END)', 'count(is_active)', 2, 0)} AS active_rate,
    {r_even("count(CASE WHEN segment = 'Platinum' THEN 1 END)", 'count(*)', 2, 0)} AS pct_platinum
  FROM v_summary s JOIN (SELECT c_custkey,
      CAST(floor(c_acctbal / {CLUSTER_WIDTH}) AS BIGINT) AS cluster FROM customer) c
    ON s.customer_id = c.c_custkey GROUP BY 1)"""))
def q_cluster_profile(spark, folder):
    r = rentals(spark, folder)
    return L.cluster_profile(summary(r).join(clusters(r), "customer_id"), NAME_CUTS)


def score_checks(scores, key):
    """What must hold for any stored score table: rows, distinct keys, and rows that contradict themselves."""
    wrong = ~F.col("probability").between(0, 1) | ~F.col("prediction").isin(0, 1) | (
        (F.abs(F.col("probability") - 0.5) > 1e-4) & ((F.col("probability") > 0.5) != (F.col("prediction") == 1))) | (
        F.col("correct") != (F.col("prediction") == F.col("actual")).cast("bigint"))
    return scores.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"), F.sum("actual").alias("actual"),
                      F.count_if(F.coalesce(wrong, F.lit(True))).alias("contradictions"))


@query("churn_score_checks", twin("v_ltv", f"""SELECT count(*) AS n, count(DISTINCT customer_unique_id) AS n_keys,
    CAST(sum(CAST(last_order_date < TIMESTAMP '{CHURN_CUT}' AS BIGINT)) AS BIGINT) AS actual,
    CAST(0 AS BIGINT) AS contradictions FROM v_ltv"""))
def q_churn_score_checks(spark, folder):
    return score_checks(stage(q_churn_scores(spark, folder)), "customer_unique_id")


@query("delay_score_checks", twin("v_delay", """SELECT count(*) AS n, count(DISTINCT order_id) AS n_keys,
    CAST(sum(target) AS BIGINT) AS actual, CAST(0 AS BIGINT) AS contradictions FROM v_delay"""))
def q_delay_score_checks(spark, folder):
    return score_checks(stage(q_delay_scores(spark, folder)), "order_id")


@query("chain_audit", twin("v_ltv v_order_metrics v_months v_performance v_products v_delay stg_payments", f"""
SELECT model AS pipeline_name, model AS target_table, row_count AS rows_loaded, 'success' AS status FROM ({CHAIN_ROWS}
UNION ALL SELECT 'churn_scores', 'table', count(*) FROM v_ltv
UNION ALL SELECT 'delay_scores', 'table', count(*) FROM v_delay) WHERE materialized <> 'view'"""))
def q_chain_audit(spark, folder):
    """Marts, then the churn and delay models side by side, their score tables, then the audit trail.

    Every count is taken from the stored table, so a model that was not run or a table that was not written shows.
    """
    m = market(spark, folder)
    root = scratch_path(spark, "full-chain")
    models = mart_models(m)
    began = dt.datetime.now()
    built = build_models(spark, models, f"{root}/marts")
    lost = F.col("last_order_date") < F.lit(CHURN_CUT).cast("timestamp_ntz")

    def churn():
        data = stage(L.ltv_features(built["mart_customer_ltv"], lost.cast("int")))
        return write_table(L.score(_churn_model(data), data, "customer_unique_id", SCORED_ON), f"{root}/churn_scores")

    def delay():
        data = stage(delay_frame(spark, folder))
        train, _ = L.split(data, "order_id")
        model = L.fit_balanced_forest(train, "order_id", L.DELAY_FEATURES, **DELAY_FOREST)
        return write_table(L.score(model, data, "order_id", SCORED_ON), f"{root}/delay_scores")

    with ThreadPoolExecutor(2) as pool:
        jobs = {n: pool.submit(f) for n, f in (("churn_scores", churn), ("delay_scores", delay))}
        scores = {n: job.result() for n, job in jobs.items()}
    tables = {n: df for n, df in built.items() if models[n].materialized != "view"} | scores
    append_audit(spark, f"{root}/audit", *[
        Outcome(n, "orders", n, "success", began, dt.datetime.now(), rows_out=df.count()) for n, df in tables.items()])
    return read_audit(spark, f"{root}/audit").select("pipeline_name", "target_table",
                                                     "rows_loaded", "status")
