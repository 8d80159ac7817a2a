"""What must hold for the trained models, whatever their random draws: checks with SQL twins.

A model has no SQL form, but its result has properties that the tables fix. Each
query trains as its sibling in ``models`` does, stores what was predicted, and
counts what contradicts the definition; row and class counts come from the data
on both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quaymart.operators import models as L
from quaymart.operators.balance import with_class_weights
from quaymart.plans import models as P
from quaymart.plans.registry import query
from quaymart.plans.twins import twin
from quaymart.session import stage

# How far a gradient, a share or a rounded metric may be from what it should be.
FLAT, EVEN, ROUNDED = 1e-3, 1e-6, 2e-4


def _all(conditions):
    return reduce(lambda a, b: a & b, conditions)


@query("logistic_checks", twin("v_summary", f"""SELECT count(*) AS n_train, CAST({len(L.CHURN_FEATURES)} AS BIGINT) AS n_features,
    CAST(0 AS BIGINT) AS unsettled FROM v_summary WHERE total_spend IS NOT NULL AND {P.in_train_sql('customer_id')}"""))
def q_logistic_checks(spark, folder):
    """The gradient of the weighted, penalised loss is flat at the coefficients that were found."""
    train, _ = L.split(stage(P.churn_frame(spark, folder)), "customer_id")
    train = stage(with_class_weights(train, "target"))
    n = train.count()
    model = L.fit_logistic(train.drop("weight"), L.CHURN_FEATURES)
    found = model.stages[-1].coefficients.toArray().tolist()
    miss = F.col("weight") * (vector_to_array("probability")[1] - F.col("target"))
    x = vector_to_array("vector")
    sums = model.transform(train).agg(F.sum(miss).alias("g"), *[F.sum(miss * x[i]).alias(f"g{i}") for i in range(len(found))], F.sum("weight").alias("w"))
    slopes = F.array(F.col("g") / F.col("w"), *[F.col(f"g{i}") / F.col("w") + c / n for i, c in enumerate(found)])
    return sums.select(F.lit(n).cast("bigint").alias("n_train"), F.lit(len(found)).cast("bigint").alias("n_features"),
                       F.size(F.filter(slopes, lambda s: ~(F.abs(s) < FLAT))).cast("bigint").alias("unsettled"))


@query("forest_checks", twin("v_delay", f"""SELECT count(*) AS n_train, CAST({len(L.DELAY_FEATURES)} AS BIGINT) AS n_features,
    CAST(0 AS BIGINT) AS outside, true AS sums_to_one FROM v_delay WHERE {P.in_train_sql('order_id')}"""))
def q_forest_checks(spark, folder):
    """Importances are shares: none below 0 or above 1, one in all."""
    train, _ = L.split(stage(P.delay_frame(spark, folder)), "order_id")
    shares = P.q_forest_importances(spark, folder)
    return shares.agg(F.lit(train.count()).cast("bigint").alias("n_train"), F.count_distinct("feature").alias("n_features"),
                      F.count_if(~F.col("importance").between(0, 1)).alias("outside"),
                      (F.abs(F.sum("importance") - 1) < EVEN).alias("sums_to_one"))


@query("cross_score_checks", twin("v_ltv", f"""SELECT count(*) AS n, count(DISTINCT customer_unique_id) AS n_keys,
    CAST(sum(CAST(last_order_date < TIMESTAMP '{P.CHURN_CUT}' AS BIGINT)) AS BIGINT) AS actual, CAST(5 AS BIGINT) AS folds,
    CAST(0 AS BIGINT) AS wrong FROM v_ltv"""))
def q_cross_score_checks(spark, folder):
    """Every row is scored once, by a (smaller) forest of the folds it is not in, and each fold's F1 is that of its stored predictions."""
    data = stage(P.ltv_frame(spark, folder))
    key = "customer_unique_id"
    scored = stage(L.cross_predictions(data, key, P.TRAIN_LTV, 5, trees=20, depth=10))
    hit, said, real = (F.count_if(c) for c in ((F.col("target") == 1) & (F.col("prediction") == 1), F.col("prediction") == 1, F.col("target") == 1))
    again = scored.groupBy("fold").agg((2 * hit / F.greatest(said + real, F.lit(1))).alias("again"))
    off = L.fold_scores(scored, 5).join(again, "fold").where(~(F.abs(F.col("f1_positive") - F.col("again")) < ROUNDED)).count()
    moved = scored.where(F.col("fold") != L.fold(key, 5)).count()
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"), F.sum("target").alias("actual"),
                      F.count_distinct("fold").alias("folds"), F.lit(off + moved).cast("bigint").alias("wrong"))


@query("variant_checks", twin("v_ltv", f"""SELECT CAST(4 AS BIGINT) AS variants, negatives, positives, CAST(0 AS BIGINT) AS wrong
FROM (SELECT count(*) FILTER (target = 0) AS negatives, count(*) FILTER (target = 1) AS positives FROM (
  SELECT CAST(last_order_date < TIMESTAMP '{P.CHURN_CUT}' AS BIGINT) AS target FROM v_ltv
  WHERE NOT ({P.in_train_sql('customer_unique_id')})))"""))
def q_variant_checks(spark, folder):
    """All variants are judged on the whole test side: their accuracy is the mean of the class recalls by class size."""
    _, test = L.split(stage(P.ltv_frame(spark, folder)), "customer_unique_id")
    sizes = test.agg(F.count_if(F.col("target") == 0).alias("negatives"), F.count_if(F.col("target") == 1).alias("positives")).first()
    rows = P.q_variant_comparison(spark, folder)
    n = F.lit(sizes["negatives"] + sizes["positives"])
    mean = (F.col("recall_0") * sizes["negatives"] + F.col("recall_1") * sizes["positives"]) / n
    fine = _all([F.col(c).between(0, 1) for c in ("accuracy", "f1", "precision", "recall", "recall_0", "recall_1")])
    fine = fine & (F.abs(F.col("accuracy") - mean) < ROUNDED) & (F.abs(F.col("recall") - F.col("accuracy")) < ROUNDED)
    return rows.agg(F.count_distinct("variant").alias("variants"), F.lit(sizes["negatives"]).cast("bigint").alias("negatives"),
                    F.lit(sizes["positives"]).cast("bigint").alias("positives"), F.count_if(~F.coalesce(fine, F.lit(False))).alias("wrong"))


@query("risk_checks", twin("v_ltv", "SELECT count(*) AS total, CAST(0 AS BIGINT) AS wrong FROM v_ltv"))
def q_risk_checks(spark, folder):
    """The summary against plain SQL over the stored score table."""
    scores = stage(P.q_churn_scores(spark, folder))
    plain = spark.sql("""SELECT count(*) AS n, count_if(prediction = 1) AS said, count_if(probability > 0.5D) AS high,
        count_if(prediction = actual) AS right FROM {scores}""", scores=scores)
    both = L.risk_summary(scores).join(plain, F.col("total") == F.col("n"))      # one row by one row
    close = lambda shown, part: F.abs(F.col(shown) - 100 * F.col(part) / F.col("n")) <= 0.0501
    fine = (F.col("predicted") == F.col("said")) & (F.col("high_risk") == F.col("high")) & close("predicted_pct", "said") & close("accuracy_pct", "right")
    return both.agg(F.max("total").alias("total"), F.count_if(~F.coalesce(fine, F.lit(False))).alias("wrong"))


@query("cluster_score_checks", twin("v_summary", """SELECT CAST(7 AS BIGINT) AS settings, CAST(1 AS BIGINT) AS best, CAST(0 AS BIGINT) AS wrong,
    count(*) AS n FROM v_summary"""))
def q_cluster_score_checks(spark, folder):
    """k from 2 to 8; no clustering costs more than one cluster does; the one best has the highest silhouette."""
    vectors = P.cluster_input(spark, folder)
    n = vectors.count()
    # Scaled columns have deviation 1, so the cost of a single cluster is (n - 1) per column; a constant column adds none.
    most = float((n - 1) * len(L.CLUSTER_FEATURES)) * (1 + EVEN)
    scores = stage(P.q_cluster_scores(spark, folder))
    top = scores.agg(F.max("silhouette")).first()[0]
    fine = F.col("k").between(2, 8) & F.col("cost").between(0, most) & F.col("silhouette").between(-1, 1) & (F.col("is_best") == (F.col("silhouette") == top))
    return scores.agg(F.count_distinct("k").alias("settings"), F.count_if("is_best").alias("best"),
                      F.count_if(~F.coalesce(fine, F.lit(False))).alias("wrong"), F.lit(n).cast("bigint").alias("n"))


@query("cluster_map_checks", twin("v_summary", """SELECT count(*) AS n, count(DISTINCT customer_id) AS n_keys, CAST(3 AS BIGINT) AS clusters,
    CAST(0 AS BIGINT) AS strays, true AS uncorrelated, true AS in_order, true AS explained FROM v_summary"""))
def q_cluster_map_checks(spark, folder):
    """Every row lies nearest to the mean of its own cluster; the components are uncorrelated, the first the wider one."""
    placed, shares = L.project_2d(L.assign_clusters(P.cluster_input(spark, folder), 3))
    rows = stage(placed.select("customer_id", "cluster", "pc1", "pc2", vector_to_array("vector").alias("x")))
    dims = len(L.CLUSTER_FEATURES)
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(dims)]).alias("m")).collect()

    def far(mean):
        return sum(((F.col("x")[i] - float(mean[i])) * (F.col("x")[i] - float(mean[i])) for i in range(dims)), F.lit(0.0))

    own = F.coalesce(*[F.when(F.col("cluster") == r["cluster"], far(r["m"])) for r in means])
    stray = F.sqrt(own) > F.sqrt(F.least(*[far(r["m"]) for r in means])) + 0.01
    total = sum((F.var_samp(F.col("x")[i]) for i in range(dims)), F.lit(0.0))
    wide, narrow = F.var_samp("pc1"), F.var_samp("pc2")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("n_keys"), F.count_distinct("cluster").alias("clusters"),
                    F.count_if(F.coalesce(stray, F.lit(True))).alias("strays"), (F.abs(F.corr("pc1", "pc2")) < EVEN).alias("uncorrelated"),
                    (wide >= narrow).alias("in_order"), (F.abs((wide + narrow) / total - sum(shares)) < EVEN).alias("explained"))
