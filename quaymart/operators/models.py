"""Features, training, scoring, metrics, drift: tables in, tables out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymart.functions import half_up, ordinal, pct, ratio, rint_to, to_cents
from quaymart.operators.balance import SEED, fold, in_train, smote, with_class_weights
from quaymart.operators.forest import GrownForest, Ready, cells, fit_grown, said, votes
from quaymart.operators.quantiles import exact_median
from quaymart.session import scratch_path, stage
from quaymart.sources.files import path_exists, write_json_row

# Fill values and windows of the feature rules.
NO_PAYMENT_DAYS = 999
RECENT_DAYS = 30
NEUTRAL_REVIEW = 3.0

CHURN_FEATURES = ("total_rentals", "total_spend", "days_since_last_payment",
                  "avg_spend_per_rental", "log_total_spend", "log_total_rentals",
                  "segment_encoded", "is_high_value", "is_recent", "rental_frequency")
LTV_FEATURES = ("total_spent", "avg_order_value", "days_since_last_order", "avg_review_score",
                "cancel_rate", "log_total_spent")
DELAY_FEATURES = ("delivery_days_estimated", "payment_value", "product_count",
                  "log_payment_value", "is_expensive")


def _filled(col: str, value) -> Column:
    return F.coalesce(F.col(col), F.lit(value))


def churn_features(summary: DataFrame) -> DataFrame:
    """Ten features per customer with the key kept; target ``is_active``. Customers without any spend are left out.

    ``summary`` is read again for the median: stage it first.
    """
    summary = summary.where(F.col("total_spend").isNotNull())
    spend = _filled("total_spend", 0.0)
    median = exact_median(summary.select(spend.alias("v")), "v")
    base = summary.select(
        "customer_id", _filled("total_rentals", 0).cast("double").alias("total_rentals"),
        spend.alias("total_spend"),
        _filled("days_since_last_payment", NO_PAYMENT_DAYS).cast("double")
        .alias("days_since_last_payment"),
        ordinal("segment").cast("bigint").alias("segment_encoded"),
        F.col("is_active").cast("int").cast("bigint").alias("target"))
    rentals = F.nullif("total_rentals", F.lit(0.0))
    return base.select(
        "customer_id", "total_rentals", "total_spend", "days_since_last_payment",
        F.coalesce(F.col("total_spend") / rentals, F.lit(0.0)).alias("avg_spend_per_rental"),
        F.log1p("total_spend").alias("log_total_spend"),
        F.log1p("total_rentals").alias("log_total_rentals"), "segment_encoded",
        F.when(F.col("total_spend") > median, 1).otherwise(0).cast("bigint").alias("is_high_value"),
        F.when(F.col("days_since_last_payment") < RECENT_DAYS, 1).otherwise(0).cast("bigint")
        .alias("is_recent"),
        rint_to(F.col("total_rentals") / (F.col("days_since_last_payment") + 1), 4)
        .alias("rental_frequency"), "target")


def ltv_features(ltv: DataFrame, target: Column | None = None) -> DataFrame:
    """Six features per customer; the order count is left out, since it defines
    the default target."""
    known = ltv.where(F.col("total_spent").isNotNull())
    orders = F.when(F.col("total_orders") == 0, 1).otherwise(F.col("total_orders"))
    return known.select(
        "customer_unique_id", F.col("total_spent").cast("double").alias("total_spent"),
        _filled("avg_order_value", 0.0).cast("double").alias("avg_order_value"),
        _filled("days_since_last_order", NO_PAYMENT_DAYS).cast("double")
        .alias("days_since_last_order"),
        _filled("avg_review_score", NEUTRAL_REVIEW).cast("double").alias("avg_review_score"),
        F.coalesce(ratio("cancelled_orders", orders, 4, half="even"), F.lit(0.0))
        .alias("cancel_rate"),
        F.log1p("total_spent").alias("log_total_spent"),
        (F.col("is_churned") if target is None else target).cast("bigint").alias("target"))


def delay_features(orders: DataFrame) -> DataFrame:
    """Five features per order with its key; target ``is_late``. Stage ``orders``."""
    known = orders.where(F.col("is_late").isNotNull())
    days = exact_median(known, F.col("delivery_days_estimated").cast("double"))
    paid = _filled("payment_value", 0.0).cast("double")
    middle = exact_median(known.select(paid.alias("v")), "v")
    return known.select(
        "order_id",
        F.coalesce(F.col("delivery_days_estimated").cast("double"), days)
        .alias("delivery_days_estimated"),
        paid.alias("payment_value"), _filled("product_count", 1).cast("double").alias("product_count"),
        F.log1p(paid).alias("log_payment_value"),
        F.when(paid > middle, 1).otherwise(0).cast("bigint").alias("is_expensive"),
        F.col("is_late").cast("bigint").alias("target"))


def feature_stats(df: DataFrame, features: Sequence[str], target: str = "target") -> DataFrame:
    """Mean, deviation, range and correlation with the target, in one aggregate."""
    aggs = []
    for c in features:
        v = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("feature"), rint_to(F.avg(v), 4).alias("mean"),
            rint_to(F.stddev_pop(v), 4).alias("std"), F.min(v).alias("low"),
            F.max(v).alias("high"),
            rint_to(F.corr(v, F.col(target).cast("double")), 4).alias("corr")).alias(c))
    return df.agg(*aggs).select(F.explode(F.array(*features)).alias("s")).select("s.*")


def zscores(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Standard scores with the population deviation; 0 for a constant feature.

    Means and deviations are one struct-valued scalar subquery.
    """
    stats = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
        for c in features])).scalar()
    wide = df.withColumn("__s", stats)
    return wide.select(key, *[
        F.coalesce((F.col(c) - F.col(f"__s.{c}.m")) / F.nullif(F.col(f"__s.{c}.s"), F.lit(0.0)),
                   F.lit(0.0)).alias(c) for c in features])


# --- training -----------------------------------------------------------------

def _assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="raw_vector")


def _scale() -> StandardScaler:
    return StandardScaler(inputCol="raw_vector", outputCol="vector", withMean=True)


def stored(model: PipelineModel) -> PipelineModel:
    """The model as read back from the shared folder.

    A freshly fitted model carries its training summary, and with it the whole
    training plan, into every task that scores; the stored form does not.
    """
    path = scratch_path(SparkSession.builder.getOrCreate(), "model")
    model.write().save(path)
    return PipelineModel.load(path)


def fit_logistic(train: DataFrame, features: Sequence[str], weighted: bool = True,
                 max_iter: int = 1000) -> PipelineModel:
    """Scaled logistic regression; the penalty matches C = 1 on summed losses."""
    n = train.count()
    stages = [_assemble(features), _scale(), LogisticRegression(
        featuresCol="vector", labelCol="target", maxIter=max_iter, regParam=1.0 / max(n, 1),
        standardization=False, **({"weightCol": "weight"} if weighted else {}))]
    data = with_class_weights(train, "target") if weighted else train
    return stored(Pipeline(stages=stages).fit(data))


def _forest(trees: int, depth: int, weighted: bool) -> RandomForestClassifier:
    """Each row keeps the nodes that it has reached, so a pass neither sends the trees grown so far
    to the tasks nor walks them again from the root. The trees are the same either way."""
    return RandomForestClassifier(
        featuresCol="vector", labelCol="target", numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True,
        **({"weightCol": "weight"} if weighted else {}))


def fit_forest(train: DataFrame, features: Sequence[str], trees: int = 100, depth: int = 10,
               weighted: bool = False) -> PipelineModel:
    data = with_class_weights(train, "target") if weighted else train
    stages = [_assemble(features), _scale(), _forest(trees, depth, weighted)]
    return stored(Pipeline(stages=stages).fit(data))


# A forest of at most WHOLE_NODES possible nodes (two a row and tree) is fitted whole;
# a larger one in blocks of about BLOCK_NODES.
WHOLE_NODES = 3_000_000
BLOCK_NODES = 600_000
# A forest of more possible nodes is grown in tasks (``fit_whole_forest``): the driver of Spark's deep forests
# is what takes the time, long before it lacks the memory.
GROWN_NODES = 1_000_000


class ForestBlocks:
    """A forest as stored blocks of trees, for one that is too large for the driver as a whole.

    Scoring loads one block at a time and adds the votes of its trees to those of the blocks before;
    the class with the most votes wins (the smaller one in a tie), as in a whole forest.
    """

    def __init__(self, prepare: PipelineModel, blocks: Sequence[tuple[str, int]]):
        self.prepare, self.blocks = prepare, list(blocks)

    def transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        rows = self.prepare.transform(df).select(*names, "vector")
        for i, (path, _) in enumerate(self.blocks):
            votes = vector_to_array("rawPrediction")
            if i:
                votes = F.zip_with("__votes", votes, lambda a, b: a + b)
            scored = RandomForestClassificationModel.load(path).transform(rows)
            rows = stage(scored.select(*names, "vector", votes.alias("__votes")))
        best = F.array_position("__votes", F.array_max("__votes")) - 1
        return rows.select(*names, best.cast("double").alias("prediction"))


def fit_forest_blocks(train: DataFrame, features: Sequence[str], trees: int = 100, depth: int = 10,
                      weighted: bool = False) -> PipelineModel | ForestBlocks:
    """``fit_forest`` for any number of rows: all trees, each on all rows, but the driver holds one block of them.

    The first block is sized by the rows, the others by the nodes that the trees so far came to.
    """
    rows = max(train.count(), 1)
    if 2 * rows * trees <= WHOLE_NODES:
        return fit_forest(train, features, trees, depth, weighted)
    data = with_class_weights(train, "target") if weighted else train
    prepare = stored(Pipeline(stages=[_assemble(features), _scale()]).fit(data))
    data = stage(prepare.transform(data).select("vector", "target", *(["weight"] if weighted else [])))
    blocks, done, nodes = [], 0, 0
    while done < trees:
        a_tree = nodes // done if done else 2 * rows
        size = min(max(BLOCK_NODES // max(a_tree, 1), 1), trees - done)
        model = _forest(size, depth, weighted).setSeed(SEED + done).fit(data)
        path = scratch_path(train.sparkSession, "trees")
        model.write().save(path)
        blocks.append((path, size))
        done, nodes = done + size, nodes + model.totalNumNodes
    return ForestBlocks(prepare, blocks)


def _large(rows: int, trees: int) -> bool:
    return 2 * max(rows, 1) * trees > GROWN_NODES


def _prepared(data: DataFrame, features: Sequence[str]) -> PipelineModel:
    return stored(Pipeline(stages=[_assemble(features), _scale()]).fit(data))


def fit_whole_forest(train: DataFrame, features: Sequence[str], trees: int = 100, depth: int = 10,
                     weighted: bool = False, rows: int | None = None) -> PipelineModel | GrownForest:
    """``fit_forest`` for any number of rows: all trees, each on all rows; a large forest is grown in tasks (see ``forest``)."""
    if not _large(train.count() if rows is None else rows, trees):
        return fit_forest(train, features, trees, depth, weighted)
    data = with_class_weights(train, "target") if weighted else train
    return fit_grown(_prepared(data, features), data, len(features), trees, depth, weighted, SEED)


def balanced_rows(train: DataFrame, key: str, features: Sequence[str], trees: int) -> tuple[DataFrame, int]:
    """All rows and the synthetic ones of every smaller class, and how many these are; written once if a forest on them is large."""
    counts = [r[1] for r in train.groupBy("target").count().collect()]
    rows = max(counts, default=0) * len(counts)
    made = smote(train, key, features, "target")
    return (stage(made) if _large(rows, trees) else made), rows


def fit_balanced_forest(train: DataFrame, key: str, features: Sequence[str], trees: int = 100,
                        depth: int = 10) -> PipelineModel | GrownForest:
    """Synthetic minority rows, scaling, forest. Only training rows are balanced, all of them."""
    made, rows = balanced_rows(train, key, features, trees)
    return fit_whole_forest(made, features, trees, depth, rows=rows)


def split(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    side = in_train(key)
    return df.where(side), df.where(~side)


def coefficients(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    return sorted(zip(features, model.stages[-1].coefficients.toArray().tolist()),
                  key=lambda c: -abs(c[1]))


def importances(model: PipelineModel | GrownForest, features: Sequence[str]) -> list[tuple[str, float]]:
    shares = model.importances() if isinstance(model, GrownForest) else model.stages[-1].featureImportances.toArray().tolist()
    return sorted(zip(features, shares), key=lambda c: -c[1])


# The full forest grid (minimum split size has no Spark twin; the
# depth 'unlimited' is 30, the most that Spark allows).
UNLIMITED = 30
FULL_GRID = {"numTrees": (50, 100), "maxDepth": (3, 5, UNLIMITED), "minInstancesPerNode": (1, 2)}


def grid_search(train: DataFrame, key: str, features: Sequence[str],
                grid: dict[str, Sequence] | None = None, folds: int = 5,
                parallelism: int = 2) -> tuple[PipelineModel | GrownForest, DataFrame]:
    """Best forest by F1 of the positive class, and the score of every setting.

    The driver holds ``parallelism`` forests at a time; where a setting's forest is large, it holds none,
    and the forests of all settings grow together (see ``_grown_search``).
    """
    spark = train.sparkSession
    grid = grid or FULL_GRID
    forest = _forest(50, 5, True)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), list(values))
    settings = builder.build()
    data = with_class_weights(train, "target").withColumn("fold", fold(key, folds))
    if set(grid) <= set(FULL_GRID) and _large(train.count(), max(grid.get("numTrees", (50,)))):
        values = [{p.name: v for p, v in s.items()} for s in settings]
        wanted = [(v.get("numTrees", 50), v.get("maxDepth", 5), v.get("minInstancesPerNode", 1)) for v in values]
        best, means, spreads = _grown_search(data, features, wanted, folds)
    else:
        scorer = MulticlassClassificationEvaluator(labelCol="target", metricName="fMeasureByLabel",
                                                   metricLabel=1.0)
        search = CrossValidator(
            estimator=Pipeline(stages=[_assemble(features), _scale(), forest]),
            estimatorParamMaps=settings, evaluator=scorer, numFolds=folds, foldCol="fold",
            parallelism=parallelism, seed=SEED)
        model = search.fit(data)
        best, means, spreads = stored(model.bestModel), model.avgMetrics, model.stdMetrics
    rows = [(", ".join(f"{p.name}={v}" for p, v in s.items()), float(m), float(d))
            for s, m, d in zip(settings, means, spreads)]
    return best, spark.createDataFrame(rows, "setting string, f1 double, f1_std double")


def _grown_search(data: DataFrame, features: Sequence[str], settings: Sequence[tuple[int, int, int]],
                  folds: int) -> tuple[GrownForest, np.ndarray, np.ndarray]:
    """The cross validation of ``grid_search``: per fold, a forest of each setting (trees, depth, least rows) is grown on
    the other folds' rows, scaled and binned without this one, and judged on this one; the best is fitted on all rows."""
    data = stage(data)
    scores = []
    for i in range(folds):
        side, held = data.where(F.col("fold") != i), data.where(F.col("fold") == i)
        ready = Ready(_prepared(side, features), side, len(features), True)
        x = ready.prepare.transform(held).select(vector_to_array("vector").alias("x"), "target")
        judged = cells(x, ready.cuts)
        given = votes(ready.forests(settings, SEED), judged.select("cell").distinct(), len(features), len(ready.weights))
        y, p = F.col("target") == 1, said() == 1
        n = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
        found = judged.join(given, "cell").groupBy("forest").agg((2 * n(y & p) / F.greatest(n(y) + n(p), F.lit(1))).alias("f1"))
        scores.append([f1 for _, f1 in sorted((r["forest"], r["f1"]) for r in found.collect())])
        if len(scores[-1]) != len(settings):
            raise ValueError(f"fold {i} has no rows")
    means = np.mean(scores, axis=0)
    trees, depth, least = settings[int(np.argmax(means))]
    best = fit_grown(_prepared(data, features), data, len(features), trees, depth, True, SEED, least)
    return best, means, np.std(scores, axis=0)


def cross_predictions(df: DataFrame, key: str, features: Sequence[str], folds: int = 5,
                      trees: int = 100, depth: int = 10) -> DataFrame:
    """``key, fold, target, prediction``: every row scored by a model that was balanced and fitted on the other folds."""
    tagged = df.withColumn("fold", fold(key, folds))
    out = None
    for i in range(folds):
        model = fit_balanced_forest(tagged.where(F.col("fold") != i), key, features, trees, depth)
        scored = model.transform(tagged.where(F.col("fold") == i)).select(key, "fold", "target", "prediction")
        out = scored if out is None else out.unionByName(scored)
    return out


def fold_scores(scored: DataFrame, folds: int) -> DataFrame:
    """F1 per fold, weighted (``f1``) and of the positive class (``f1_positive``)."""
    out = None
    for i in range(folds):
        one = scored.where(F.col("fold") == i)
        row = classification_metrics(one, "target", "prediction").select(F.lit(i).alias("fold"), "f1")
        row = row.crossJoin(positive_f1(one, "target", "prediction"))  # one row by one row
        out = row if out is None else out.unionByName(row)
    return out


def cross_scores(df: DataFrame, key: str, features: Sequence[str], folds: int = 5,
                 trees: int = 100, depth: int = 10) -> DataFrame:
    """F1 per fold: balance and fit on the other folds, score on this one."""
    return fold_scores(stage(cross_predictions(df, key, features, folds, trees, depth)), folds)


# --- metrics ------------------------------------------------------------------

def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("bigint").alias("label"),
                      F.col(prediction).cast("bigint").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, weighted precision, recall and F1, and recall per class (0, 1).

    Everything follows from the four confusion counts: one aggregate.
    """
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    cells = df.agg(*[F.count_if((y == a) & (p == b)).cast("double").alias(f"c{a}{b}")
                     for a in (0, 1) for b in (0, 1)])

    def safe(num, den):
        return F.coalesce(num / F.nullif(den, F.lit(0.0)), F.lit(0.0))

    c = {n: F.col(n) for n in ("c00", "c01", "c10", "c11")}
    n0, n1 = c["c00"] + c["c01"], c["c10"] + c["c11"]
    total = n0 + n1
    p0, p1 = safe(c["c00"], c["c00"] + c["c10"]), safe(c["c11"], c["c11"] + c["c01"])
    r0, r1 = safe(c["c00"], n0), safe(c["c11"], n1)
    f0, f1 = safe(2 * p0 * r0, p0 + r0), safe(2 * p1 * r1, p1 + r1)

    def weighted(a, b):
        return rint_to(safe(a * n0 + b * n1, total), 4)

    return cells.select(
        rint_to(safe(c["c00"] + c["c11"], total), 4).alias("accuracy"),
        weighted(f0, f1).alias("f1"), weighted(p0, p1).alias("precision"),
        weighted(r0, r1).alias("recall"), rint_to(r0, 4).alias("recall_0"),
        rint_to(r1, 4).alias("recall_1"))


def positive_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1 of class 1 as the one row ``f1_positive``: 2 hits / (actual + predicted)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    both = (F.count_if(y == 1) + F.count_if(p == 1)).cast("double")
    f1 = 2 * F.count_if((y == 1) & (p == 1)) / F.nullif(both, F.lit(0.0))
    return df.agg(rint_to(F.coalesce(f1, F.lit(0.0)), 4).alias("f1_positive"))


def compare_variants(df: DataFrame, key: str, features: Sequence[str], trees: int = 100,
                     depth: int = 10) -> DataFrame:
    """Logistic regression and forest, each without and with synthetic rows."""
    train, test = split(df, key)
    balanced, rows = balanced_rows(train, key, features, trees)
    models = {
        "LR (no SMOTE)": fit_logistic(train, features),
        "LR + SMOTE": fit_logistic(balanced, features, weighted=False),
        "RF (no SMOTE)": fit_whole_forest(train, features, trees, depth, weighted=True),
        "RF + SMOTE": fit_whole_forest(balanced, features, trees, depth, rows=rows),
    }
    out = None
    for name, model in models.items():
        row = classification_metrics(model.transform(test), "target", "prediction").withColumn(
            "variant", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


# --- scoring and storage ------------------------------------------------------

def score(model: PipelineModel | GrownForest, df: DataFrame, key: str, on: dt.date,
          positive: int = 1) -> DataFrame:
    """Prediction table with the row's own key, probability to four places."""
    chance = vector_to_array("probability")[positive]
    scored = model.transform(df).select(
        key, F.col("prediction").cast("bigint").alias("prediction"), chance.alias("p"),
        F.col("target").alias("actual"))
    return scored.select(
        key, "prediction", (half_up(F.col("p") * 1e4) / 1e4).alias("probability"), "actual",
        F.when(F.col("prediction") == F.col("actual"), 1).otherwise(0).cast("bigint")
        .alias("correct"), F.lit(on).cast("date").alias("prediction_date"))


def risk_summary(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows, predicted positives, high-risk rows, predicted rate, accuracy."""
    return scores.agg(
        F.count(F.lit(1)).alias("total"), F.sum("prediction").alias("predicted"),
        F.count_if(F.col("probability") > threshold).alias("high_risk"),
        pct(F.sum("prediction"), F.count(F.lit(1)), 1).alias("predicted_pct"),
        pct(F.sum("correct"), F.count(F.lit(1)), 1).alias("accuracy_pct"))


META_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("trained_at", T.TimestampNTZType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("n_features", T.LongType()), T.StructField("n_samples", T.LongType()),
    T.StructField("baseline_accuracy", T.DoubleType())])


def save_model(model: PipelineModel | GrownForest, folder: str, name: str, features: Sequence[str],
               n_samples: int, at: dt.datetime, baseline: float | None = None) -> DataFrame:
    """A versioned copy, the latest copy, and the metadata record."""
    spark = SparkSession.builder.getOrCreate()
    version = at.strftime("%Y%m%d_%H%M%S")
    for path in (f"{folder}/{name}_{version}", f"{folder}/{name}_latest"):
        if isinstance(model, GrownForest):
            model.save(path)
        else:
            model.write().overwrite().save(path)
    meta = {"model_name": name, "version": version, "trained_at": at, "features": list(features),
            "n_features": len(features), "n_samples": n_samples, "baseline_accuracy": baseline}
    return write_json_row(spark, f"{folder}/{name}_metadata", meta, META_SCHEMA)


def load_model(folder: str, name: str) -> PipelineModel | GrownForest:
    path, spark = f"{folder}/{name}_latest", SparkSession.builder.getOrCreate()
    return GrownForest.load(spark, path) if path_exists(spark, f"{path}/grown") else PipelineModel.load(path)


# --- drift --------------------------------------------------------------------

# Drops of accuracy that count as drift and as a warning, and the
# baseline of a model that has none.
DRIFT_DROP, WARN_DROP, FIRST_BASELINE = "0.05", "0.02", "0.90"


def drift_verdict(metrics: DataFrame) -> DataFrame:
    """Status of each (baseline_accuracy, current_accuracy) pair.

    Decimals, because 0.95 - 0.90 is below 0.05 in binary.
    """
    exact = "decimal(6,4)"
    base = F.coalesce(F.col("baseline_accuracy").cast(exact), F.lit(FIRST_BASELINE).cast(exact))
    now = F.col("current_accuracy").cast(exact)
    drop = base - now
    drift, warn = drop >= F.lit(DRIFT_DROP).cast(exact), drop >= F.lit(WARN_DROP).cast(exact)

    points = (drop * 100).cast("decimal(6,1)").cast("string")
    message = F.concat(
        F.when(drift, "retrain: ").when(warn, "watch: ").otherwise("stable: "), points,
        F.lit(" points below "), base.cast("string"), F.lit(" at "), now.cast("string"))
    return metrics.withColumns({
        "baseline_accuracy": base.cast("double"), "current_accuracy": now.cast("double"),
        "delta": drop.cast("double"),
        "status": F.when(drift, "drift").when(warn, "warning").otherwise("ok"),
        "drift_detected": drift, "warning_only": ~drift & warn, "message": message})


def drift_log(verdicts: DataFrame) -> DataFrame:
    """Only drift and warnings are logged."""
    return verdicts.where(F.col("drift_detected") | F.col("warning_only"))


class DriftMonitor:
    """Drift checks over time: a stored baseline and an appended log.

        <path>/baseline    accuracy and time of the first check, one row
        <path>/log         checks that ended in a warning or in drift, with their time

    The first check has no baseline yet and is held against ``FIRST_BASELINE``;
    its accuracy is then stored, and every later check reads it.
    """

    LOG = ("checked_at timestamp_ntz, baseline_accuracy double, current_accuracy double, delta double, status string, message string")
    BASELINE = "accuracy double, checked_at timestamp_ntz"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def baseline(self) -> float | None:
        where = f"{self.path}/baseline"
        return self.spark.read.schema(self.BASELINE).parquet(where).first()["accuracy"] if path_exists(self.spark, where) else None

    def check(self, accuracy: float, at: dt.datetime) -> str:
        """The status of one check, after the log and, at the first, the baseline were written."""
        known = self.baseline()
        row = self.spark.createDataFrame([(at, known, accuracy)], "checked_at timestamp_ntz, baseline_accuracy double, current_accuracy double")
        names = [f.split()[0] for f in self.LOG.split(", ")]
        verdict = drift_verdict(row).select(*names).first()
        if verdict["status"] != "ok":
            self.spark.createDataFrame([tuple(verdict)], self.LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        if known is None:
            self.spark.createDataFrame([(verdict["current_accuracy"], at)], self.BASELINE).coalesce(1).write.parquet(f"{self.path}/baseline")
        return verdict["status"]

    def log(self) -> DataFrame:
        where = f"{self.path}/log"
        if not path_exists(self.spark, where):
            return self.spark.createDataFrame([], self.LOG)
        return self.spark.read.schema(self.LOG).parquet(where)


# --- clusters -----------------------------------------------------------------

CLUSTER_FEATURES = ("total_rentals", "total_spend", "days_since_last_payment")


def scaled_vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    filled = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"__{c}")
                              for c in features])
    pipe = Pipeline(stages=[_assemble([f"__{c}" for c in features]), _scale()])
    return pipe.fit(filled).transform(filled).drop("raw_vector", *[f"__{c}" for c in features])


def cluster_scores(vectors: DataFrame, ks: Sequence[int] = range(2, 9)) -> DataFrame:
    """Cost and silhouette for each number of clusters, and the best one."""
    spark = vectors.sparkSession
    vectors = vectors.select("vector").cache()
    judge = ClusteringEvaluator(featuresCol="vector")
    rows = []
    for k in ks:
        model = KMeans(featuresCol="vector", k=k, seed=SEED, maxIter=100).fit(vectors)
        rows.append((k, float(model.summary.trainingCost),
                     float(judge.evaluate(model.transform(vectors)))))
    vectors.unpersist()
    best = max(rows, key=lambda r: r[2])[0] if rows else None
    return spark.createDataFrame([(*r, r[0] == best) for r in rows],
                                 "k int, cost double, silhouette double, is_best boolean")


def assign_clusters(vectors: DataFrame, k: int) -> DataFrame:
    model = KMeans(featuresCol="vector", k=k, seed=SEED, maxIter=100).fit(vectors)
    return model.transform(vectors).withColumnRenamed("prediction", "cluster")


def project_2d(vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """Two principal components and the share of variance each explains."""
    model = PCA(k=2, inputCol="vector", outputCol="pc").fit(vectors)
    xy = vector_to_array("pc")
    out = model.transform(vectors).withColumns({"pc1": xy[0], "pc2": xy[1]}).drop("pc")
    return out, model.explainedVariance.toArray().tolist()


# Bounds and names of the cluster rule.
NAME_CUTS = (150, 100, 0.8)


def cluster_profile(df: DataFrame, cuts: Sequence[float] = NAME_CUTS) -> DataFrame:
    """Size, means, active share, share of the top segment, and a name per cluster."""
    high, medium, active = cuts
    n = F.count(F.lit(1))
    cells = df.groupBy("cluster").agg(
        F.count("customer_id").alias("customer_count"),
        ratio(F.sum(to_cents("total_spend")), F.count("total_spend"), 2, 2, "even")
        .alias("avg_spend"),
        ratio(F.sum("total_rentals"), F.count("total_rentals"), 2, half="even")
        .alias("avg_rentals"),
        ratio(F.sum("days_since_last_payment"), F.count("days_since_last_payment"), 2, half="even")
        .alias("avg_days_since_payment"),
        ratio(F.count_if("is_active"), F.count("is_active"), 2, half="even").alias("active_rate"),
        ratio(F.count_if(F.col("segment") == "Platinum"), n, 2, half="even").alias("pct_platinum"))
    name = (F.when(F.col("avg_spend") > high, "High Value")
            .when(F.col("avg_spend") > medium, "Medium Value")
            .when(F.col("active_rate") < active, "At Risk").otherwise("Standard"))
    return cells.withColumn("cluster_name", name)
