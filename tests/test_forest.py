"""Forests grown in tasks on all rows, and balanced models without a sample."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quaymart.operators import forest as G
from quaymart.operators import models as L


def _rows(spark, n=1500, minority=5):
    noise = F.pmod(F.xxhash64("id"), F.lit(100))
    a, b = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 10.0, (F.col("id") % 11).cast("double")
    late = (a > 100 - 100 / minority) != (noise < 5)
    return spark.range(n).select("id", a.alias("a"), b.alias("b"), late.cast("bigint").alias("target"))


def _classes(df):
    return {r["target"]: r["count"] for r in df.groupBy("target").count().collect()}


def _some(n=400, features=3, seed=0):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 8, (n, features)).astype(np.uint8)
    label = ((bins[:, 0] > 3) ^ (rng.random(n) < 0.2)).astype(np.int64)
    return bins, label, rng.integers(0, 4, n)


def test_balanced_forest_is_fitted_on_all_rows(spark, monkeypatch):
    """no sample, however large the smaller class is."""
    df = _rows(spark, 9000)
    n = _classes(df)
    assert min(n.values()) > 1500
    met = []
    monkeypatch.setattr(L, "fit_forest", lambda train, *_, **__: met.append(train))
    L.fit_balanced_forest(df, "id", ["a", "b"], trees=3, depth=3)
    got = {(r["target"], r["synthetic"]): r["count"] for r in met[0].groupBy("target", "synthetic").count().collect()}
    assert got == {(0, False): n[0], (1, False): n[1], (1, True): n[0] - n[1]}


def test_variants_are_fitted_on_all_rows(spark, monkeypatch):
    """F7, F8: the variants with synthetic rows meet every row of the training side too."""
    df = _rows(spark, 9000)
    n = _classes(L.split(df, "id")[0])
    met = []
    for name in ("fit_forest", "fit_logistic"):
        real = getattr(L, name)
        monkeypatch.setattr(L, name, lambda train, *a, real=real, **k: met.append(train.count()) or real(train, *a, **k))
    rows = L.compare_variants(df, "id", ["a", "b"], trees=2, depth=3).collect()
    assert len(rows) == 4 and sorted(met) == sorted([sum(n.values()), 2 * n[0]] * 2)


def _gini(stats):
    return 1 - np.square(stats / stats.sum()).sum()


def test_first_cut_is_the_best_of_all():
    bins, label, count = _some()
    weights = np.array([1.0, 2.5])

    def held(rows):
        return np.array([(count * rows * (label == c)).sum() for c in (0, 1)]) * weights

    whole, worth = held(np.ones(len(label))), {}
    for f in range(bins.shape[1]):
        for cut in range(7):
            low = held(bins[:, f] <= cut)
            high = whole - low
            worth[f, cut] = _gini(whole) - (low.sum() * _gini(low) + high.sum() * _gini(high)) / whole.sum()
    tree = G.grow(bins, label, count, weights, 1, 1, 3, np.random.default_rng(1))
    best = max(worth, key=worth.get)
    assert (tree["feature"][0], tree["cut"][0]) == best
    assert np.isclose(tree["gain"][0], worth[best] * whole.sum())
    assert np.allclose(tree["stats"][0] * weights, whole) and np.allclose(tree["stats"][1] * weights, held(bins[:, best[0]] <= best[1]))


def test_cells_with_counts_grow_the_tree_of_their_rows():
    bins, label, count = _some(seed=3)
    every = np.repeat(np.arange(len(label)), count)
    one = G.grow(bins, label, count, np.ones(2), 30, 2, 2, np.random.default_rng(5))
    same = G.grow(bins[every], label[every], np.ones(len(every), int), np.ones(2), 30, 2, 2, np.random.default_rng(5))
    assert all(np.array_equal(one[k], same[k]) for k in one)
    at = np.bincount(G.leaves(one, bins[every]), minlength=len(one["feature"]))
    leaf = one["feature"] < 0
    assert np.array_equal(at[leaf], one["stats"].sum(axis=1)[leaf]) and at[~leaf].sum() == 0 and at[leaf].min() >= 2


def test_leaves_of_the_same_class_are_one():
    bins, label, count = _some(2000, seed=7)
    tree = G.grow(bins, label, count, np.ones(2), 30, 1, 2, np.random.default_rng(5))
    said, inner = tree["stats"].argmax(axis=1), np.flatnonzero(tree["feature"] >= 0)
    left = tree["left"][inner]
    both = (tree["feature"][left] < 0) & (tree["feature"][left + 1] < 0)
    assert both.any() and (said[left] != said[left + 1])[both].all()
    assert len(inner) * 2 + 1 == len(tree["feature"]) and sorted([*left, *(left + 1)]) == list(range(1, len(tree["feature"])))


def test_chunks_of_nodes_change_nothing(monkeypatch):
    bins, label, count = _some(3000, 4, seed=9)
    whole = G.grow(bins, label, count, np.ones(2), 30, 1, 2, np.random.default_rng(5))
    monkeypatch.setattr(G, "NODES", 3)
    cut = G.grow(bins, label, count, np.ones(2), 30, 1, 2, np.random.default_rng(5))
    assert all(np.array_equal(whole[k], cut[k]) for k in whole)


def test_every_value_gets_its_own_bin_if_they_are_few(spark):
    x = F.array((F.col("id") % 5).cast("double"), F.when(F.col("id") < 980, 0).otherwise(F.col("id")).cast("double"), F.lit(1.0))
    cuts = G.thresholds(spark.range(1000).select(x.alias("x")), 3)
    assert cuts[0] == [0.0, 1.0, 2.0, 3.0] and cuts[1] == [0.0, *map(float, range(980, 999))] and cuts[2] == []
    many = G.thresholds(spark.range(5000).select(F.array(F.when(F.col("id") < 4500, 0).otherwise(F.col("id")).cast("double")).alias("x")), 1)
    assert len(many[0]) == G.BINS - 1


def test_grown_forest_scores_as_well_as_sparks(spark, monkeypatch):
    df = L.stage(_rows(spark, 4000))
    train, test = L.split(df, "id")
    whole = L.fit_whole_forest(train, ["a", "b"], 20, 6, weighted=True)
    monkeypatch.setattr(L, "GROWN_NODES", 0)
    grown = L.fit_whole_forest(train, ["a", "b"], 20, 6, weighted=True)
    assert isinstance(grown, G.GrownForest) and not isinstance(whole, G.GrownForest)
    right = [m.transform(test).agg(F.avg((F.col("prediction") == F.col("target")).cast("int"))).first()[0] for m in (whole, grown)]
    assert right[1] > 0.9 and abs(right[0] - right[1]) < 0.02
    shares = dict(L.importances(grown, ["a", "b"]))
    assert sum(shares.values()) == pytest.approx(1) and shares["a"] == pytest.approx(dict(L.importances(whole, ["a", "b"]))["a"], abs=0.1)
    p = vector_to_array("probability")
    off = grown.transform(test).where((F.abs(p[0] + p[1] - 1) > 1e-9) | ((p[1] > p[0]) != (F.col("prediction") == 1)))
    assert off.count() == 0 and grown.transform(test).count() == test.count()


def test_grown_forest_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(L, "GROWN_NODES", 0)
    df = _rows(spark, 1000)
    one, other = (L.fit_whole_forest(d, ["a", "b"], 5, 30).transform(df).select("id", vector_to_array("probability")[1].alias("p"))
                  for d in (df.coalesce(1), df.repartition(7, "b")))
    assert sorted(one.collect()) == sorted(other.collect())


def test_grown_forest_survives_saving(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(L, "GROWN_NODES", 0)
    df = _rows(spark, 600).withColumn("target", F.pmod(F.col("id"), F.lit(3)).cast("bigint"))
    model = L.fit_whole_forest(df, ["a", "b"], 4, 5)
    for _ in range(2):        # the second takes the place of the first
        L.save_model(model, str(tmp_path), "m", ["a", "b"], 600, dt.datetime(2001, 1, 1))
    again = L.load_model(str(tmp_path), "m")
    a, b = (L.score(m, df, "id", dt.date(2001, 1, 1)).orderBy("id").collect() for m in (model, again))
    assert a == b and len(a) == 600 and {r["prediction"] for r in a} <= {0, 1, 2}


def test_odd_classes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(L, "GROWN_NODES", 0)
    with pytest.raises(ValueError):
        L.fit_whole_forest(_rows(spark, 50).withColumn("target", F.lit(-1)), ["a", "b"], 2, 2)


def test_grid_search_judges_every_setting_on_large_tables(spark, monkeypatch):
    """F2: the forests of all settings grow in tasks, with about the scores that Spark's forests get."""
    df = L.stage(_rows(spark, 1500).withColumn("b", F.col("b") + F.col("a")))
    grid = {"numTrees": (10, 20), "maxDepth": (1, 6), "minInstancesPerNode": (1, 200)}
    _, whole = L.grid_search(df, "id", ["a", "b"], grid, 3)
    monkeypatch.setattr(L, "GROWN_NODES", 0)
    best, scores = L.grid_search(df, "id", ["a", "b"], grid, 3)
    a, b = ({r["setting"]: r for r in rows.collect()} for rows in (whole, scores))
    assert list(a) == list(b) and len(b) == 8
    assert all(abs(a[s]["f1"] - b[s]["f1"]) < 0.05 and 0 <= b[s]["f1_std"] < 0.2 for s in b)
    assert isinstance(best, G.GrownForest) and best.trees.count() == (10 if "numTrees=10" in max(b, key=lambda s: b[s]["f1"]) else 20)


def test_grid_search_trains_without_the_fold_it_judges(spark, monkeypatch):
    monkeypatch.setattr(L, "GROWN_NODES", 0)
    met = []
    monkeypatch.setattr(L, "Ready", lambda prepare, data, *a: met.append(data) or G.Ready(prepare, data, *a))
    df = _rows(spark, 300)
    L.grid_search(df, "id", ["a", "b"], {"numTrees": (3,), "maxDepth": (2,)}, 3)
    assert [{r[0] for r in d.select("fold").distinct().collect()} for d in met] == [{1, 2}, {0, 2}, {0, 1}]
    assert [d.count() for d in met] == [df.where(L.fold("id", 3) != i).count() for i in range(3)]
