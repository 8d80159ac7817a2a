"""Operators that split hot groups agree with their plain definition."""

import random

import numpy as np
import pytest
from compare import plan_of
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.operators import balance, neighbours, quantiles, ranking, running


def values(spark, n=600, seed=1):
    """A third of the rows share one key, another third one value."""
    r = random.Random(seed)
    rows = [(i, 0 if i % 3 == 0 else r.randrange(20), 7 if i % 3 == 1 else r.randrange(50))
            for i in range(n)]
    rows += [(n, 1, None), (n + 1, 2, None)]
    return spark.createDataFrame(rows, "id bigint, k bigint, v bigint").repartition(6)


def test_global_rank_equals_window(spark):
    df = values(spark)
    got = {r["id"]: r for r in ranking.global_rank(df, "v", "id", tiles=7).collect()}
    up = Window.orderBy(F.col("v").asc_nulls_last())
    want = df.select(
        "id", F.rank().over(up).alias("a"),
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())).alias("d"),
        F.ntile(7).over(Window.orderBy(F.col("v").asc_nulls_last(), "id")).alias("t")).collect()
    assert len(got) == len(want) == 602
    for r in want:
        g = got[r["id"]]
        assert (g["rank_asc"], g["rank_desc"], g["tile"]) == (r["a"], r["d"], r["t"])
        assert g["row_total"] == 602


@pytest.mark.parametrize("n,tiles", [(3, 10), (10, 3), (100, 100), (101, 4)])
def test_ntile_sizes(spark, n, tiles):
    df = spark.range(n).withColumn("v", F.col("id") * 2)
    got = {r["id"]: r["t"] for r in ranking.with_ntile(df, tiles, ["v"], "t").collect()}
    want = df.select("id", F.ntile(tiles).over(Window.orderBy("v")).alias("t")).collect()
    assert got == {r["id"]: r["t"] for r in want}


def test_rank_plan_has_no_single_task_over_rows(spark):
    """The only one-task steps see one row per partition, or a count."""
    df = spark.range(10_000).withColumn("v", F.col("id") % 100)
    text = plan_of(ranking.positions(df, ["v", "id"]))
    before_window = text.split("Window")[1] if "Window" in text else ""
    assert "count" in before_window
    assert "RangePartitioning" not in text  # sorted data was staged, not sorted again


def test_dense_ranks(spark):
    df = values(spark).where(F.col("v").isNotNull())
    got = {(r["k"], r["v"]): r["d"] for r in ranking.dense_ranks(df, ["k"], "v", "d").collect()}
    w = Window.partitionBy("k").orderBy(F.col("v").desc())
    want = df.select("k", "v", F.dense_rank().over(w).alias("d")).collect()
    assert got == {(r["k"], r["v"]): r["d"] for r in want}


@pytest.mark.parametrize("hot_rows,rolling", [(10_000, 3), (25, 3), (0, 3), (25, 5)])
def test_running_slices_equal_plain_window(spark, hot_rows, rolling):
    df = values(spark).select("k", "v", F.col("id").alias("t"))
    got = running.running_by_key(df, "k", ["t"], "v", rolling, hot_rows)
    w = Window.partitionBy("k").orderBy("t")
    last = w.rowsBetween(-(rolling - 1), 0)
    want = df.select("k", "t", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"),
                     F.coalesce(F.sum("v").over(last), F.lit(0)).alias("rs"),
                     F.count("v").over(last).alias("rn"))
    a = {(r["k"], r["t"]): (r["run_sum"], r["run_max"], r["roll_sum"] or 0, r["roll_n"])
         for r in got.collect()}
    b = {(r["k"], r["t"]): (r["s"], r["m"], r["rs"], r["rn"]) for r in want.collect()}
    assert a == b and len(a) == 602


@pytest.mark.parametrize("accuracy", [10_000, 60])
def test_exact_quantiles(spark, accuracy):
    r = random.Random(5)
    rows = [("a", float(r.randrange(1000)) ** 2) for _ in range(700)]
    rows += [("a", 7.0)] * 350 + [("b", 1.5), ("b", 2.5), ("b", None), ("c", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, "x", probs, ["g"], accuracy).collect()
    assert {g["g"] for g in got} == {"a", "b", "c"}
    for g in got:
        x = [v for k, v in rows if k == g["g"] and v is not None]
        assert g["n"] == len(x)
        assert np.allclose([g[f"q{i}"] for i in range(5)], np.quantile(x, probs))


def test_one_key_and_one_day_are_split(spark):
    """All rows under one key at one time: many tasks hold a part of them, with the values of the plain window."""
    rows = spark.range(40_000, numPartitions=8).selectExpr("7 AS k", "DATE'2020-01-01' AS day", "id", "pmod(xxhash64(id), 1000) AS v")
    got = running.running_by_key(rows, "k", ["day", "id"], "v", 4, hot_rows=1000, parts=16)
    w = Window.partitionBy("k").orderBy("day", "id")
    last = w.rowsBetween(-3, 0)
    want = rows.withColumns({"run_sum": F.sum("v").over(w), "run_max": F.max("v").over(w), "roll_sum": F.sum("v").over(last),
                             "roll_n": F.count("v").over(last)})
    assert got.select(*want.columns).exceptAll(want).isEmpty() and got.count() == 40_000
    sizes = [r["count"] for r in running.range_parts(rows, ["k", "day", "id", "v"], 16).groupBy("__part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 40_000 / 16


def test_prefix_sums(spark):
    df = values(spark).select("k", "v", F.col("id").alias("t")).where("v IS NOT NULL")
    df = df.unionByName(df.limit(40).withColumn("k", F.lit(None).cast(df.schema["k"].dataType)))
    for by in ([], ["k"]):
        got = running.prefix_sums(df, by, [F.col("t").desc(), F.col("v")], "v", "s", parts=7)
        w = Window.partitionBy(*by).orderBy(F.desc("t"), "v").rowsBetween(Window.unboundedPreceding, 0)
        want = df.withColumn("s", F.sum("v").over(w))
        keyed = lambda d: sorted(map(str, d.select("k", "t", "v", *["s"][:bool(by)]).collect()))
        assert keyed(got) == keyed(want)
        assert sorted(r.s for r in got.collect())[-1] == sorted(r.s for r in want.collect())[-1]


def test_quantiles_of_a_million_values(spark, monkeypatch):
    """So many distinct values in the brackets that no single window may hold them."""
    rows = spark.range(1_000_000).selectExpr("IF(id % 3 = 0, 'a', NULL) AS g", "pmod(xxhash64(id), 1L << 40) / 7.0D AS x")
    monkeypatch.setattr(quantiles, "ONE_TASK_VALUES", 50)
    monkeypatch.setattr(quantiles, "Window", None)         # the plain window is not in reach
    for by in ([], ["g"]):
        got = {tuple(r[c] for c in by): (r.n, r.q0, r.q1) for r in quantiles.exact_quantiles(rows, "x", [0.5, 0.99], by, accuracy=2000).collect()}
        want = {tuple(r[c] for c in by): (r.n, *r.q) for r in
                rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.percentile("x", F.array(F.lit(0.5), F.lit(0.99))).alias("q")).collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=1e-14) for k in want)


def test_median_of_everything(spark):
    df = spark.createDataFrame([(1.0,), (None,), (10.0,), (4.0,), (2.0,)], "x double")
    assert df.limit(1).select(quantiles.exact_median(df, "x")).first()[0] == 3.0


def test_histogram_matches_numpy(spark):
    x = [0.0, 0.1, 1.0, 2.0, 2.0, 9.9, 10.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = sorted(tuple(r) for r in quantiles.histogram(df, "x", 5).collect())
    n, edges = np.histogram(x, 5)
    assert [g[3] for g in got] == n.tolist()
    assert np.allclose([g[1] for g in got], edges[:-1]) and np.allclose(got[-1][2], 10.0)


def cloud(n, dims, seed):
    r = np.random.default_rng(seed)
    m = r.normal(size=(n, dims))
    m[: n // 3] = m[0]          # a third of the points coincide
    m[n // 3: n // 2, 0] = 0.0  # ties along the first dimension
    return m


def near_rows(spark, m, k, **options):
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(m)], "id bigint, x array<double>")
    got: dict[int, list] = {}
    for r in sorted(neighbours.nearest(df, k, **options).collect(), key=lambda r: r["place"]):
        assert r["id"] != r["other"] and np.allclose(r["x"], m[r["id"]]) and np.allclose(r["y"], m[r["other"]])
        assert np.isclose(r["d2"], ((m[r["id"]] - m[r["other"]]) ** 2).sum())
        got.setdefault(r["id"], []).append(r["d2"])
    assert len(got) == len(m) and all(len(d) == k and d == sorted(d) for d in got.values())
    return got


def nearest_distances(m, k):
    d2 = ((m[:, None] - m[None]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    return np.sort(d2, axis=1)[:, :k]


def test_neighbours_of_few_points_are_exact(spark):
    m, k = cloud(240, 3, 3), 4
    got, want = near_rows(spark, m, k), nearest_distances(m, k)
    assert all(np.allclose(got[i], want[i]) for i in range(len(m)))


def test_neighbours_of_many_points(spark):
    """Buckets much smaller than the points, a third of which coincide: recall, and k rows for every point."""
    m, k = cloud(3000, 5, 3), 5
    got, want = near_rows(spark, m, k, bucket_rows=60), nearest_distances(m, k)
    hits = sum(d <= w[-1] * (1 + 1e-9) for i, w in enumerate(want) for d in got[i])
    assert hits >= 0.95 * want.size
    tiny = near_rows(spark, m[:400], 5, bucket_rows=3, tables=1)     # cells of less than k rows look further
    assert len(tiny) == 400


def test_visits_do_not_grow_with_the_points(spark):
    visits = {}
    for n in (20_000, 80_000):
        df = spark.range(n).select("id", F.array(*[F.randn(j) for j in range(5)]).alias("x"))
        placed, _, _ = neighbours.cells(df, n)
        sizes = neighbours.buckets(placed).groupBy("table", "cell", "share").count()
        visits[n] = sizes.agg(F.sum(F.col("count") * F.col("count")) / n).first()[0]
    limit = 2 * neighbours.TABLES * neighbours.BUCKET_ROWS
    assert visits[80_000] < 1.15 * visits[20_000] and max(visits.values()) < limit


def test_smote_balances_and_stays_between_neighbours(spark):
    m = cloud(60, 2, 9)
    rows = [(i, 1, *[float(v) for v in p]) for i, p in enumerate(m)]
    rows += [(100 + i, 0, float(i), float(-i)) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, y bigint, a double, b double")
    out = balance.smote(df, "id", ["a", "b"], "y", k=3)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 200, 1: 200}
    made = [(r["a"], r["b"]) for r in out.where("synthetic").collect()]
    assert len(made) == 140
    d2 = ((m[:, None] - m[None]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    near = np.argsort(d2, axis=1, kind="stable")
    kth = np.sort(d2, axis=1)[:, 2]
    for p in made:
        ok = False
        for i, x in enumerate(m):
            for j in near[i][:30]:
                if d2[i, j] > kth[i] + 1e-9:
                    break
                gap = np.linalg.norm(np.array(p) - x) + np.linalg.norm(np.array(p) - m[j])
                ok = ok or np.isclose(gap, np.sqrt(d2[i, j]), atol=1e-9)
            if ok:
                break
        assert ok, p
    again = balance.smote(df.repartition(5), "id", ["a", "b"], "y", k=3).where("synthetic")
    assert np.allclose(sorted((r["a"], r["b"]) for r in again.collect()), sorted(made))


def test_class_weights_and_split(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") % 10 == 0, 1).otherwise(0))
    weights = {r[0]: r[1] for r in balance.with_class_weights(df, "y").select(
        "y", "weight").distinct().collect()}
    assert weights == {0: pytest.approx(1000 / 1800), 1: pytest.approx(1000 / 200)}
    for r in balance.split_counts(df, "id", "y").collect():
        total = r["train_rows"] + r["test_rows"]
        assert 0.65 < r["train_rows"] / total < 0.95
    a = {r[0] for r in df.where(balance.in_train("id")).collect()}
    assert a == {r[0] for r in df.repartition(7).where(balance.in_train("id")).collect()}


def test_null_keys_and_values_keep_their_rows(spark):
    from quaymart.operators import quantiles, running, windows

    pay = spark.createDataFrame([(1, 10, 100, 5.0), (None, 11, 100, 7.0), (1, 12, 101, None), (1, 13, 101, 9.0)],
                                "customer_id bigint, rental_id bigint, film_id bigint, amount double").withColumn("payment_date", F.lit(None).cast("timestamp_ntz"))
    got = {r.rental_id: (r.payment_rank_within_customer, r.spend_rank) for r in windows.payment_ranks(pay).collect()}
    assert got == {10: (2, 1), 11: (1, 2), 12: (None, 1), 13: (1, 1)}
    stats = {r.rental_id: (r.group_sum, r.group_n) for r in running.group_stats(pay, "customer_id", "amount").collect()}
    assert stats == {10: (14.0, 2), 11: (7.0, 1), 12: (14.0, 2), 13: (14.0, 2)}
    q = {r.customer_id: r.q0 for r in quantiles.exact_quantiles(pay, "amount", [0.5], ["customer_id"]).collect()}
    assert q == {1: 7.0, None: 7.0}


def test_hot_key_of_group_stats_is_split(spark):
    """The final plan splits the half of the rows that one key holds."""
    from quaymart.operators import running

    options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 400_000, numPartitions=8).selectExpr("if(id % 2 = 0, 7, id) AS k", "pmod(xxhash64(id), 1000) AS v")
        out = running.group_stats(rows, "k", "v")
        out._jdf.queryExecution().toRdd().count()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
