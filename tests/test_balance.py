"""Balancing on classes above the fit bound."""

from compare import diff, duck
from pyspark.sql import functions as F

from quaymart.operators import balance
from quaymart.plans import registry

registry.load_all()
LARGE = "/root/testdata/sf0.1"


def test_fit_sample_keeps_the_proportion(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("y"), (F.col("id") % 97).alias("a"))
    some = balance.fit_sample(df, "id", "y")
    n = {r["y"]: r["count"] for r in some.groupBy("y").count().collect()}
    assert 900 < n[1] < 1100 and 3.7 < n[0] / n[1] < 4.3
    out = balance.smote(some, "id", ["a"], "y").groupBy("y", "synthetic").count().collect()
    assert {(r["y"], r["synthetic"]): r["count"] for r in out} == {(0, False): n[0], (1, False): n[1], (1, True): n[0] - n[1]}
    assert balance.fit_sample(df.limit(1200), "id", "y").count() == 1200


def test_smote_balance_takes_the_whole_training_side(spark):
    got = registry.QUERIES["smote_balance"](spark, LARGE)
    con = duck(LARGE)
    assert not diff(got, con, registry.SQL_TWINS["smote_balance"])
    rows = {(r["target"], r["synthetic"]): r["n"] for r in got.collect()}
    assert max(rows.values()) > balance.FIT_ROWS and any(s for _, s in rows)
