"""Forests that the driver grows block by block."""

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quaymart.operators import models as L


def _rows(spark, n=600):
    noise = F.pmod(F.xxhash64("id"), F.lit(100))
    return spark.range(n).select("id", (F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
                                 F.when((F.col("id") % 37 > 18) & (noise < 90), 1).otherwise(0).cast("bigint").alias("target"))


def test_trees_are_not_sent_to_the_tasks_of_every_pass(spark):
    assert L._forest(3, 4, False).getCacheNodeIds()


def test_large_forest_is_stored_in_blocks_that_vote_together(spark, monkeypatch):
    df = _rows(spark)
    monkeypatch.setattr(L, "WHOLE_NODES", 1000)
    monkeypatch.setattr(L, "BLOCK_NODES", 3600)
    model = L.fit_forest_blocks(df, ["a", "b"], trees=100, depth=8, weighted=True)
    sizes = [n for _, n in model.blocks]
    assert sum(sizes) == 100 and len(sizes) > 1 and sizes[0] == 3
    parts = [RandomForestClassificationModel.load(p) for p, _ in model.blocks]
    assert [p.getNumTrees for p in parts] == sizes
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    ready = model.prepare.transform(df)
    votes = {}
    for part in parts:
        for r in part.transform(ready).select("id", vector_to_array("rawPrediction").alias("v")).collect():
            votes[r["id"]] = [x + y for x, y in zip(votes.get(r["id"], [0.0, 0.0]), r["v"])]
    assert got == {i: float(v[1] > v[0]) for i, v in votes.items()}
    right = {r["id"]: r["target"] for r in df.collect()}
    assert sum(got[i] == right[i] for i in got) > 500


def test_small_forest_stays_whole(spark):
    df = _rows(spark, 200)
    whole = L.fit_forest(df, ["a", "b"], 5, 4)
    same = L.fit_forest_blocks(df, ["a", "b"], 5, 4)
    assert same.stages[-1].toDebugString.split("\n")[1:] == whole.stages[-1].toDebugString.split("\n")[1:]
