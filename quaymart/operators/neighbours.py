"""Near rows (euclidean) without comparing all pairs: buckets of random projections, exact distances inside them.

``BucketedRandomProjectionLSH`` projects every point on random directions.
Each of ``TABLES`` tables cuts the points along its own directions, one after
the other, at quantiles of the projections, so that buckets hold about
``BUCKET_ROWS`` points wherever the points are dense or thin. Near points share
a bucket in at least one table with high probability. Inside a bucket all
distances are computed; per point the k least of all tables stay. Then each
point looks once at the neighbours of its neighbours, which finds most of those
that every table has cut off.

A point meets about ``TABLES * BUCKET_ROWS + k * k`` others however many there are.
Distances are exact, and no point is left out; which points are met is
approximate beyond ``2 * BUCKET_ROWS`` points, and exact up to it. Buckets that
cannot be cut (equal projections) are dealt by a hash. A point that finds less
than k looks again in ever larger cells of the first table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.session import stage

BUCKET_ROWS = 128
TABLES = 8
MOST_WAYS = 16
SEED = 42
_PAIR = "id bigint, other bigint, d2 double"


def _closest(ids: np.ndarray, x: np.ndarray, ask: np.ndarray, k: int) -> pd.DataFrame:
    """Up to k nearest rows of a bucket for those of its rows that ask, in blocks of bounded size."""
    out = {"id": [], "other": [], "d2": []}
    asking = np.flatnonzero(ask)
    step = max(1, 2_000_000 // max(1, len(x)))
    take = min(k, len(x) - 1)
    for s in range(0, len(asking) if take else 0, step):
        at = asking[s:s + step]
        d2 = np.zeros((len(at), len(x)))
        for j in range(x.shape[1]):
            d2 += np.square(x[at, j][:, None] - x[None, :, j])
        d2[np.arange(len(at)), at] = np.inf
        near = np.argpartition(d2, take - 1, axis=1)[:, :take]
        out["id"].append(np.repeat(ids[at], take))
        out["other"].append(ids[near.ravel()])
        out["d2"].append(np.take_along_axis(d2, near, axis=1).ravel())
    kinds = {"id": "int64", "other": "int64", "d2": "float64"}
    return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, kinds[c]) for c, v in out.items()})


def projections(points: DataFrame, directions: int, seed: int = SEED) -> DataFrame:
    """Adds ``p``: the place of each point along random directions, in steps far below the spread of the points."""
    vectors = points.withColumn("__v", array_to_vector("x"))
    dims = F.size(points["x"])
    spread = points.select(F.posexplode("x").alias("axis", "c")).groupBy("axis").agg(F.var_pop("c").alias("v")).agg(F.sum("v")).first()[0]
    lsh = BucketedRandomProjectionLSH(inputCol="__v", outputCol="__h", numHashTables=directions, seed=seed,
                                      bucketLength=max(math.sqrt(spread or 0.0), 1e-300) / (1 << 20))
    placed = lsh.fit(vectors.where(dims > 0)).transform(vectors)
    return placed.select("id", "x", F.transform("__h", lambda h: vector_to_array(h)[0]).alias("p"))


def cells(points: DataFrame, n: int, bucket_rows: int = BUCKET_ROWS, tables: int = TABLES, seed: int = SEED) -> tuple[DataFrame, int, int]:
    """``id, x, table, cell`` once per table, the number of levels, and the ways a cell is cut at each."""
    levels = max(1, math.ceil(math.log(max(1.0, n / bucket_rows), MOST_WAYS)))
    ways = max(2, math.ceil((n / bucket_rows) ** (1 / levels)))
    steps = [i / ways for i in range(1, ways)]
    out = projections(points, tables * levels, seed).select(
        "id", "x", "p", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("table"), F.lit(0).cast("bigint").alias("cell"))
    for level in range(levels):
        at = F.col("p")[F.col("table") * levels + level]
        cuts = stage(out.groupBy("table", "cell").agg(F.percentile_approx(at, steps, 1000).alias("cuts")))
        slot = F.size(F.filter("cuts", lambda c: c < at)).cast("bigint")
        out = out.join(cuts, ["table", "cell"]).withColumn("cell", F.col("cell") * ways + slot).drop("cuts")
    return stage(out.select("id", "x", "table", "cell")), levels, ways


def buckets(placed: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``share``: cells of more than twice the rows wanted are dealt by a hash of the id."""
    crowd = placed.groupBy("table", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * bucket_rows)).alias("shares"))
    return placed.join(stage(crowd), ["table", "cell"]).withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares"))).drop("shares")


def _pairs(bucketed: DataFrame, k: int) -> DataFrame:
    """The k nearest inside its bucket for each row with ``ask``."""

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        return _closest(pdf["id"].to_numpy(), np.array(pdf["x"].tolist(), dtype=float), pdf["ask"].to_numpy(dtype=bool), k)

    return bucketed.groupBy("table", "cell", "share").applyInPandas(inside, _PAIR)


def _first_k(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("id").orderBy("d2", "other")
    return found.dropDuplicates(["id", "other"]).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def _named(found: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs with both vectors."""
    return (found.join(points, "id")
            .join(points.select(F.col("id").alias("other"), F.col("x").alias("y")), "other")
            .select("id", "x", "other", "y", "d2", "place"))


def _refined(near: DataFrame, k: int) -> DataFrame:
    """Pairs (staged) with the neighbours of neighbours taken in: lists of at most k meet, no groups."""
    lists = near.groupBy(F.col("id").alias("of")).agg(F.collect_list(F.struct("other", "y")).alias("near"))
    met = near.select("id", "x", F.col("other").alias("via")).join(lists, F.col("via") == F.col("of"))
    met = met.select("id", "x", F.explode("near").alias("n")).select("id", "x", "n.other", "n.y").where(F.col("id") != F.col("other"))
    gaps = F.zip_with("x", "y", lambda a, b: (a - b) * (a - b))
    met = met.withColumn("d2", F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap))
    return _first_k(near.drop("place").unionByName(met), k)


def nearest(points: DataFrame, k: int, bucket_rows: int = BUCKET_ROWS, tables: int = TABLES, seed: int = SEED) -> DataFrame:
    """(id, x, other, y, d2, place) for points (id bigint, x array<double>).

    ``place`` runs from 1 to ``min(k, rows - 1)`` by distance, then by the other id.
    """
    points = stage(points.select("id", "x"))
    n = points.count()
    bucket_rows = max(bucket_rows, 4 * k)        # a share dealt by hash must hold more than k rows
    if n <= 2 * bucket_rows:
        one = points.withColumns({"table": F.lit(0), "cell": F.lit(0), "share": F.lit(0), "ask": F.lit(True)})
        return _named(_first_k(_pairs(one, k), k), points)
    placed, levels, ways = cells(points, n, bucket_rows, tables, seed)
    found = stage(_first_k(_pairs(buckets(placed, bucket_rows).withColumn("ask", F.lit(True)), k), k))
    first = placed.where(F.col("table") == 0)
    for level in range(levels - 1, -1, -1):
        full = found.where(F.col("place") == k).select("id")
        short = stage(first.join(full, "id", "left_anti").select("id"))
        if not short.head(1):
            break
        wider = first.withColumn("cell", F.floor(F.col("cell") / ways ** (levels - level)))
        asked = wider.join(short.withColumn("ask", F.lit(True)), "id", "left")
        touched = stage(asked.where("ask").select("cell").distinct())
        dealt = buckets(asked.join(touched, "cell", "left_semi").withColumn("ask", F.coalesce("ask", F.lit(False))), bucket_rows)
        found = stage(_first_k(found.drop("place").unionByName(_pairs(dealt, k)), k))
    return _refined(stage(_named(found, points)), k)
