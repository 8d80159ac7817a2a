"""Class balancing: stratified split, class weights, synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.operators.neighbours import nearest
from quaymart.operators.ranking import positions
from quaymart.session import stage

SEED = 42
MAX_CLASSES = 100
FIT_ROWS = 1000


def in_train(key: str, share: int = 80, seed: int = SEED) -> Column:
    """A row's side of the split, from its key alone.

    The hash (md5, which every engine has) is independent of the class, so each
    class is cut in the same proportion, and neither partitioning nor
    recomputation moves a row.
    """
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 100 < share


def fold(key: str, folds: int, seed: int = SEED) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(folds)).cast("int")


def fit_sample(df: DataFrame, key: str, label: str, rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """A sample of all classes at one common rate, by the hash of the key.

    The rate leaves about ``rows`` rows of the second largest class, so the
    neighbour search of ``smote``, which never meets the largest class, is
    bounded however large the table is, and the proportion of the classes, from
    which the number of synthetic rows follows, stays. No query fits on it:
    their models see all rows.
    """
    counts = sorted((r[1] for r in df.groupBy(label).count().collect()), reverse=True)
    if len(counts) < 2 or counts[1] <= rows:
        return df
    place = F.pmod(F.xxhash64(F.lit(seed + 4), F.col(key)), F.lit(1 << 40))
    return df.where(place < F.lit(int(rows / counts[1] * (1 << 40))))


def split_counts(df: DataFrame, key: str, label: str, share: int = 80) -> DataFrame:
    side = in_train(key, share)
    return df.groupBy(label).agg(F.count_if(side).alias("train_rows"),
                                 F.count_if(~side).alias("test_rows"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * rows of the class).

    The class counts become a constant expression: a join on the label would
    shuffle all rows to as many partitions as there are classes.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    total = sum(r["n"] for r in counts)
    weight = F.lit(None).cast("double")
    for r in counts:
        weight = F.when(F.col(label).eqNullSafe(F.lit(r[0])),
                        total / (len(counts) * r["n"])).otherwise(weight)
    return df.withColumn(name, weight)


def smote(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5,
          seed: int = SEED, ratio: float = 1.0) -> DataFrame:
    """Adds synthetic rows until every class has ``ratio`` times the rows of the largest.

    A synthetic row lies on the line from a minority row to one of its
    ``min(k, rows - 1)`` nearest rows of the same class (see ``neighbours``: exact in
    small classes, by buckets in large ones). Equal rows are neighbours at distance zero. Which neighbour, and how far along, follows
    from hashes of the row's key and the number of the synthetic row, so the
    result does not depend on the partitioning (only which of several vectors
    at the very same k-th distance is taken may vary). Output: features, label,
    ``synthetic``; the key of a synthetic row is NULL.
    """
    df = stage(df.select(key, label, *[F.col(c).cast("double").alias(c) for c in features]))
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    largest = max(counts.values(), default=0)
    out = df.withColumn("synthetic", F.lit(False))
    for value, n in counts.items():
        need = int(ratio * largest) - n
        if need > 0 and n > 1:
            rows = df.where(F.col(label) == value).select(
                key, F.array(*features).alias("x"))
            made = _synthesize(rows, key, min(k, n - 1), need, n, seed)
            out = out.unionByName(made.select(
                F.lit(None).cast(df.schema[key].dataType).alias(key),
                F.lit(value).cast(df.schema[label].dataType).alias(label),
                *[F.col("x")[i].alias(c) for i, c in enumerate(features)],
                F.lit(True).alias("synthetic")))
    return out


def _synthesize(rows: DataFrame, key: str, k: int, need: int, n: int, seed: int) -> DataFrame:
    spark = rows.sparkSession
    # Equal vectors become one point with a multiplicity: a vector that fills
    # a third of the class is searched once.
    vectors = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    vectors = stage(vectors.withColumn("id", F.monotonically_increasing_id()))
    found = nearest(vectors.select("id", "x"), k)
    found = found.join(vectors.select(F.col("id").alias("other"),
                                      F.col("copies").alias("weight")), "other")
    # At most k distinct neighbours per vector: a bounded list.
    lists = found.groupBy("id").agg(F.sort_array(F.collect_list(
        F.struct("d2", "y", F.least("weight", F.lit(k)).alias("weight")))).alias("l"))
    spread = F.flatten(F.transform(
        "l", lambda e: F.array_repeat(e["y"], e["weight"].cast("int"))))
    own = F.array_repeat(F.col("x"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    empty = F.array().cast("array<array<double>>")
    near = vectors.join(lists, "id", "left").select(
        "x", F.slice(F.concat(own, F.coalesce(spread, empty)), 1, k).alias("near"))
    order = positions(rows, [F.xxhash64(F.lit(seed), F.col(key)), F.col(key)], "place")
    parents = order.join(near, "x").select("place", "x", "near")
    made = spark.range(need).select("id", (F.pmod(F.col("id"), F.lit(n)) + 1).alias("place"))
    pick = F.pmod(F.xxhash64(F.lit(seed + 2), "id"), F.size("near")).cast("int")
    gap = F.pmod(F.xxhash64(F.lit(seed + 3), "id"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    placed = made.join(parents, "place").withColumns({"y": F.col("near")[pick], "u": gap})
    return placed.select(F.zip_with("x", "y", lambda a, b: a + F.col("u") * (b - a)).alias("x"))
