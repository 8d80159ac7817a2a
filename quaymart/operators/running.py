"""Per-key running and rolling values that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.session import stage

HOT_ROWS = 1_000_000
MAX_BROADCAST_KEYS = 100_000


def range_parts(df: DataFrame, order: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """Adds ``__part``, the number of the row's range partition under an order; staged, so that the ranges are drawn once."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))


def same_keys(keys: Sequence[str], prefix: str) -> list[Column]:
    """Equality of key columns with their prefixed copies; NULL is a key like any other."""
    return [F.col(c).eqNullSafe(F.col(prefix + c)) for c in keys]


def prefix_sums(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], value: str, name: str,
                parts: int | None = None) -> DataFrame:
    """Adds the running sum of ``value`` per key under an order, without a task that holds a whole key.

    A segmented scan: rows are cut into ranges of (key, order), each range sums
    on its own, and what a range needs from those before it is one sum per key.
    """
    placed = range_parts(df, [*by, *order], parts)
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*by, "__part").agg(F.sum(value).alias("__sum"))
    carry = totals.select(F.col("__part").alias("__of"), *[F.col(c).alias(f"__{c}") for c in by],
                          F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn(name, F.sum(value).over(inside))
    joined = local.join(stage(carry), [F.col("__part") == F.col("__of"), *same_keys(by, "__")])
    return joined.withColumn(name, F.col(name) + F.col("__before")).select(*df.columns, name)


def running_by_key(df: DataFrame, key: str, order: Sequence[str], value: str,
                   rolling: int = 3, hot_rows: int = HOT_ROWS, parts: int | None = None) -> DataFrame:
    """Adds ``run_sum``, ``run_max``, ``roll_sum`` and ``roll_n`` of a bigint value.

    A plain window puts a whole key in one task. Keys are counted first; if
    none has more than ``hot_rows`` rows, that plain window is the plan.
    Otherwise the rows of the hot keys are scanned in segments: they are cut into
    ranges of (key, order, value), whatever the order looks like, and each range
    is windowed apart. What a range needs from those before it is small: their
    sum, their maximum and their last ``rolling - 1`` values per key. The ranges
    are drawn once and staged, so a recomputed task places every row as before.
    ``order`` must identify rows up to equal values.
    """
    back = rolling - 1
    hot = stage(df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
                .where(F.col("__n") > hot_rows).select(F.col(key).alias("__hot")))
    hot_keys = hot.count()
    plain = _windows(df, [key], order, value, back)
    if hot_keys == 0:
        return plain.drop("__row")
    if hot_keys <= MAX_BROADCAST_KEYS:
        hot = F.broadcast(hot)
    is_hot = F.col(key).eqNullSafe(F.col("__hot"))
    cool = _windows(df.join(hot, is_hot, "left_anti"), [key], order, value, back).drop("__row")
    cut = range_parts(df.join(hot, is_hot, "left_semi"), [key, *order, value], parts)
    local = _windows(cut, [key, "__part"], order, value, back)

    totals = cut.groupBy(key, "__part").agg(F.sum(value).alias("s"), F.max(value).alias("m"))
    newest = Window.partitionBy(key, "__part").orderBy(*[F.col(c).desc() for c in order])
    tails = (cut.withColumn("r", F.row_number().over(newest)).where(F.col("r") <= back)
             .groupBy(key, "__part")
             .agg(F.sort_array(F.collect_list(F.struct((-F.col("r")).alias("r"),
                                                       F.col(value).alias("x")))).alias("t")))
    tails = tails.select(F.col(key).alias("__key"), F.col("__part").alias("__of"), "t")
    same = [F.col(key).eqNullSafe(F.col("__key")), F.col("__part") == F.col("__of")]
    ranges = Window.partitionBy(key).orderBy("__part")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.join(tails, same, "left").select(
        F.col(key).alias("__key"), F.col("__part").alias("__of"), F.sum("s").over(before).alias("__csum"),
        F.max("m").over(before).alias("__cmax"),
        F.transform(F.flatten(F.collect_list("t").over(ranges.rowsBetween(-back, -1))),
                    lambda e: e["x"]).alias("__ctail"))
    joined = local.join(stage(carry), same)
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")
    tail = F.coalesce("__ctail", none)
    take = F.least(F.greatest(F.lit(rolling) - F.col("__row"), F.lit(0)), F.size(tail))
    part = F.when(take > 0, F.slice(tail, F.size(tail) - take + 1, take)).otherwise(none)
    known = F.filter(part, lambda x: x.isNotNull())
    whole = joined.withColumns({
        "run_sum": F.coalesce(F.col("run_sum") + F.coalesce("__csum", zero), F.col("__csum")),
        "run_max": F.greatest("run_max", "__cmax"),
        "roll_sum": F.coalesce("roll_sum", zero) + F.aggregate(known, zero, lambda a, x: a + x),
        "roll_n": F.col("roll_n") + F.size(known)})
    return cool.unionByName(whole.select(*cool.columns))


def _windows(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str,
             back: int) -> DataFrame:
    inside = Window.partitionBy(*groups).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    last = inside.rowsBetween(-back, 0)
    return df.withColumns({
        "__row": F.row_number().over(inside), "run_sum": F.sum(value).over(upto),
        "run_max": F.max(value).over(upto), "roll_sum": F.sum(value).over(last),
        "roll_n": F.count(value).over(last)})


def group_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Adds the key's ``group_sum``, ``group_n`` to each row; NULL is a key like any other.

    Aggregate and join back instead of a window: the aggregate combines
    map-side. It is staged, so the join has a plain shuffle on either side and
    a hot key's rows may be split.
    """
    stats = df.groupBy(F.col(key).alias("__key")).agg(F.sum(value).alias("group_sum"), F.count(value).alias("group_n"))
    return df.join(stage(stats), F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
