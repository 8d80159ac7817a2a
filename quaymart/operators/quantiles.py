"""Exact quantiles and histograms without gathering a group in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.operators.running import prefix_sums, same_keys
from quaymart.session import stage

# Values inside brackets that one window may put in order; more go through a segmented scan.
ONE_TASK_VALUES = 100_000


def brackets(probs: Sequence[float], accuracy: int, v: Column) -> Column:
    """n, and per probability a value range that surely holds the quantile.

    ``percentile_approx`` errs by at most n/accuracy ranks, so the sketch at
    p -/+ 3/accuracy encloses the exact order statistics once n > accuracy.
    Smaller groups use their full range.
    """
    eps = 3.0 / accuracy
    n, low, high = F.count(v), F.min(v), F.max(v)
    small = n <= accuracy
    edges = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-eps, eps)]
    sketch = F.percentile_approx(v, edges, accuracy)
    fields = []
    for i, _ in enumerate(probs):
        lo, hi = edges[2 * i], edges[2 * i + 1]
        fields += [F.when(small | F.lit(lo <= 0), low).otherwise(sketch[2 * i]).alias(f"lo{i}"),
                   F.when(small | F.lit(hi >= 1), high).otherwise(sketch[2 * i + 1]).alias(f"hi{i}")]
    return F.struct(n.alias("n"), *fields)


def exact_quantiles(df: DataFrame, value: Column | str, probs: Sequence[float],
                    by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Linear-interpolated quantiles ``q0, q1, ...`` and ``n`` per group; a NULL group is one, too.

    Two passes. The first brackets each quantile with a bounded sketch. The
    second counts the distinct values inside the brackets, and for the gaps
    between them only how many values fall there; both combine map-side. About
    ``6 n / accuracy`` values per quantile are left; if they are more than
    ``ONE_TASK_VALUES``, ranks come from a segmented scan over range partitions, so
    no task holds all values of a group. A rank that falls outside its bracket
    would fail the job, not give another value. ``df`` is read twice: stage it
    first if it is costly to compute.
    """
    v = F.col(value) if isinstance(value, str) else value
    by = list(by)
    rows = df.where(v.isNotNull()).select(*by, v.cast("double").alias("v"))
    if by:
        bounds = rows.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(brackets(probs, accuracy, F.col("v")).alias("b"))
        tagged = rows.join(stage(bounds), same_keys(by, "__")).drop(*[f"__{c}" for c in by])
    else:
        tagged = rows.withColumn("b", rows.agg(brackets(probs, accuracy, F.col("v")).alias("b")).scalar())
    inside, below = F.lit(False), []
    for i, _ in enumerate(probs):
        inside = inside | ((F.col("v") >= F.col(f"b.lo{i}")) & (F.col("v") <= F.col(f"b.hi{i}")))
        below.append(F.when(F.col("v") > F.col(f"b.hi{i}"), F.col(f"b.hi{i}")))
    # A value outside all brackets stands in the gap after the last bracket below it.
    gap_after = F.greatest(*below) if len(below) > 1 else below[0]
    slots = tagged.select(*by, F.col("b.n").alias("n"), (~inside).alias("gap"),
                          F.when(inside, F.col("v")).otherwise(gap_after).alias("at"))
    counted = stage(slots.groupBy(*by, "n", "at", "gap").agg(F.count(F.lit(1)).alias("c")))
    order = [F.col("at").asc_nulls_first(), F.col("gap")]
    ranked = _running(counted, by, order, "c", "cum")
    picks = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * float(p)
        for name, rank in ((f"a{i}", F.floor(h)), (f"b{i}", F.ceil(h))):
            picks.append(F.min(F.when(F.col("cum") >= rank + 1, F.struct("cum", "gap", "at"))).alias(name))
    picked = ranked.groupBy(*by, "n").agg(*picks)
    out = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * float(p)
        low, high = (F.when(F.col(f"{x}.gap"), F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
                     .otherwise(F.col(f"{x}.at")) for x in (f"a{i}", f"b{i}"))
        out.append((low + (h - F.floor(h)) * (high - low)).alias(f"q{i}"))
    return picked.select(*by, "n", *out)


def _running(counted: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Running sums of staged counts: one window per group while they are few, else a segmented scan."""
    if counted.count() > ONE_TASK_VALUES:
        return prefix_sums(counted, by, order, value, name)
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn(name, F.sum(value).over(upto))


def column_quantiles(df: DataFrame, heads: Mapping[str, Row], probs: Sequence[float]) -> DataFrame:
    """``column_name, q0, q1, ...`` of many columns in one pass over the rows.

    ``heads`` has what ``brackets`` found for each column in an earlier aggregate. A
    row gives one value for each bracket that it falls into, none for the others,
    and how many values lie below each bracket is observed on the way.
    """
    spark = df.sparkSession
    heads = {c: h for c, h in heads.items() if h["n"]}
    bounds = [(c, i, float(h[f"lo{i}"]), float(h[f"hi{i}"]), h["n"]) for c, h in heads.items() for i in range(len(probs))]
    if not bounds:
        return spark.createDataFrame([], "column_name string, " + ", ".join(f"q{i} double" for i in range(len(probs))))
    value = {c: F.col(c).cast("double") for c in heads}
    below = Observation()
    seen = df.observe(below, *[F.count_if(value[c] < F.lit(low)).alias(f"{c}:{i}") for c, i, low, _, _ in bounds])
    inside = [F.when(value[c].between(F.lit(low), F.lit(high)), F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("nth"), value[c].alias("x")))
              for c, i, low, high, _ in bounds]
    counted = stage(seen.select(F.inline(F.array_compact(F.array(*inside)))).groupBy("column_name", "nth", "x").agg(F.count(F.lit(1)).alias("c")))
    ranked = _running(counted, ["column_name", "nth"], [F.col("x")], "c", "cum")
    wanted = []
    for c, i, _, _, n in bounds:
        h = (n - 1) * float(probs[i])
        wanted.append((c, i, below.get[f"{c}:{i}"], math.floor(h) + 1, math.ceil(h) + 1, h - math.floor(h)))
    targets = spark.createDataFrame(wanted, "column_name string, nth int, below bigint, first bigint, second bigint, part double")
    # A few rows per column: how many, and which ranks they hold.
    placed = ranked.join(targets, ["column_name", "nth"]).withColumn("upto", F.col("below") + F.col("cum"))
    picked = placed.groupBy("column_name", "nth", "below", "first", "second", "part").agg(
        F.min(F.when(F.col("upto") >= F.col("first"), F.col("x"))).alias("a"), F.min(F.when(F.col("upto") >= F.col("second"), F.col("x"))).alias("b"),
        F.max("upto").alias("last"))
    held = (F.col("below") < F.col("first")) & (F.col("last") >= F.col("second"))
    q = F.when(held, F.col("a") + F.col("part") * (F.col("b") - F.col("a"))).otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
    return picked.groupBy("column_name").agg(*[F.max(F.when(F.col("nth") == i, q)).alias(f"q{i}") for i in range(len(probs))])


def exact_median(df: DataFrame, value: Column | str) -> Column:
    """The median as a scalar subquery."""
    return exact_quantiles(df, value, [0.5]).select("q0").scalar()


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max, the last one closed; empty bins kept."""
    spark = df.sparkSession
    rows = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    low, high = rows.agg(F.min("v")).scalar(), rows.agg(F.max("v")).scalar()
    width = (high - low) / float(bins)
    place = F.floor((F.col("v") - low) / F.nullif(width, F.lit(0.0)))
    counts = rows.groupBy(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(F.col("id").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin", (low + F.col("bin") * width).alias("lower"),
        (low + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
