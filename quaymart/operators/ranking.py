"""Global ranks that never funnel all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quaymart.session import stage

# monotonically_increasing_id: partition number above, row number below.
_ROW_BITS = 33


def positions(df: DataFrame, order: Sequence[Column | str], name: str = "position",
              parts: int | None = None) -> DataFrame:
    """Add the 1-based global position under a total order.

    Rows are range-partitioned on the order and sorted within partitions; the
    result is staged, so the sampled range bounds are decided once. A row's
    position is its place in its partition plus the sizes of the partitions
    before, a prefix sum over one row per partition. The order should end in a
    key: a value shared by very many rows then still spreads over partitions.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__at", _ROW_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0))
                           .alias("__offset"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (placed.withColumn("__part", part).join(offsets, "__part")
            .withColumn(name, F.col("__offset") + inside + 1)
            .drop("__at", "__part", "__offset"))


def tile(position: Column | str, n: Column, tiles: int) -> Column:
    """NTILE from a position: the first ``n mod tiles`` tiles are one larger."""
    p = (F.col(position) if isinstance(position, str) else position) - 1
    size, extra = F.floor(n / tiles), n % tiles
    head = extra * (size + 1)
    small = F.greatest(size, F.lit(1).cast("bigint"))
    return (F.when(p < head, F.floor(p / (size + 1)))
            .otherwise(extra + F.floor((p - head) / small)) + 1).cast("bigint")


def with_ntile(df: DataFrame, tiles: int, order: Sequence[Column | str], name: str) -> DataFrame:
    """NTILE over all rows under a total order."""
    placed = positions(df, order, "__pos")
    n = placed.agg(F.count(F.lit(1))).scalar()
    return placed.withColumn(name, tile("__pos", n, tiles)).drop("__pos")


def global_rank(df: DataFrame, value: str, key: str, tiles: int | None = None) -> DataFrame:
    """Adds ``rank_asc`` and ``rank_desc`` (ties share the first place),
    ``percent_rank_asc`` as the pair (rank_asc - 1, n - 1), and optionally
    ``tile`` over (value, key) ascending.

    NULL counts as larger than any value, in both directions. The places of a
    value are found once per distinct value, staged, and joined back: a value
    held by a large part of the rows may then be split by the adaptive skew join.
    """
    placed = positions(df, [F.col(value).asc_nulls_last(), F.col(key)], "__pos")
    n = placed.agg(F.count(F.lit(1))).scalar()
    places = placed.groupBy(F.col(value).alias("__v")).agg(
        F.min("__pos").alias("rank_asc"), (n - F.max("__pos") + 1).alias("rank_desc"))
    out = placed.join(stage(places), F.col(value).eqNullSafe(F.col("__v"))).withColumn("row_total", n)
    if tiles:
        out = out.withColumn("tile", tile("__pos", n, tiles))
    return out.drop("__pos", "__v")


def dense_ranks(values: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Dense rank of the distinct ``value`` (descending) within ``by``.

    One global order of the distinct (by, value) pairs serves every group at
    once: the rank is the position minus the first position of the group. A
    group with very many values spans several partitions like any other rows.
    """
    by = list(by)
    pairs = values.select(*by, value).where(F.col(value).isNotNull()).distinct()
    placed = positions(pairs, [*by, F.col(value).desc()], "__pos")
    if not by:
        return placed.withColumnRenamed("__pos", name)
    first = placed.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.min("__pos").alias("__first"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    return (placed.join(stage(first), same)
            .withColumn(name, F.col("__pos") - F.col("__first") + 1)
            .drop("__pos", "__first", *[f"__{c}" for c in by]))
