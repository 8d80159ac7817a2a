"""Connected components of a link table, by union-find in tasks and star rounds between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.session import stage


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one Arrow batch at a time: (node, root) with root < node."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while (up := parent.get(x, x)) != top:
                parent[x] = top
                x = up
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["u", "v"])


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour above a node is tied to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")))
    return both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node (always above its neighbours here) and its neighbours are tied to the least neighbour."""
    least = stage(links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"))
    tied = links.join(least, F.col("u") == F.col("w")).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``u, v``: every linked node that is not the least of its component, and that least node.

    ``links`` has two bigint columns. Rounds go on until nothing changes; each halves the depth or better. Every
    round is a table in the shared folder, so neither lineage nor a lost executor matters.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v")
    links = stage(links.mapInArrow(_forest, "u bigint, v bigint").distinct())
    mark = _mark(links)
    while mark[0]:
        links = stage(_small_star(stage(_large_star(links))))
        before, mark = mark, _mark(links)
        if before == mark:
            break
    return links
