"""Approximate nearest neighbours by adaptive dimension scan over an inverted-list index.

Vectors are rotated by a random orthogonal matrix, so that any first d of D
dimensions are a random sample of all, and put into lists by their nearest
centroid (k-means on at most ``SAMPLE`` distinct vectors; every vector is
indexed). A list is cut into blocks of about ``BLOCK`` vectors, stored column
by column. A query scans blocks of its nearest lists ``STEP`` dimensions at a
time; after each step a vector whose partial distance is too large to be
compatible with the query's current bound is abandoned, by the hypothesis test
of adaptive sampling: partial > bound * d/D * (1 + ``DOUBT`` / sqrt(d))^2. What
is left is measured exactly, in double precision, on the original vectors.

First the nearest list is scanned, which gives each query its bound, then the
other probed lists. Lists and queries are joined in blocks of bounded size.
``PROBES`` is the share of all lists a query looks at; on data without any
structure it takes about this much for a recall of 0.9 (see the tests). Tables
of few lists are searched whole.

Of equal vectors only the ``k`` + 1 of the least ids are indexed, which is exact:
no query can have more of them among its k nearest.

Cases: vectors that are NULL, zero, of another length than most, or hold NULL
or non-finite components take no part, neither do NULL ids. Fewer than k
candidates: all of them that are found. Equal distances go to the least id. Repeated rows of
an id count once per distinct vector. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaymart.session import stage

K = 10
SAMPLE = 20_000
MAX_LISTS = 4096
BLOCK = 1024
QUERY_BLOCK = 256
STEP = 16
DOUBT = 2.1
PROBES = 0.6
LEAST_PROBES = 16        # lists that a query looks at in any case, if there are as many
ROUNDS = 8
SEED = 7


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids_of(x: np.ndarray, lists: int) -> np.ndarray:
    """k-means from evenly spread starts; an empty cluster keeps its centre."""
    rng = np.random.default_rng(SEED)
    centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)].astype(np.float64)
    for _ in range(ROUNDS):
        at = nearest_lists(x, centres, 1)[:, 0]
        total = np.zeros_like(centres)
        np.add.at(total, at, x)
        n = np.bincount(at, minlength=len(centres))
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest_lists(x: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    """The nearest ``count`` centres of each row, nearest first."""
    out = np.empty((len(x), count), np.int64)
    for a in range(0, len(x), 4096):
        part = x[a:a + 4096].astype(np.float64)
        far = (centres * centres).sum(axis=1) - 2 * part @ centres.T
        out[a:a + 4096] = np.argsort(far, axis=1, kind="stable")[:, :count] if count > 1 else far.argmin(axis=1)[:, None]
    return out


def vectors_of(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, vec``: the rows that take part."""
    vec = F.col(vec_col).cast("array<float>")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec")).filter("id is not null and vec is not null")
    finite = ~F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.filter(finite & F.exists("vec", lambda v: v != 0))
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (usual["n"] if usual else 0))


def _as_array(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)


def _place(centres: np.ndarray, probes: int, dim: int):
    """Task: (id, vec) to (id, vec, list, nth) for the ``probes`` nearest lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                at = nearest_lists(_as_array(part.column("vec"), dim), centres, probes)
                rows = pa.array(np.repeat(np.arange(part.num_rows), probes))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(rows), part.column("vec").take(rows), pa.array(at.reshape(-1).astype(np.int32)),
                     pa.array(np.tile(np.arange(probes, dtype=np.int32), part.num_rows))], ["id", "vec", "list", "nth"])

    return run


def _pack(turn: np.ndarray | None, dim: int, bounds: bool):
    """Task: the rows of one (list, block) to one row of packed arrays, rotated column by column."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        x = _as_array(table.column("vec").combine_chunks(), dim)[order]
        turned = np.ascontiguousarray((x.astype(np.float64) @ turn).astype(np.float32).T)
        cols = {"list": table.column("list")[:1], "ids": pa.array([ids[order].tobytes()], pa.binary()),
                "raw": pa.array([x.tobytes()], pa.binary()), "turned": pa.array([turned.tobytes()], pa.binary())}
        if bounds:
            cols["bound"] = pa.array([table.column("bound").to_numpy()[order].tobytes()], pa.binary())
        return pa.table(cols)

    return run


def scan_block(query: np.ndarray, turned_query: np.ndarray, bound: float, ids: np.ndarray, raw: np.ndarray,
               turned: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of a block within ``bound``: ids and exact distances, nearest first."""
    dim = len(turned_query)
    live = np.flatnonzero(ids != own)
    part = np.zeros(len(live), np.float64)
    limit = bound * bound * (1 + 1e-5)
    for a in range(0, dim, STEP):
        b = min(a + STEP, dim)
        gap = turned[a:b, live] - turned_query[a:b, None]
        part = part + np.einsum("ij,ij->j", gap, gap, dtype=np.float64)
        if np.isfinite(limit):
            slack = (1 + DOUBT / np.sqrt(b)) ** 2 if b < dim else 1 + 1e-4
            stays = part <= limit * (b / dim) * slack
            live, part = live[stays], part[stays]
            if not len(live):
                break
    far = np.sqrt(((raw[live].astype(np.float64) - query.astype(np.float64)) ** 2).sum(axis=1))
    order = np.lexsort((ids[live], far))[:k]
    order = order[far[order] <= bound]
    return ids[live][order], far[order]


def _scan(dim: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            for row in range(batch.num_rows):
                def get(name, kind, shape=-1):
                    return np.frombuffer(batch.column(name)[row].as_buffer(), kind).reshape(shape)

                ids, raw = get("ids", np.int64), get("raw", np.float32, (-1, dim))
                turned = get("turned", np.float32, (dim, -1))
                q_ids, q_raw, q_turned = get("q_ids", np.int64), get("q_raw", np.float32, (-1, dim)), get("q_turned", np.float32, (dim, -1))
                bound = get("q_bound", np.float64).copy()
                found = [scan_block(q_raw[i], np.ascontiguousarray(q_turned[:, i]), bound[i], ids, raw, turned, int(q_ids[i]), k) for i in range(len(q_ids))]
                counts = [len(f[0]) for f in found]
                if sum(counts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(q_ids, counts)), pa.array(np.concatenate([f[0] for f in found])),
                         pa.array(np.concatenate([f[1] for f in found]))], schema=schema)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest rows per query; the limit already applies before the shuffle."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(df: DataFrame, every: int = 100, k: int = K, probes: float = PROBES, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: queries are the rows whose id is divisible by ``every``."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = stage(vectors_of(df, id_col, vec_col))
    same = Window.partitionBy("vec").orderBy("id")
    index = stage(rows.distinct().withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1).drop("_n"))
    count = index.count()
    if not count:
        return empty
    sample = index.filter(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < F.lit(int(min(1.0, 2 * SAMPLE / count) * (1 << 30))))
    chosen = sample.orderBy(F.xxhash64("vec"), "vec", "id").limit(SAMPLE).toArrow()
    dim = len(chosen.column("vec")[0])
    lists = int(max(1, min(MAX_LISTS, round(count ** 0.5))))
    centres = centroids_of(_as_array(chosen.column("vec").combine_chunks(), dim), lists)
    lists = len(centres)
    turn = rotation(dim)

    placed = index.mapInArrow(_place(centres, 1, dim), "id bigint, vec array<float>, list int, nth int")
    sizes = stage(placed.groupBy("list").count().select(F.col("list").alias("of"), F.ceil(F.col("count") / BLOCK).alias("blocks")))
    blocks = stage(
        placed.join(F.broadcast(sizes), F.col("list") == F.col("of"))    # one row per list, at most MAX_LISTS
        .withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.col("blocks")))
        .groupBy("list", "block").applyInArrow(_pack(turn, dim, False), "list int, ids binary, raw binary, turned binary"))

    asked = rows.filter(F.col("id") % every == 0).distinct()
    wide = min(lists, max(LEAST_PROBES, round(lists * probes)))
    wanted = stage(asked.mapInArrow(_place(centres, wide, dim), "id bigint, vec array<float>, list int, nth int"))

    def scanned(queries: DataFrame) -> DataFrame:
        load = stage(queries.groupBy("list").count().select(F.col("list").alias("of"), F.ceil(F.col("count") / QUERY_BLOCK).alias("blocks")))
        packed = (
            queries.join(F.broadcast(load), F.col("list") == F.col("of"))
            .withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.col("blocks")))
            .groupBy("list", "block").applyInArrow(_pack(turn, dim, True), "list int, ids binary, raw binary, turned binary, bound binary")
        )
        packed = stage(packed.select("list", *[F.col(c).alias(f"q_{c}") for c in ("ids", "raw", "turned", "bound")]))
        pairs = blocks.join(packed, "list").drop("list").repartition(spark.sparkContext.defaultParallelism * 4)
        return pairs.mapInArrow(_scan(dim, k), "query_id bigint, vec_id bigint, score double")

    near = stage(_best(scanned(wanted.filter("nth = 0").withColumn("bound", F.lit(float("inf")))), k))
    bound = near.filter(F.col("rank") == k).select(F.col("query_id").alias("q"), F.col("score").alias("kth"))
    others = wanted.filter("nth > 0").join(bound, F.col("id") == F.col("q"), "left").withColumn("bound", F.coalesce("kth", F.lit(float("inf"))))
    more = scanned(others.select("id", "vec", "list", "bound"))
    best = _best(near.select("query_id", "vec_id", "score").unionByName(more), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
