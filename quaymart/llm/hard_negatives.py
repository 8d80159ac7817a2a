"""Hard negatives by inner product, over an inverted multi-index with certified stops.

Vectors become whole numbers (floor of ``SCALE`` times each component), so
scores are exact whatever the order of summation. Every vector is cut into two
halves; each half has a codebook (k-means on at most ``SAMPLE`` rows), and the
pair of nearest codes is the vector's cell. All rows are indexed; cells are
stored as blocks of about ``BLOCK`` rows, so a cell that holds a third of all
rows is many blocks.

A half of an anchor can score at most a.c + |a| r with the members of a code,
c being its centre and r the greatest distance of a member. An anchor visits
cells in falling order of the sum of both halves' bounds, which a heap over
the two sorted lists of codes yields one by one (multi-sequence). It stops at
the first sum below the score that could still change its result: then the
window is certified, and the result is that of a full search. Cells whose own
radii already show that they cannot matter are passed over.

Two searches run one after the other. The first finds an anchor's positives;
the score to beat is that of the last one found. The second finds, below each
positive's score, the first rows of other labels down to ``FLOOR`` of it. Each
search goes in rounds: a round lets every open anchor visit cells of at most
so many rows (``FIRST_ROWS``, then ``WIDER`` times more each), scores them in
blocks of vectors, and brings the bars up to date. Labels of at most
``FEW`` rows are one list, which their anchors read whole instead.

What reaches the driver: the sample, the codebooks and three numbers a cell
(at most ``CODES`` squared cells). How much is visited depends on the data:
vectors without any structure have loose bounds and every cell is read, in
blocks, which is still exact; clustered vectors stop early (see the tests).

Cases: rows with a NULL id, label or vector, a NULL or non-finite component,
another length than most vectors, or of length zero take no part; neither do
vectors whose squared length in whole numbers passes 2^56, whose scores might
not fit the result's type. Equal rows count once; rows that share the anchor's
id are never its positives or negatives. Fewer positives or negatives than
asked: all there are. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymart.llm.ann import centroids_of, nearest_lists
from quaymart.session import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
FLOOR = (4, 5)          # a negative scores at least 4/5 of the positive
SAMPLE = 20_000
CODES = 256
CELL_ROWS = 128
BLOCK = 1024
ANCHOR_BLOCK = 256
FIRST_ROWS = 4096
WIDER = 8
FEW = 2048
LONGEST = 1 << 56       # squared length of a vector in whole numbers
_LEAST = -(1 << 62)
_STATE = "a bigint, id bigint, label bigint, q binary, done bigint, low bigint, wins array<bigint>"


def _numbers(column: pa.Array, dim: int) -> np.ndarray:
    """A column of packed whole numbers as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, dim)


def _whole(dim: int, scale: int):
    """Task: (id, label, vec) to (id, label, q) with components as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * scale)
            with np.errstate(over="ignore"):
                fits = (x * x).sum(axis=1) <= LONGEST
            q = x[fits].astype(np.int32)
            keep = pa.array(fits)
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(keep), batch.column("label").filter(keep),
                                              pa.array([row.tobytes() for row in q], pa.binary())], ["id", "label", "q"])

    return run


def whole_rows(df: DataFrame, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> tuple[DataFrame, int]:
    """``id, label, q`` of the distinct rows that take part, and the number of components."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.filter("id is not null and label is not null and vec is not null and size(vec) > 0").filter(~odd)
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = usual["n"] if usual else 1
    return rows.filter(F.size("vec") == dim).mapInArrow(_whole(dim, scale), "id bigint, label bigint, q binary").distinct(), dim


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves; per code and per cell the radii, per cell the number of rows. Size: at most ``CODES`` squared cells."""

    books: tuple[np.ndarray, np.ndarray]
    code_radius: tuple[np.ndarray, np.ndarray]
    cell_radius: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray

    @property
    def cut(self) -> int:
        return self.books[0].shape[1]


def cells_in_order(index: Index, q: np.ndarray, low: int | None, done: int, budget: int) -> tuple[list[int], int, bool]:
    """The next cells of an anchor, how many it has gone through, and whether nothing is left that could matter.

    The multi-sequence heap holds one candidate per row of the (sorted codes x
    sorted codes) table that was begun, so each cell is met once.
    """
    halves = (q[:index.cut].astype(np.float64), q[index.cut:].astype(np.float64))
    score, size, order, best = [], [], [], []
    for half, book, radius in zip(halves, index.books, index.code_radius):
        plain, length = book @ half, float(np.sqrt(half @ half))
        # The slack covers rounding: a bound must never come out too small.
        bound = plain + length * radius
        bound += 1e-9 * (np.abs(plain) + length * (radius + np.sqrt((book * book).sum(axis=1)))) + 1e-6
        at = np.argsort(-bound, kind="stable")
        score.append(plain)
        size.append(length)
        order.append(at.tolist())
        best.append(bound[at].tolist())
    second = len(order[1])
    heap = [(-(best[0][0] + best[1][0]), 0, 0)]
    out, met, seen = [], 0, 0
    while heap:
        top, i, j = heap[0]
        if low is not None and -top < low:
            return out, met, True
        if seen >= budget:
            return out, met, False
        heapq.heappop(heap)
        if j == 0 and i + 1 < len(order[0]):
            heapq.heappush(heap, (-(best[0][i + 1] + best[1][0]), i + 1, 0))
        if j + 1 < second:
            heapq.heappush(heap, (-(best[0][i] + best[1][j + 1]), i, j + 1))
        met += 1
        cell = order[0][i] * second + order[1][j]
        if met <= done or not index.rows[cell]:
            continue
        if low is not None:
            near = sum(s[c] + z * r[cell] for s, c, z, r in zip(score, (order[0][i], order[1][j]), size, index.cell_radius))
            if near + 1e-9 * abs(near) + 1e-3 < low:
                continue
        out.append(cell)
        seen += int(index.rows[cell])
    return out, met, True


def _place(books: tuple[np.ndarray, np.ndarray], dim: int):
    """Task: adds the cell of each row and its distance from the cell's two centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = books[0].shape[1]
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x = _numbers(part.column("q"), dim).astype(np.float64)
                codes, far = [], []
                for half, book in zip((x[:, :cut], x[:, cut:]), books):
                    at = nearest_lists(half, book, 1)[:, 0]
                    codes.append(at)
                    far.append(np.sqrt(((half - book[at]) ** 2).sum(axis=1)))
                cell = codes[0] * len(books[1]) + codes[1]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(far[0]), pa.array(far[1])],
                                                 [*part.schema.names, "cell", "r1", "r2"])

    return run


def build_index(rows: DataFrame, dim: int, count: int) -> tuple[Index, DataFrame]:
    """The index of staged rows, and its blocks: ``cell, block, rows``."""
    spark = rows.sparkSession
    pick = F.xxhash64(F.lit(17), "id", "q")
    share = int(min(1.0, 2 * SAMPLE / count) * (1 << 30))
    sample = rows.filter(F.pmod(pick, F.lit(1 << 30)) < share).orderBy(pick, "id", "q", "label").limit(SAMPLE).select("q").toArrow()
    x = _numbers(sample.column("q").combine_chunks(), dim)
    codes = int(max(1, min(CODES, round((count / CELL_ROWS) ** 0.5), len(x))))
    cut = (dim + 1) // 2
    books = (centroids_of(x[:, :cut], codes), centroids_of(x[:, cut:], codes))
    placed = stage(rows.mapInArrow(_place(books, dim), "id bigint, label bigint, q binary, cell bigint, r1 double, r2 double"))
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
    n = np.zeros(len(books[0]) * len(books[1]), np.int64)
    radius = np.zeros((2, len(n)))
    for r in stats:
        n[r.cell], radius[0, r.cell], radius[1, r.cell] = r.n, r.r1, r.r2
    table = radius.reshape(2, len(books[0]), len(books[1]))
    index = Index(books, (table[0].max(axis=1), table[1].max(axis=0)), (radius[0], radius[1]), n)
    return index, stage(_blocks(placed, spark.createDataFrame([(r.cell, -(-r.n // BLOCK)) for r in stats], "of bigint, blocks bigint")))


def _blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``cell, block, blocks, rows`` of rows with a cell; ``sizes`` has the number of blocks, one row per cell."""
    dealt = rows.join(sizes, F.col("cell") == F.col("of")).withColumn("block", F.pmod(F.xxhash64("id", "q", "label"), F.col("blocks")))
    return dealt.groupBy("cell", "block", "blocks").agg(F.collect_list(F.struct("id", "label", "q")).alias("rows"))


def _visits(index: Index, dim: int, budget: int):
    """Task: the state of anchors to one row per cell that they visit next, and one (cell -1) with their new state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                q = _numbers(part.column("q"), dim)
                rows, cells, done, over = [], [], [], []
                for i, (low, met) in enumerate(zip(part.column("low").to_pylist(), part.column("done").to_pylist())):
                    found, met, ended = cells_in_order(index, q[i], low, met, budget)
                    rows += [i] * (len(found) + 1)
                    cells += [*found, -1]
                    done += [met] * (len(found) + 1)
                    over += [ended] * (len(found) + 1)
                part = part.take(pa.array(rows, pa.int64()))
                cols = {n: part.column(n) for n in part.schema.names} | {
                    "done": pa.array(done, pa.int64()), "cell": pa.array(cells, pa.int64()), "over": pa.array(over, pa.bool_())}
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in the narrowest floating type that holds every partial sum, or in 64-bit integers."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    x, y = a.astype(np.float64), b.astype(np.float64)
    most = np.sqrt((x * x).sum(axis=1).max() * (y * y).sum(axis=1).max()) * 1.001
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (x @ y.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best_of_rows(score: np.ndarray, able: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k highest able scores of each row; of equal ones the first columns."""
    held = np.where(able, score, _LEAST)
    n = held.shape[1]
    if n > k:
        able = able & (held >= np.partition(held, n - k, axis=1)[:, n - k, None])
    r, c = np.nonzero(able)
    order = np.lexsort((c, -held[r, c], r))
    r, c = r[order], c[order]
    first = np.searchsorted(r, r)
    keep = np.arange(len(r)) - first < k
    return r[keep], c[keep]


def _score(dim: int, k: int, floor: tuple[int, int]):
    """Task: a block of rows beside a block of anchors to the best rows of each anchor or of each of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                held, asked = (batch.column(c)[at].values for c in ("rows", "asked"))
                ids = held.field("id").to_numpy()
                order = np.argsort(ids, kind="stable")
                ids, labels = ids[order], held.field("label").to_numpy()[order]
                x = _numbers(held.field("q"), dim)[order]
                anchor = asked.field("a").to_numpy()
                score = products(_numbers(asked.field("q"), dim), x)
                able = ids[None, :] != asked.field("id").to_numpy()[:, None]
                same = labels[None, :] == asked.field("label").to_numpy()[:, None]
                low = asked.field("low").fill_null(_LEAST).to_numpy()
                able &= score >= low[:, None]
                wins = asked.field("wins").to_pylist()
                if wins[0] is None:
                    found = [(None, *best_of_rows(score, able & same, k))]
                else:
                    able &= ~same
                    found, most = [], max(map(len, wins))
                    for i in range(most):
                        win = np.array([w[i] if i < len(w) else -1 for w in wins])
                        fits = able & (score <= win[:, None]) & (floor[1] * score >= floor[0] * win[:, None]) & (win >= 0)[:, None]
                        found.append((win, *best_of_rows(score, fits, k)))
                for win, r, c in found:
                    if len(r):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(anchor[r]), pa.nulls(len(r), pa.int64()) if win is None else pa.array(win[r]), pa.array(ids[c]), pa.array(score[r, c])],
                            ["a", "win", "other", "score"])

    return run


def _scored(blocks: DataFrame, visits: DataFrame, dim: int, k: int, floor: tuple[int, int]) -> DataFrame:
    """``a, win, other, score``: the best rows of every (anchor block, row block). ``visits`` (staged) has the anchors by cell.

    Anchors go to each block of a cell, so a cell of many blocks is spread over as many tasks.
    """
    load = visits.groupBy(F.col("cell").alias("at")).agg(F.ceil(F.count(F.lit(1)) / ANCHOR_BLOCK).alias("parts"))
    sizes = blocks.groupBy(F.col("cell").alias("of")).agg(F.max("blocks").alias("blocks"))
    load = stage(load.join(sizes, F.col("at") == F.col("of")).select("at", "parts", "blocks"))
    dealt = visits.join(load, F.col("cell") == F.col("at")).withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")))
    packed = dealt.groupBy("cell", "part", "blocks").agg(F.collect_list(F.struct("a", "id", "label", "q", "low", "wins")).alias("asked"))
    packed = packed.select("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), "asked")
    held = blocks.join(load.select(F.col("at").alias("cell")), "cell", "left_semi").select("cell", "block", "rows")
    return held.join(packed, ["cell", "block"]).select("rows", "asked").mapInArrow(
        _score(dim, k, floor), "a bigint, win bigint, other bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best per anchor and window; the limit already applies before the shuffle."""
    order = Window.partitionBy("a", "win").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(index: Index, blocks: DataFrame, open_: DataFrame, dim: int, k: int, floor: tuple[int, int], bars) -> DataFrame:
    """All rounds of one search: ``a, win, other, score, rank``. ``bars`` gives each anchor's score to beat, from what is found so far."""
    spark = blocks.sparkSession
    best = spark.createDataFrame([], "a bigint, win bigint, other bigint, score bigint, rank int")
    state, budget = stage(open_), FIRST_ROWS
    while state.head(1):
        steps = stage(state.mapInArrow(_visits(index, dim, budget), f"{_STATE}, cell bigint, over boolean"))
        found = _scored(blocks, steps.filter("cell >= 0"), dim, k, floor)
        best = stage(_top(best.drop("rank").unionByName(found), k))
        left = steps.filter("cell = -1 and not over").drop("low", "cell", "over")
        state = stage(left.join(bars(left, best), "a", "left").select(*[c.split()[0] for c in _STATE.split(", ")]))
        budget *= WIDER
    return best


def _positive_bars(k: int):
    """The score of the k-th positive found."""
    return lambda open_, best: best.filter(F.col("rank") == k).select("a", F.col("score").alias("low"))


def _negative_bars(k: int, floor: tuple[int, int]):
    """The least, over an anchor's windows, of the k-th score found in it or else of its lower end."""

    def bars(open_: DataFrame, best: DataFrame) -> DataFrame:
        full = best.filter(F.col("rank") == k).select("a", "win", "score")
        wins = open_.select("a", F.explode("wins").alias("win"))
        return wins.join(full, ["a", "win"], "left").groupBy("a").agg(F.min(F.coalesce("score", _lower_end(F.col("win"), floor))).alias("low"))

    return bars


def _lower_end(win: Column, floor: tuple[int, int]) -> Column:
    return F.ceil(win * floor[0] / F.lit(floor[1]).cast("decimal(20,0)")).cast("bigint")


def mine(df: DataFrame, label: Column | str = "label", every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
         floor: tuple[int, int] = FLOOR, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; anchors are the rows whose id is divisible by ``every``."""
    rows, dim = whole_rows(df, F.col(label) if isinstance(label, str) else label, id_col, vec_col)
    rows = stage(rows)
    count = rows.count()
    if not count:
        return df.sparkSession.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    index, blocks = build_index(rows, dim, count)
    anchors = stage(rows.filter(F.col("id") % every == 0).withColumn("a", F.monotonically_increasing_id()))
    few = rows.groupBy(F.col("label").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    few = stage(few.filter(F.col("n") <= FEW).select("of", F.lit(1).cast("bigint").alias("blocks")))
    fresh = ["a", "id", "label", "q", F.lit(0).cast("bigint").alias("done"), F.lit(None).cast("bigint").alias("low"),
             F.lit(None).cast("array<bigint>").alias("wins")]

    open_ = anchors.join(few, F.col("label") == F.col("of"), "left_anti").select(*fresh)
    found = _search(index, blocks, open_, dim, positives, floor, _positive_bars(positives))
    # Labels of few rows: one list each, which all anchors of the label read whole.
    lists = stage(_blocks(rows.withColumn("cell", F.col("label")), few))
    rare = stage(anchors.join(few, F.col("label") == F.col("of"), "left_semi").select(*fresh, F.col("label").alias("cell")))
    found = stage(found.unionByName(_top(_scored(lists, rare, dim, positives, floor), positives)))

    windows = found.filter("score >= 0").groupBy("a").agg(F.collect_set("score").alias("wins"))
    low = F.array_min(F.transform("wins", lambda w: _lower_end(w, floor)))
    state = anchors.join(windows, "a").select("a", "id", "label", "q", F.lit(0).cast("bigint").alias("done"), low.alias("low"), "wins")
    hard = _search(index, blocks, state, dim, negatives, floor, _negative_bars(negatives, floor))
    pairs = found.select("a", F.col("other").alias("positive_id"), F.col("score").alias("win"))
    named = anchors.select("a", F.col("id").alias("anchor_id"))
    return named.join(pairs, "a").join(hard, ["a", "win"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        F.col("win").alias("positive_score"), F.col("score").alias("negative_score"))
