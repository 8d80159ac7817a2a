"""Hard negatives against a full search; certified stops, rare labels, hot vectors, odd rows, exact products."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymart.llm import hard_negatives as H
from quaymart.session import stage

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, every=100, positives=5, negatives=5):
    sized = defaultdict(int)
    good = {(i, tuple(math.floor(256 * x) for x in v), lab) for i, v, lab in rows
            if i is not None and v and lab is not None and all(x is not None and math.isfinite(x) for x in v)}
    for _, v, _ in good:
        sized[len(v)] += 1
    dim = max(sized, key=lambda n: (sized[n], -n), default=0)
    good = [r for r in good if len(r[1]) == dim and sum(x * x for x in r[1]) <= 1 << 56]
    out = []
    for i, v, lab in good:
        if i % every:
            continue
        score = sorted((-sum(map(int.__mul__, v, w)), j, lab == other) for j, w, other in good if j != i)
        for p, j, _ in [s for s in score if s[2]][:positives]:
            hard = [(n, m) for n, m, same in score if not same and 80 * -p <= 100 * -n <= 100 * -p][:negatives]
            out += [(i, j, rank, m, -p, -n) for rank, (n, m) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r) for r in H.mine(df, **options).collect())


def made(n, dim, labels, seed=1, spread=1.0, centres=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * spread
    if centres:
        x += rng.standard_normal((centres, dim))[rng.integers(0, centres, n)]
    return [(i, [float(c) for c in v], int(rng.integers(0, labels))) for i, v in enumerate(x / np.sqrt(dim))]


def test_odd_rows(spark):
    rows = made(400, 7, 3)
    rows += [(None, [1.0] * 7, 1), (401, None, 1), (402, [1.0] * 7, None), (403, [1.0, None] + [1.0] * 5, 1), (404, [math.nan] * 7, 1),
             (405, [math.inf] * 7, 2), (406, [], 0), (407, [1.0] * 8, 0), (408, [1e30] * 7, 0), (500, [0.0] * 7, 1), (501, [0.0] * 7, 2), (502, [-1.0] * 7, 1),
             *[rows[100]] * 3, (100, [9.0] * 7, 1), (100, [9.0] * 7, 2), *[(600 + i, [1.0] * 7, i % 3) for i in range(40)]]
    assert mined(spark, rows, every=10) == brute(rows, every=10)


def test_few_rows_and_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.9], 1), (2, [1.0, 1.85], 2), (3, [-1.0, -2.0], 2), (100, [0.5, 0.5], 7)]
    assert mined(spark, rows) == brute(rows) == [(0, 1, 1, 2, *(lambda p, n: (p, n))(*(256 * 256 + 512 * math.floor(256 * y) for y in (1.9, 1.85))))]


def test_clashing_columns(spark):
    rows = made(60, 4, 2)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "q", "a", "cell", "block", "rank", "score", "win", "of", "low")})
    assert sorted(tuple(r) for r in H.mine(df, every=5).collect()) == brute(rows, every=5)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"FEW": 30, "FIRST_ROWS": 64, "BLOCK": 32, "ANCHOR_BLOCK": 8, "CELL_ROWS": 16}.items():
        monkeypatch.setattr(H, name, value)


def test_rounds_and_blocks(spark, small_blocks):
    """Many rounds, cells of many blocks, a hot vector in a third of the rows, labels of few rows beside large ones."""
    rows = made(900, 6, 4, centres=12, spread=0.2)
    rows = [(i, [0.5] * 6 if i % 3 == 0 else v, 1000 + i % 20 if i % 40 == 0 else lab) for i, v, lab in rows]
    assert mined(spark, rows, every=10) == brute(rows, every=10)


def test_clustered_vectors_stop_early(spark, small_blocks):
    """Where vectors are clustered, an anchor visits a small part of the rows, and still gets the full result."""
    rows = made(4000, 8, 3, centres=60, spread=0.02)
    df = spark.createDataFrame(rows, SCHEMA)
    whole, dim = H.whole_rows(df, F.col("label"))
    whole = stage(whole)
    index, _ = H.build_index(whole, dim, whole.count())
    held = [(r.id, r.label, np.frombuffer(r.q, np.int32).astype(np.int64)) for r in whole.collect()]
    seen = []
    for i, label, q in held:
        if i % 100 == 0:
            fifth = sorted(int(v @ q) for j, other, v in held if other == label and j != i)[-5]
            cells, _, over = H.cells_in_order(index, q, fifth, 0, 1 << 60)
            assert over
            seen.append(index.rows[cells].sum())
    assert np.mean(seen) < 0.25 * len(rows)
    assert mined(spark, rows, every=100) == brute(rows)


def test_cells_come_in_order_of_their_bounds():
    rng = np.random.default_rng(4)
    books = (rng.standard_normal((5, 3)) * 100, rng.standard_normal((4, 2)) * 100)
    index = H.Index(books, (rng.random(5) * 50, rng.random(4) * 50), (np.zeros(20), np.zeros(20)), np.ones(20, np.int64))
    q = rng.integers(-100, 100, 5)
    bound = [b @ h + np.sqrt(h @ h) * r for b, h, r in zip(books, (q[:3], q[3:]), index.code_radius)]
    want = sorted(range(20), key=lambda c: -(bound[0][c // 4] + bound[1][c % 4]))
    assert H.cells_in_order(index, q, None, 0, 1 << 60) == (want, 20, True)
    first, met, over = H.cells_in_order(index, q, None, 0, 7)
    assert not over and first + H.cells_in_order(index, q, None, met, 1 << 60)[0] == want


def test_products_and_ties():
    big = 1 << 27
    a = np.array([[big, 1], [big, -big], [3, 4]], np.int32)
    assert H.products(a, a).tolist() == [[int(x) * int(y) + int(z) * int(w) for y, w in a.tolist()] for x, z in a.tolist()]
    score = np.array([[5, 5, 5, 7, 5, 1]])
    able = np.array([[True, False, True, True, True, True]])
    assert H.best_of_rows(score, able, 3)[1].tolist() == [3, 0, 2]
