"""Nearest neighbours: recall against brute force, exact scores, ties, odd vectors."""

import numpy as np

from quaymart.llm import ann


def brute(ids, x, query, k):
    far = np.sqrt(((x - x[query]) ** 2).sum(axis=1))
    far[ids == ids[query]] = np.inf
    order = np.lexsort((ids, far))
    return [(int(ids[i]), far[i]) for i in order[:k] if np.isfinite(far[i])]


def frame(spark, ids, x):
    rows = [(int(i), None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in zip(ids, x)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")


def test_recall_without_structure(spark):
    """Random directions, the hardest case for lists."""
    rnd = np.random.default_rng(1)
    x = rnd.standard_normal((3000, 64)).astype(np.float32)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    ids = rnd.permutation(3000)
    got = {}
    for r in ann.search(frame(spark, ids, x)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    at, hits = {int(i): n for n, i in enumerate(ids)}, 0
    assert sorted(got) == [i for i in range(0, 3000, 100)]
    for q, found in got.items():
        want = brute(ids, x.astype(np.float64), at[q], 10)
        assert [f[0] for f in sorted(found)] == list(range(1, 11))
        hits += len({f[1] for f in found} & {w[0] for w in want})
        for _, v, score in found:
            assert abs(score - np.linalg.norm(x[at[v]].astype(np.float64) - x[at[q]].astype(np.float64))) < 1e-12
    assert hits / (10 * len(got)) >= 0.9


def test_copies_ties_and_odd_vectors(spark):
    rnd = np.random.default_rng(2)
    x = list(rnd.integers(-2, 3, (60, 4)).astype(float)) + [np.array([1.0, 0, 0, 0])] * 300
    ids = list(range(360))
    odd = [(1000, None), (1100, [0.0] * 4), (1200, [1.0, None, 0, 0]), (1300, [float("nan"), 0, 0, 1]), (1400, [float("inf"), 0, 0, 1]), (1500, [1.0, 2.0])]
    df = frame(spark, ids + [i for i, _ in odd], x + [v for _, v in odd])
    got = {}
    for r in ann.search(df.unionByName(df.filter("vec_id = 100")), probes=1.0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    keep = [i for i in ids if np.any(x[i] != 0)]
    kept, m = np.array(keep), np.stack([x[i] for i in keep])
    assert sorted(got) == [q for q in (0, 100, 200, 300) if q in keep]
    for q, found in got.items():
        assert [found[k] for k in range(1, 11)] == brute(kept, m, keep.index(q), 10)


def test_few_rows(spark):
    df = frame(spark, [0, 1, 2], [[1.0, 0], [0, 1.0], [1.0, 1.0]])
    assert [(r.vec_id, r["rank"]) for r in ann.search(df).orderBy("rank").collect()] == [(2, 1), (1, 2)]
    assert ann.search(frame(spark, [], [])).count() == 0


def test_scan_keeps_the_nearest():
    rnd = np.random.default_rng(4)
    x = rnd.standard_normal((500, 64)).astype(np.float32)
    turn = ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    turned = np.ascontiguousarray((x @ turn).astype(np.float32).T)
    hits = 0
    for q in range(40):
        want = brute(np.arange(500), x.astype(np.float64), q, 10)
        ids, _ = ann.scan_block(x[q], turned[:, q], want[-1][1], np.arange(500), x, turned, q, 10)
        hits += len(set(ids.tolist()) & {w[0] for w in want})
    assert hits >= 380
