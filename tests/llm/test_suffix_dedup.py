"""Repeated byte strings against a set of all windows; transforms against plain sorting."""

import hashlib
import random

import numpy as np

from quaymart.llm import suffix_dedup as S


def brute(docs):
    """docs: (order key, bytes), in order. What is removed, spans and digest of each."""
    seen, out = set(), {}
    for key, raw in sorted(docs):
        edge = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - S.SPAN + 1):
            w = raw[i:i + S.SPAN]
            if w in seen:
                edge[i] += 1
                edge[i + S.SPAN] -= 1
            seen.add(w)
        gone = np.cumsum(edge[:-1]) > 0
        left = bytes(b for b, g in zip(raw, gone.tolist()) if not g)
        spans = sum(1 for i, g in enumerate(gone.tolist()) if g and (i == 0 or not gone[i - 1]))
        out[key] = (len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return out


def check(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, at string, doc int").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup(df).collect()}
    assert got == brute([(d, (t or "").encode()) for d, t in rows])
    return got


def test_against_all_windows(spark):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdéfgh") for _ in range(rnd.randint(1, 8))) for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, line = text(70), text(25)
    rows = []
    for i in range(60):
        t = text(rnd.randint(1, 150))
        if i % 3 == 0:
            t = t[:rnd.randrange(len(t) + 1)] + passage[rnd.randrange(30):] + t[:50]
        if i % 4 == 0:
            t += "\n" + line
        if i % 10 == 9:
            t = rows[i - 5][1]
        if i % 10 == 8:
            near = list(rows[i - 5][1] or "x")
            near[rnd.randrange(len(near))] = "#"
            t = "".join(near)
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "a" * 5000), (103, "ab" * 700), (104, "x" * 99), (105, "x" * 100), (106, "x" * 100),
             (107, "y" * 100 + "z" + "y" * 100), (108, text(4000))]
    got = check(spark, rows)
    assert got[106][1] == 100 and got[105][1] == 0 and sum(v[1] > 0 for v in got.values()) > 20


def test_chunk_and_shard_borders(spark, monkeypatch):
    """Windows are looked at in chunks, cells sorted in shards: results do not depend on the cuts."""
    rnd = np.random.default_rng(1)
    base = rnd.integers(97, 103, 3000).astype(np.uint8).tobytes().decode()
    raw = np.frombuffer((base + base[500:1500]).encode(), np.uint8)
    offsets = np.array([0, 1700, len(raw)])

    def owned(chunk):
        monkeypatch.setattr(S, "CHUNK", chunk)
        out = {}
        for owner, first, count, gram, name, place in S.anchors(raw, offsets, wide=True):
            for o, f, c, g, p in zip(owner.tolist(), first.tolist(), count.tolist(), gram.tolist(), place.tolist()):
                for w in range(f, f + c):
                    assert (o, w) not in out
                    out[o, w] = (g, p)
        return out

    whole = owned(1 << 20)
    assert len(whole) == sum(max(0, b - a - S.SPAN + 1) for a, b in zip(offsets, offsets[1:]))
    assert owned(777) == whole


def test_repeats_of_cells(monkeypatch):
    rnd = np.random.default_rng(0)
    base = [rnd.integers(97, 101, 131).astype(np.uint8) for _ in range(20)]
    cells = []
    for _ in range(300):
        a = int(rnd.integers(0, 20))
        c = base[int(rnd.integers(20))][a:int(rnd.integers(a + 100, 132))].copy()
        if rnd.random() < 0.5:
            c[int(rnd.integers(len(c)))] = 120
        cells.append(c)
    doc, first = rnd.integers(0, 50, 300), np.arange(300) * 200
    seen, want = set(), []
    for d, s, w in sorted((d, f + i, c[i:i + S.SPAN].tobytes()) for d, f, c in zip(doc.tolist(), first.tolist(), cells) for i in range(len(c) - S.SPAN + 1)):
        if w in seen:
            want.append((d, s))
        seen.add(w)
    for shard in (1 << 20, 9000, 2500):
        monkeypatch.setattr(S, "SHARD", shard)
        d, s = S.repeats(cells, doc, first)
        assert sorted(zip(d.tolist(), s.tolist())) == sorted(want)


def test_transform_is_the_sorted_rotations():
    rnd = np.random.default_rng(5)
    strings = [rnd.integers(97, 99, int(n)).astype(np.uint8) for n in rnd.integers(100, 140, 12)]
    order, before = S.transform(strings)
    turns = []
    for s in strings:
        circle = [*s.tolist(), S.END]
        turns += [(tuple((circle * 3)[i:i + S.SPAN]), circle[i - 1]) for i in range(len(circle))]
    assert [t[0] for t in sorted(turns, key=lambda t: t[0])] == [turns[i][0] for i in order.tolist()]
    assert before.tolist() == [turns[i][1] for i in order.tolist()]


def test_shared_and_null_ids(spark):
    rnd = random.Random(6)
    t = "".join(rnd.choice("abcdefgh ") for _ in range(240))
    rows = [(1, t), (1, t), (1, t + "!"), (None, t), (2, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in S.dedup(df).collect()]
    # The NULL id comes first and keeps its text; every row with an id repeats it.
    assert sorted(got, key=str) == sorted([(None, 240, 0), (1, 240, 240), (1, 240, 240), (1, 241, 240), (2, 0, 0)], key=str)
    assert S.dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
