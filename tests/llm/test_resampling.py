"""Importance resampling against a plain version; hashes of runs, ties, repeated rows, odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from quaymart.llm import resampling as R
from quaymart.session import stage

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=5, least=20):
    """(doc_id, n_features, weight, score) of all rows and the drawn ids in order."""
    made = [(r[0], *runs(r[1])) for r in rows]
    s = Counter(h % 10_000 for _, _, f in made for h in f)
    t = Counter(h % 10_000 for text in target for h in runs(text)[1])
    big_s, big_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in s}
    out = []
    for doc, n, f in made:
        weight, score = sum(gain[h % 10_000] for h in f), None
        if doc is not None:
            h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, n, len(f), weight, score))
    pool = sorted((-r[4], r[0]) for r in out if r[1] >= least and r[4] is not None)
    return [(r[0], *r[2:]) for r in out], [d for _, d in pool[:percent * len(pool) // 100]]


TARGET = ["one two Three", None, "", "ab " * 30, "日本 x-y z"]


def test_run_hashes():
    texts = ["Ab,cd  ef\x00gh", "", None, "x" * 700 + " y " + "z" * 95, "é日本 1 2"]
    (found, bounds) = R.run_hashes(pa.array(texts, pa.string()), R._move_tables())
    for i, text in enumerate(texts):
        got = [int(h) for hashes, whole in found for j, (h, ok) in enumerate(zip(hashes, whole)) if ok and bounds[i] <= j < bounds[i + 1]]
        assert sorted(got) == sorted(runs(text)[1])


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_against_brute(spark, docs, wide, rows, percent):
    odd = [(None, "no id " * 30, None, None, None), *[(500, "same row " * 20, None, None, None)] * 9]
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    extra = spark.createDataFrame(odd, docs.schema)
    want, drawn = brute([*rows, *odd], TARGET, percent)
    frame = docs.unionByName(extra)
    if percent == 40:
        frame = wide.unionByName(extra, allowMissingColumns=True)
    got = R.resample(frame, target, percent).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    assert [r.doc_id for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


def test_ties_and_narrow_draws(spark):
    rnd = random.Random(3)
    rows = [(i, 30, 0, 0, rnd.choice([5, 5, 5, 7, -3, None])) for i in range(997)]
    scored = stage(spark.createDataFrame(rows, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint").repartition(7))
    pool = sorted((-r[4], r[0]) for r in rows if r[4] is not None)
    for percent in (1, 37, 99):
        got = [r for r in R.draw(scored, percent).collect() if r["rank"]]
        assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"])] == [d for _, d in pool[:percent * len(pool) // 100]]


def test_nothing_to_draw(spark, empty):
    target = spark.createDataFrame([], "text string")
    assert R.resample(empty, target).collect() == []
    few = spark.createDataFrame([(1, "too short"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in R.resample(few, target).collect()}
    assert got[1].n_features == 3 and got[2].weight == 0 and got[1]["rank"] is None
