"""Quality rules: fixed counts against plain Python, the model on held-out labels."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quaymart.llm import quality
from quaymart.llm.common import read

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def test_counts(spark, wide, rows, empty):
    keep_all = quality.train(empty, spark.createDataFrame([], "doc_id bigint, quality int"))
    got = quality.judge(wide, keep_all).collect()
    texts = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        n, *_, repeated = want = plain(texts[r.doc_id])
        assert tuple(r[c] for c in quality.COLUMNS) == want
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and r.kept == (not r.base_failed)
    assert quality.judge(empty, keep_all).count() == 0


def test_odd_texts():
    texts = ["a b a b a b", "x\n\nx\n x\nx ", "# $", "a\x0bb\x85c d", "l\r\nl\r\nl", "a b c a b c", None, "\n\n", "w " * 5000]
    m = quality.measures(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert tuple(int(m[c][i]) for c in quality.COLUMNS) == plain(t), t


def test_held_out_labels(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    model = quality.train(docs, labels.filter("doc_id % 3 <> 0"))
    got = quality.judge(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").filter("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert len(good) > 50 and len(bad) > 3 and np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_texts_do_not_mix():
    texts = ["Hello ## world", "", None, "a", "ab", "UP DOWN!! UP", "one two"]
    whole = quality.features(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], quality.features(pa.array([t], pa.string()))[0], atol=1e-6)
    w = np.random.default_rng(1).standard_normal(quality.DIM)
    p = quality.Model(w, 0.1, 2.0, -0.3).probabilities(pa.array(texts, pa.string()))
    assert np.allclose(p, 1 / (1 + np.exp(-(2.0 * (whole @ w + 0.1) - 0.3))), atol=1e-4)
