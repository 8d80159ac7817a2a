"""Near-duplicates against brute force; signatures against the definition; components against plain union-find."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quaymart.llm import groups, near_dup

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    top = {d: d for d, _ in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            both = len(x & y)
            if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
                ra, rb = root(a), root(b)
                top[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d in top}


def test_classes(wide, rows):
    got = near_dup.classes(wide).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    sizes = {r[0]: len(shingles(r[1])) for r in rows}
    for r in got:
        assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], want[r.doc_id])


def test_large_group_with_outliers(spark):
    """Copies with many edits share buckets with all others; only real links count."""
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocab) for _ in range(120)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(rnd.choice([0, 1, 2, 4, 8, 12])):
            text[rnd.randrange(120)] = rnd.choice(vocab)
        rows.append((1000 - i, " ".join(text), None, None, None))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in near_dup.classes(df).collect()} == want
    assert len(set(want.values())) > 3


def test_edited_group_without_the_text_itself(spark, monkeypatch):
    """Copies that are all edited, also the typical one: the pairs compared across groups stay far below its square."""
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocab) for _ in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        for _ in range(rnd.choice([2, 3, 4, 6, 8])):
            at = rnd.randrange(150)
            text[at:at + 1] = [] if rnd.random() < 0.5 else [rnd.choice(vocab)]
            text += [""] * (150 - len(text))
        rows.append((i, " ".join(text)))
    seen, across = [], near_dup._across
    monkeypatch.setattr(near_dup, "_across", lambda *args: seen.append(across(*args)) or seen[-1])
    got = near_dup.classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert len(set(want.values())) > 20
    assert seen[0].count() < 4000


def test_shared_ids_null_ids_and_empty(spark, empty):
    a, b = "a b c d e f g h", "p q r s t u v w"
    df = spark.createDataFrame([(1, a), (2, b), (3, a), (3, b), (None, a), (4, None)], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id) for r in near_dup.classes(df).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (3, 1), (None, None), (4, 4)], key=str)
    assert near_dup.classes(empty).count() == 0


def test_keep_one(docs, rows):
    kept = [r.doc_id for r in near_dup.keep_one(docs).collect()]
    want = brute(rows)
    assert sorted(kept) == sorted({d for d in want if want[d] == d})


def test_signature_definition():
    """Slots hold the least rank that any element offers, as if no round had been skipped."""
    rnd = np.random.default_rng(1)
    for n in (1, 3, 40, 900):
        s = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        want = np.full(near_dup.SLOTS, near_dup._FREE, np.uint64)
        for j in range(near_dup.SLOTS):
            rank = (near_dup.mix(s + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(32)) | np.uint64(j << 32)
            np.minimum.at(want, near_dup._slot(s, j), rank)
        assert (near_dup.signatures([s])[0] == want).all()
    slots = np.stack([near_dup._slot(s[:50], j) for j in range(near_dup.SLOTS)])
    assert all(len(set(col)) == near_dup.SLOTS for col in slots.T.tolist())


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(3)
    pool = rnd.integers(0, 1 << 63, 1400, dtype=np.uint64)
    a, b = np.sort(pool[:1200]), np.sort(pool[200:])
    same = [(lambda s: (s[0] == s[1]).mean())(near_dup.signatures([np.sort(a ^ np.uint64(k)), np.sort(b ^ np.uint64(k))])) for k in range(0, 4000, 100)]
    assert np.mean(same) == pytest.approx(1000 / 1400, abs=0.02)


def test_shingle_sets_keep_texts_apart():
    sets = near_dup.shingle_sets(pa.array(["a b c d e", None, "", "A b C d e f", "a b", "b a"]))
    assert [len(s) for s in sets] == [1, 0, 0, 2, 1, 1]
    assert sets[0][0] in sets[3] and sets[4][0] != sets[5][0]


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(80)] + [(5000, 5001 + i) for i in range(300)]
    got = {r.u: r.v for r in groups.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5)).collect()}
    top = {}

    def root(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        if ra != rb:
            top[max(ra, rb)] = min(ra, rb)
    nodes = {x for link in links for x in link}
    assert got == {x: root(x) for x in nodes if root(x) != x}
