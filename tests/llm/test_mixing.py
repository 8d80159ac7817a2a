"""Mixing: targets against plain resharing, words taken against targets, reruns, odd rows."""

import re
from collections import Counter, defaultdict

import pytest

from quaymart.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """Reshare the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, budget * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        full |= {s: cap * sizes[s] for s in over}


def test_targets_and_taken(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    count = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    sizes, biggest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += count[r[0]]
        biggest[r[3]] = max(biggest[r[3]], count[r[0]])
    want = plain_targets(sizes)
    for r in got:
        assert r.size == count[r.doc_id] and r.source_size == sizes[r.source] and 0 <= r.copies <= 2
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s]
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_many_documents_hit_the_target(spark):
    """Several fold levels; the miss is one document at most, and copies are unbiased over seeds of ids."""
    df = spark.range(20_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'b', 'a') as source", "cast(1 + id % 17 as bigint) as size")
    mixed = mixing.mix_sizes(df)
    per = {r.source: r for r in mixed.selectExpr("source", "target", "copies * size as t").groupBy("source").agg({"t": "sum", "target": "max"}).collect()}
    assert len(per) == 2
    for r in per.values():
        assert abs(r["sum(t)"] - r["max(target)"]) <= 17


def test_repeat_and_empty(spark, docs, wide, empty):
    mixed = mixing.mix(docs)
    copies = defaultdict(list)
    for r in mixed.collect():
        copies[r.doc_id].append(r.copies)
    out = Counter(r.doc_id for r in mixing.repeat(wide, mixing.mix(wide)).collect())
    assert out == Counter({k: sum(v) for k, v in copies.items() if sum(v)})
    assert mixing.mix(empty).count() == 0


def test_native_plan(docs):
    assert "Python" not in mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
