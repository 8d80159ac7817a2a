"""Licence scan against a plain version, and expressions against a recursive parser."""

import random
import re

import pytest

from quaymart.llm import licenses as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def places(words, phrase):
    want = phrase.split(" ")
    return [i for i in range(len(words) - len(want) + 1) if words[i:i + len(want)] == want]


def brute(text):
    text = text or ""
    low = lower(text)
    found = [(m.start(), m.end()) for m in WORD.finditer(low)]
    words = [low[a:b] for a, b in found]
    base = {p: places(words, p) for p in L.BASE}
    own = {(i, len(p.split())): label for p, label in L.NOTICES.items() for i in places(words, p)}
    own = {i: label for (i, n), label in own.items() if n == max(m for j, m in own if j == i)}
    starts = sorted(i for at in base.values() for i in at)
    base_labels = {L.BASE[p] for p, at in base.items() if at}
    labels = base_labels | set(own.values())
    free = [L.FREEDOM[x] for x in labels]
    for tag in L.TAGS:
        for i in places(words, tag):
            got = L.expression_at(text, found[i + 2 if tag.startswith("spdx") else i + 1][1])
            if got:
                labels |= got[0]
                free.append(got[1])
    return (len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(base_labels)),
            ",".join(sorted(labels)), pytest.approx(min(free, default=0.0)))


TEXTS = [
    "MIT License", "submit license", "mit licensed", "Apache\n\nLICENSE, mit.license mit license apache license",
    "GNU Lesser General Public License and the General-Public License", "Licensed under CC BY-NC 4.0.", "CC BY 4.0", "cc  by",
    "# SPDX-License-Identifier: (MIT OR GPL-2.0-or-later WITH Classpath-exception-2.0) AND Apache-2.0 */",
    "é日本 SPDX-License-Identifier: Apache-2.0.\nAND MIT", "spdx-license-identifier = 'LicenseRef-own+ and'", "SPDX-License-Identifier: see the file",
    "SPDX-License-Identifier: " + "(" * 5000 + "MIT" + ")" * 5000, "SPDX-License-Identifier: " + " OR ".join(["MIT", "GPL-3.0"] * 3000),
    "mit", "license", "", None, " \x00 ", "the mit", "mit license " * 3000, "All rights reserved. SPDX-License-Identifier: MIT", "licenſe MIT LICENSE",
]


def test_against_brute(spark, docs, wide, rows):
    frame = docs.unionByName(spark.createDataFrame([(1000 + i, t, None, None, None) for i, t in enumerate(TEXTS)] + [(None, "x MIT License", None, None, None)] * 2, docs.schema))
    want = sorted(((r.doc_id, *brute(r.text)) for r in frame.collect()), key=lambda r: (r[0] is None, r[:4]))
    for df in (frame, wide.unionByName(frame, allowMissingColumns=True).filter("rep is null")):
        got = sorted((tuple(r)[:8] for r in L.scan(df).collect()), key=lambda r: (r[0] is None, r[:4]))
        assert got == want


def test_pieces_are_independent(spark):
    """Phrases never reach from one text into the next, and odd alphabets keep their places."""
    rows = [(i, t) for i, t in enumerate(["apache", "license mit", "license", "general public", "license", "日本 general public license 日本"] * 50)]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()}
    assert [got[i].n_base for i in range(6)] == [0, 0, 0, 0, 0, 1] and got[5].first_word == 1


def test_empty(empty):
    assert L.scan(empty).collect() == []


def plain(tree):
    """Labels and freedom of a nested tuple, straight from the definition."""
    if isinstance(tree, str):
        label = L.label_of(tree)
        return {label}, L.FREEDOM[label]
    op, a, b = tree
    if op == "WITH":
        labels, free = plain(a)
        return labels, (1 + free) / 2
    (x, f), (y, g) = plain(a), plain(b)
    return x | y, (min if op == "AND" else max)(f, g)


def written(tree, rnd):
    if isinstance(tree, str):
        return tree, 4
    op, a, b = tree
    bind = {"OR": 1, "AND": 2, "WITH": 3}[op]
    (x, m), (y, n) = written(a, rnd), written(b, rnd)
    x = f"({x})" if m < bind or rnd.random() < 0.2 and op != "WITH" else x
    y = f"( {y} )" if n <= bind and op != "WITH" or rnd.random() < 0.2 and op != "WITH" else y
    return f"{x} {rnd.choice([op, op.lower(), op.title()])} {y}", bind


def grown(rnd, depth):
    if depth == 0 or rnd.random() < 0.3:
        leaf = rnd.choice(["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0+", "CC-BY-NC-4.0", "LicenseRef-1", "0BSD"])
        return ("WITH", leaf, "LLVM-exception") if rnd.random() < 0.2 else leaf
    return (rnd.choice(["AND", "OR"]), grown(rnd, depth - 1), grown(rnd, depth - 1))


def test_expressions():
    rnd = random.Random(8)
    for _ in range(500):
        tree = grown(rnd, 5)
        text, _ = written(tree, rnd)
        got = L.expression_at(f"x SPDX-License-Identifier: {text} ) or", 25)
        assert got[:2] == plain(tree)
        assert L.expression_at(f": {got[2]}", 0) == got      # the plain form says the same


@pytest.mark.parametrize("text, want", [
    (": MIT AND", {"mit"}), (": MIT AND the rest", {"mit"}), (": AND MIT", None), (": )", None), (": (MIT", {"mit"}), (": MIT (x)", {"mit"}),
    (": MIT AND (\n GPL-2.0\n OR ISC )\nAND Zlib", {"mit", "gpl", "isc"}), ("MIT", None), (": GPL-2.0 WITH", {"gpl"}), (": ((", None), ("", None),
])
def test_odd_expressions(text, want):
    got = L.expression_at(text, 0)
    assert (got and got[0]) == want
