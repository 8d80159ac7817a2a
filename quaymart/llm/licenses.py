"""Licence scan: notice phrases and identifier tags by Aho-Corasick, licence expressions by a shunting-yard parser.

Texts of a batch are put into one buffer: A-Z lower-cased, every run of other
characters than words as one blank, a line feed between texts. One automaton
holds all phrases; it reads the buffer once, whatever the number of phrases.
Matches are then cut to whole words and counted in numpy; Python objects are
made only for texts in which something was found.

A tag (``SPDX-License-Identifier:``, ``License-Expression:``) is followed by an
expression in the text as it stands: identifiers, ``AND``, ``OR``, ``WITH``
and parentheses, up to the first token that cannot continue it. Precedence is
WITH, then AND, then OR; the operator stack and the value stack hold whatever
depth the text has, so no nesting is too deep. Unbalanced parentheses end
where they no longer fit; operators without an operand are left out.

An expression has the labels of all its identifiers and a freedom from 0 to 1:
that of an identifier is stated below, AND takes the smaller (both bind), OR
the larger (the reader may choose), WITH moves halfway to 1 (an exception
gives leave). The ``score`` of a text is the least freedom of its expressions
and of the phrases it holds, 0 if it holds none: how freely the text may be
used by what it says itself.

Cases: NULL text is empty; a text without any sign has empty labels and NULL
places. Overlapping base phrases all count; of other notices that begin at one
word the longest. NULL ids and repeated rows are rows
like any other. Other columns are ignored. Texts are read whole, one piece
holds at most ``PIECE_BYTES`` of them or one text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quaymart.llm.common import LETTERS, mapped, pieces

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notice phrases beyond the base, and their labels.
NOTICES = {
    "mit licence": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache licence": "apache",
    "gnu gpl": "gpl",
    "general public licence": "gpl",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "gnu lgpl": "lgpl",
    "affero general public license": "agpl",
    "gnu agpl": "agpl",
    "gnu free documentation license": "gfdl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "zlib license": "zlib",
    "artistic license": "artistic",
    "the unlicense": "unlicense",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "public domain dedication": "cc0",
    "cc0": "cc0",
    "cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc nd": "cc-by-nd",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noderivs": "cc-by-nd",
    "all rights reserved": "proprietary",
}

# Identifier families (the longest beginning of an identifier counts) and their labels.
IDENTIFIERS = {
    "mit": "mit", "x11": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "gfdl": "gfdl",
    "bsd": "bsd", "0bsd": "bsd", "isc": "isc", "mpl": "mpl", "epl": "epl", "bsl": "boost", "zlib": "zlib",
    "artistic": "artistic", "unlicense": "unlicense", "cc0": "cc0", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa",
    "cc-by-nc": "cc-by-nc", "cc-by-nc-sa": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-nc-nd": "cc-by-nd",
}
OTHER = "other"

# How freely text under a label may be used.
FREEDOM = {
    "cc0": 1.0, "unlicense": 1.0, "mit": 0.9, "isc": 0.9, "bsd": 0.9, "zlib": 0.9, "boost": 0.9, "apache": 0.9,
    "cc-by": 0.8, "artistic": 0.7, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gfdl": 0.4, "gpl": 0.4,
    "agpl": 0.3, "other": 0.2, "cc-by-nc": 0.1, "cc-by-nd": 0.1, "proprietary": 0.0,
}

TAGS = ("spdx license identifier", "license expression", "licence expression")
_TOKEN = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.:+-]*))")
_TOKEN_INSIDE = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.:+-]*))")
_AFTER_TAG = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?")
_BINDS = {"or": 1, "and": 2, "with": 3}
_MARK = re.compile(r"[0-9-]")

RESULT = ("doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
          "score double, expressions string")


def label_of(identifier: str) -> str | None:
    """The label of an identifier; ``other`` for what only looks like one, None for a plain word."""
    low = identifier.lower().rstrip("+")
    known = [f for f in IDENTIFIERS if low == f or low.startswith((f + "-", f + "+"))]
    if known:
        return IDENTIFIERS[max(known, key=len)]
    return OTHER if _MARK.search(low) else None


def tokens(text: str, at: int) -> Iterator[str]:
    """Parentheses, operators and identifiers from a place on; lines may end only inside parentheses."""
    depth = 0
    while m := (_TOKEN_INSIDE if depth else _TOKEN).match(text, at):
        depth += (m[1] == "(") - (m[1] == ")")
        if depth < 0:
            return
        # A full stop or colon ends the sentence around the expression, not the identifier.
        yield m[1] or m[2].rstrip(".:")
        at = m.end()


def postfix(found: Iterator[str]) -> list[str]:
    """Shunting-yard: identifiers and operators in the order of evaluation, up to the first token that does not fit."""
    out: list[str] = []
    held: list[str] = []
    operand = True       # whether an operand comes next
    excepts = False      # whether it is the exception after WITH

    for token in found:
        low = token.lower()
        if token == "(":
            if not operand or excepts:
                break
            held.append(token)
        elif token == ")":
            if operand or "(" not in held:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif low in _BINDS and not operand:
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[low]:
                out.append(held.pop())
            held.append(low)
            operand, excepts = True, low == "with"
        elif operand and low not in _BINDS and (excepts or label_of(token)):
            out.append(token)
            operand = excepts = False
        else:
            break
    if operand:          # an operator without its operand, or nothing but opening parentheses
        while held and held[-1] == "(":
            held.pop()
        if held:
            held.pop()
    return out + [h for h in reversed(held) if h != "("]


def evaluate(order: list[str]) -> tuple[set[str], float, str] | None:
    """Labels, freedom and plain form of an expression in postfix order."""
    stack: list[tuple[set[str], float, str, int]] = []
    for token in order:
        if token not in _BINDS:
            label = label_of(token)
            stack.append(({label} if label else set(), FREEDOM.get(label, 0.0), token, 4))
            continue
        right, left = stack.pop(), stack.pop()
        bind = _BINDS[token]
        if token == "with":
            labels, freedom = left[0], (1 + left[1]) / 2
        else:
            labels, freedom = left[0] | right[0], (min if token == "and" else max)(left[1], right[1])
        a, b = (f"({x[2]})" if x[3] < bind else x[2] for x in (left, right))
        stack.append((labels, freedom, f"{a} {token.upper()} {b}", bind))
    return stack[0][:3] if stack else None


def expression_at(text: str, at: int) -> tuple[set[str], float, str] | None:
    """The expression after a tag that ends at ``at``."""
    m = _AFTER_TAG.match(text, at)
    return evaluate(postfix(tokens(text, m.end()))) if m else None


def _phrases() -> tuple[list[str], ahocorasick.Automaton]:
    phrases = [*BASE, *NOTICES, *TAGS]
    automaton = ahocorasick.Automaton()
    for i, phrase in enumerate(phrases):
        automaton.add_word(phrase, i)
    automaton.make_automaton()
    return phrases, automaton


def squeeze(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of all texts, each byte's place in its text, and where in the buffer each text begins (one more at the end).

    A text begins with a line feed; inside it a blank follows a word only.
    """
    _, raw, offsets = mapped(text, LETTERS)
    word = raw != 32
    keep = word.copy()
    keep[1:] |= word[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[firsts] = word[firsts]              # no blank in front of a text
    place = np.flatnonzero(keep)
    kept_before = np.searchsorted(place, offsets)
    n = len(offsets) - 1
    starts = kept_before + np.arange(n + 1)
    buffer = np.full(len(place) + n, 10, np.uint8)
    at = np.arange(len(place)) + np.repeat(np.arange(1, n + 1), np.diff(kept_before))
    buffer[at] = raw[place]
    origin = np.zeros(len(buffer), np.int64)
    origin[at] = place - np.repeat(offsets[:-1], np.diff(kept_before))
    return buffer, origin, starts


def scan_texts(text: pa.Array, phrases: list[str], automaton: ahocorasick.Automaton) -> list[pa.Array]:
    """The columns of the result after the id, for some texts."""
    buffer, origin, starts = squeeze(text)
    n = len(text)
    word = buffer > 32
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    before = np.concatenate([[0], np.cumsum(begins)])
    n_words = before[starts[1:]] - before[starts[:-1]]
    hits = [(end + 1, i) for end, i in automaton.iter(buffer.tobytes().decode("latin-1"))]
    ends, which = np.array(hits, np.int64).reshape(-1, 2).T
    at = ends - np.array([len(p) for p in phrases])[which]
    open_end = np.append(word, False)
    whole = begins[at] & ~open_end[ends] if len(at) else np.zeros(0, bool)
    # Of notices that begin at one place the longest counts: "cc by nc" is not also "cc by".
    own = whole & (which >= len(BASE)) & (which < len(BASE) + len(NOTICES))
    places, of = np.unique(at[own], return_inverse=True)
    longest = np.zeros(len(places), np.int64)
    np.maximum.at(longest, of, ends[own])
    whole[np.flatnonzero(own)[ends[own] < longest[of]]] = False
    at, ends, which = at[whole], ends[whole], which[whole]
    doc = np.searchsorted(starts, at, side="right") - 1
    nth = before[at] - before[starts[doc]]

    base = which < len(BASE)
    n_base = np.bincount(doc[base], minlength=n)
    first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    np.minimum.at(first, doc[base], nth[base])
    np.maximum.at(last, doc[base], nth[base])
    base_labels, labels, score, said = [""] * n, [""] * n, [0.0] * n, [""] * n
    label_at = [BASE.get(p) or NOTICES.get(p) for p in phrases]
    for d in np.unique(doc):
        mine = range(*np.searchsorted(doc, [d, d + 1]))      # matches come by their ends, so by text
        kinds = set(which[mine.start:mine.stop].tolist())
        base_labels[d] = ",".join(sorted({label_at[i] for i in kinds if i < len(BASE)}))
        all_labels = {label_at[i] for i in kinds} - {None}
        free, plain = [FREEDOM[x] for x in all_labels], []
        tags = sorted(ends[j] for j in mine if label_at[which[j]] is None)
        if tags:
            # Places in bytes: the text as Latin-1 characters, in which ASCII is ASCII.
            whole_text = text[int(d)].as_py().encode().decode("latin-1")
            for end in tags:
                got = expression_at(whole_text, int(origin[end - 1]) + 1)
                if got is not None:
                    all_labels |= got[0]
                    free.append(got[1])
                    plain.append(got[2])
        labels[d], score[d], said[d] = ",".join(sorted(all_labels)), min(free, default=0.0), "; ".join(plain)
    none = n_base == 0
    return [pa.array(n_words), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
            pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score), pa.array(said, pa.string())]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases, automaton = _phrases()
    names = [c.split()[0] for c in RESULT.split(", ")]
    for batch in batches:
        for part in pieces(batch):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *scan_texts(part.column("text"), phrases, automaton)], names)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``; see ``RESULT``. No row meets another, so nothing is shuffled."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan, RESULT.format(kind=kind))
