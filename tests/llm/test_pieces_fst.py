"""The transducer gives the library's ids and texts; decoding is the inverse."""

import random

import numpy as np
import pytest
import public_tokenizers
import sentencepiece

from quaymart.llm import pieces_fst

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces_fst.Encoder(pieces_fst.Transducer(MODEL))


def odd_texts(library):
    rnd = random.Random(1)
    out = ["", " ", "x ", " a", "  a\tb\nc", " ﬁ½ Å", "\x00a", "日本語🙂é", "▁a ▁ b", "a   b    c     ", "\n\n  \n x", "🙂" * 50, "a" * 2000, "ab" * 300]
    letters = "abcdeéñü ▁  thinger.,🙂日本\n\t01AZ\x00"
    out += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40))) for _ in range(400)]
    out += ["".join(rnd.choice([library.id_to_piece(rnd.randint(259, 31999)), "a", " ", "é"]) for _ in range(rnd.randint(1, 12))) for _ in range(400)]
    return out


def test_ids_equal_the_library(encoder, library, rows):
    texts = odd_texts(library) + [r[1] or "" for r in rows]
    got = encoder.encode(texts)
    want = library.encode(texts)
    assert [x.tolist() for x in got] == want
    assert [encoder.fst.decode(x) for x in got] == [library.decode(x) for x in want]


def test_plain_and_joint_search_agree(encoder, library):
    words = [w for t in odd_texts(library)[14:200] for w in pieces_fst._WORD.findall(encoder.fst.normalise(t)) if len(w) < 60]
    joint = encoder.fst.encode_many(words)
    assert [x.tolist() for x in joint] == [encoder.fst.encode_word(w) for w in words]


def test_border_rule_is_the_merge_rule(encoder, library):
    rnd = np.random.default_rng(2)
    ids = np.array([i for p, (_, i) in encoder.fst.rank.items() if not p.startswith("▁▁") and p != "▁" and encoder.fst.sound(p)])
    a, b = rnd.choice(ids, 3000), rnd.choice(ids, 3000)
    text = {i: p for p, (_, i) in encoder.fst.rank.items()}
    keep = np.array(["▁" not in text[y] for y in b.tolist()])
    a, b = a[keep], b[keep]
    got = encoder.fst._fit_many(a, b)
    assert got.tolist() == [encoder.fst.merged(text[x] + text[y]) == [text[x], text[y]] for x, y in zip(a.tolist(), b.tolist())]


def test_frames(spark, wide, rows, empty, library):
    encoded = pieces_fst.encode(wide, MODEL)
    assert [c for c in encoded.columns if c != "ids"] == [c for c in wide.columns if c != "ids"]
    back = pieces_fst.decode(encoded, MODEL).select("doc_id", "ids", "decoded").collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(back) == len(rows)
    for r in back:
        assert r.ids == library.encode(texts[r.doc_id]) and r.decoded == texts[r.doc_id]
    digest = pieces_fst.round_trip(wide, MODEL).collect()
    assert len(digest) == len(rows) and all(r.round_trip for r in digest)
    assert pieces_fst.encode(empty, MODEL).count() == 0
