"""anchors are found in chunks whose hashes fit the cache of a core; rounds pick out only the ranks they extend."""

import tracemalloc

import numpy as np

from quaymart.llm import suffix_dedup as S


def _texts(sizes, letters=20, seed=1):
    raw = np.random.default_rng(seed).integers(97, 97 + letters, sum(sizes)).astype(np.uint8)
    return raw, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def test_chunks_hold_little_memory():
    raw, offsets = _texts([1500] * 2000)
    tracemalloc.start()
    for _ in S.anchors(raw, offsets, wide=True):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20


def test_every_window_has_one_anchor_for_any_chunk(monkeypatch):
    raw, offsets = _texts([0, 99, 100, 101, 0, 700, 3000, 100, 0], 3)
    for chunk in (64, 700, 1 << 16):
        monkeypatch.setattr(S, "CHUNK", chunk)
        met = []
        for owner, first, count, gram, name, place in S.anchors(raw, offsets, wide=True):
            assert (first <= place).all() and (place + S.GRAM <= first + S.SPAN).all()
            met += [(int(o), f + i) for o, f, c in zip(owner, first.tolist(), count.tolist()) for i in range(c)]
        sizes = np.diff(offsets)
        assert sorted(met) == [(o, i) for o, n in enumerate(sizes.tolist()) for i in range(n - S.SPAN + 1)]


def test_equal_bytes_have_equal_names_in_different_chunks(monkeypatch):
    raw, _ = _texts([400])
    three = np.concatenate([raw, raw, raw])
    offsets = np.array([0, 400, 800, 1200])
    names = []
    for chunk in (1 << 16, 400):
        monkeypatch.setattr(S, "CHUNK", chunk)
        found = [np.concatenate(x) for x in zip(*S.anchors(three, offsets, wide=True))]
        by_text = [set(zip(found[1][found[0] == o].tolist(), found[3][found[0] == o].tolist(), found[4][found[0] == o].tolist())) for o in range(3)]
        assert by_text[0] == by_text[1] == by_text[2]
        names.append(by_text[0])
    assert names[0] == names[1]


def test_windows_of_a_span_of_rounds_are_found_whatever_their_step(monkeypatch):
    rng = np.random.default_rng(4)
    core = rng.integers(97, 105, S.CORE).astype(np.uint8)
    ends = [rng.integers(97, 99, (2, S.SPAN - S.CORE)).astype(np.uint8) for _ in range(60)]
    cells = [np.concatenate([a, core, b]) for a, b in ends]
    doc, first = np.arange(len(cells)), np.zeros(len(cells), np.int64)
    seen, want = set(), set()
    for d, cell in enumerate(cells):
        for i in range(len(cell) - S.SPAN + 1):
            text = cell[i:i + S.SPAN].tobytes()
            want |= {(d, i)} if text in seen else set()
            seen.add(text)
    for near in (1, 7, 8, 100):
        monkeypatch.setattr(S, "NEAR", near)
        assert set(zip(*(x.tolist() for x in S.repeats(cells, doc, first)))) == want
