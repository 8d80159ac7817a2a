"""Quality rules: fixed counts, and logistic regression on hashed word and character n-grams.

Features are relative frequencies of hashed words and word pairs (``WORD_DIM``)
and of hashed 1- to 3-byte grams of the text (``CHAR_DIM``), case kept. The
regression is fitted on at most ``PER_CLASS`` labelled rows of each class, those
with the least hash of their id; a fifth of them is kept out and calibrates the
odds (Platt scaling, weighted to the class shares over all labels). Whole texts
are scored in Arrow batches; a text is kept if its probability of good quality
is at least ``THRESHOLD`` and no fixed rule rejects it.

Fixed rules: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT`` percent
of the words in three-word windows that occur twice.

Cases: NULL, empty or blank text has no words and fails the rules. Rows that
share an id, and repeated rows, are judged one by one. An id with several
labels is used once per label. Labels that are NULL or neither 0 nor 1 are left
out; without both classes the model keeps every text that passes the rules. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaymart.llm.common import coded, hash_words, mapped, mix, pieces, words_of, _SPACES

PER_CLASS = 1000
WORD_DIM, CHAR_DIM = 1 << 11, 1 << 11
DIM = WORD_DIM + CHAR_DIM
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT = 50, 50
PASSES, PENALTY = 300, 1e-3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SAME = np.arange(256, dtype=np.uint8)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of values from each start to the next."""
    run = np.concatenate([[0], np.cumsum(values)])
    return run[starts[1:]] - run[starts[:-1]]


def _owner(starts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def _repeated_words(ids: np.ndarray, starts: np.ndarray, kinds: int) -> np.ndarray:
    """Words in three-word windows that occur twice or more in their text."""
    covered = np.zeros(len(ids), bool)
    if len(ids) >= 3:
        doc = _owner(starts)
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        if kinds < 1 << 21:
            key = ((ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]).astype(np.uint64)
        else:
            key = mix(mix(ids[:-2].astype(np.uint64) * _A + ids[1:-1].astype(np.uint64)) * _B + ids[2:].astype(np.uint64))
        # Window and text in one 64-bit number.
        key = mix(mix(key[inside]) + doc[inside].astype(np.uint64) * _A)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        at = inside[order[again]]
        for k in range(3):
            covered[at + k] = True
    return _sums(covered, starts)


def _repeated_lines(text: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    parts = pc.split_pattern(text, "\n")
    starts = np.asarray(parts.offsets, np.int64) - parts.offsets[0].as_py()
    ids, distinct = coded(parts.flatten())
    worded = pc.match_substring_regex(distinct, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False).astype(bool)
    line = worded[ids] if len(ids) else np.zeros(0, bool)
    doc = _owner(starts)
    distinct_lines = np.unique(doc[line] * max(len(distinct), 1) + ids[line])
    return _sums(line, starts) - np.bincount(distinct_lines // max(len(distinct), 1), minlength=len(text))[: len(text)]


def measures(text: pa.Array) -> dict[str, np.ndarray]:
    """The fixed counts of each text."""
    _, raw, offsets = mapped(text, _SAME)
    words, starts = words_of(text)
    ids, distinct = coded(words)
    chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    return {
        "n_words": np.diff(starts),
        "word_chars": _sums(chars[ids] if len(ids) else np.zeros(0, np.int64), starts),
        "n_symbols": _sums(_SYMBOL[raw], offsets),
        "n_dup_lines": _repeated_lines(pc.fill_null(text.cast(pa.large_string()), "")),
        "n_repeat_words": _repeated_words(ids, starts, len(distinct)),
    }


def _grams(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Slots of all n-grams of one kind, where each text's n-grams begin, and the weight of the kind.

    The last slot, DIM, takes n-grams that run over the end of a text.
    """
    words, starts = words_of(text)
    ids, distinct = coded(words)
    h = hash_words(distinct)[ids] if len(ids) else np.zeros(0, np.uint64)
    yield (mix(h) % np.uint64(WORD_DIM)).astype(np.int64), starts, 0.5
    if len(h) > 1:
        two = (mix(h[:-1] * _A + h[1:]) % np.uint64(WORD_DIM)).astype(np.int64)
        ends = starts[1:] - 1
        two[ends[(ends >= 0) & (ends < len(two))]] = DIM
        yield two, np.minimum(starts, len(two)), 0.5
    _, raw, offsets = mapped(text, _SPACES)
    code = np.zeros(len(raw), np.uint32)
    for n in (1, 2, 3):
        m = len(raw) - n + 1
        if m <= 0:
            return
        code = code[:m] * np.uint32(256) + raw[n - 1:].astype(np.uint32)
        slot = WORD_DIM + ((code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(21)).astype(np.int64)
        for back in range(1, n):
            over = offsets[1:] - back
            slot[over[(over >= 0) & (over < m)]] = DIM
        yield slot, np.minimum(offsets, m), 1 / 3


def features(text: pa.Array) -> np.ndarray:
    out = np.zeros((len(text), DIM), np.float32)
    for slot, starts, share in _grams(text):
        for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            counts = np.bincount(slot[a:b], minlength=DIM + 1)[:DIM]
            if (total := counts.sum()):
                out[i] += counts * (share / total)
    return out


@dataclass
class Model:
    weights: np.ndarray      # DIM
    bias: float
    slope: float             # calibration: odds = slope * margin + shift
    shift: float
    trained: bool = True

    def probabilities(self, text: pa.Array) -> np.ndarray:
        if not self.trained:
            return np.ones(len(text))
        table = np.concatenate([self.weights.astype(np.float64), [0.0]])
        margin = np.full(len(text), self.bias)
        for slot, starts, share in _grams(text):
            real = np.maximum(_sums(slot < DIM, starts), 1)
            margin += _sums(table[slot], starts) * (share / real)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, w8: np.ndarray, penalty: float, passes: int) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by accelerated gradient descent (y: 0 or 1)."""
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, vb = w.copy(), b
    step = 1.0 / (0.25 * float((w8 * ((x * x).sum(axis=1) + 1)).sum()) + penalty)
    for t in range(passes):
        err = (w8 * (1 / (1 + np.exp(-np.clip(x @ v + vb, -50, 50))) - y)).astype(np.float32)
        w2, b2 = v - step * (x.T @ err + penalty * v), vb - step * float(err.sum())
        pull = t / (t + 3)
        v, vb = w2 + pull * (w2 - w), b2 + pull * (b2 - b)
        w, b = w2, b2
    return w, b


def fit(x: np.ndarray, y: np.ndarray, share: float) -> Model:
    """``share``: part of good rows among all labels. Every fifth row calibrates."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(DIM), 0.0, 1.0, 0.0, trained=False)
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held].tolist())) < 2:
        held[:] = True
    learn = ~held if (~held).any() and len(set(y[~held].tolist())) == 2 else np.ones(len(y), bool)

    def even(labels: np.ndarray, good: float) -> np.ndarray:
        return np.where(labels == 1, good / (labels == 1).sum(), (1 - good) / (labels == 0).sum())

    scale = 1 / (x[learn].std(axis=0) + 1e-4) / np.sqrt(DIM).astype(np.float32) * 8
    w, b = _logistic((x[learn] * scale).astype(np.float32), y[learn], even(y[learn], 0.5), PENALTY, PASSES)
    weights = w * scale
    margin = x[held] @ weights + b
    middle, spread = float(margin.mean()), float(margin.std()) + 1e-9
    slope, shift = _logistic(((margin - middle) / spread)[:, None].astype(np.float32), y[held], even(y[held], share), 1e-3, 500)
    slope = max(float(slope[0]), 1e-6) / spread
    return Model(weights, float(b), slope, float(shift) - slope * middle)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            rows = [r.tobytes() for r in features(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(rows, pa.binary())], ["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from (doc_id, text) and (doc_id, quality)."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_class).select("doc_id", "y")
    # At most per_class rows of two classes: a bounded broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(_feature_rows, "doc_id bigint, y int, x binary")
    sample = rows.toArrow() if counts else None  # once: another run may bring the rows in another order
    found = sorted(zip(*[sample.column(c).to_pylist() for c in ("doc_id", "y", "x")])) if sample else []
    if not found:
        return Model(np.zeros(DIM), 0.0, 1.0, 0.0, trained=False)
    x = np.stack([np.frombuffer(r[2], np.float32) for r in found])
    return fit(x, np.array([r[1] for r in found]), counts.get(1, 0) / max(sum(counts.values()), 1))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the fixed counts, ``base_failed``, ``probability`` and ``kept`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                text = pc.fill_null(part.column("text"), "")
                m = measures(text)
                failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT * m["n_words"])
                p = shared.value.probabilities(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(m[c].astype(np.int64)) for c in COLUMNS], pa.array(failed), pa.array(p),
                     pa.array(~failed & (p >= threshold))], ["doc_id", *COLUMNS, "base_failed", "probability", "kept"])

    kinds = ", ".join(f"{c} bigint" for c in COLUMNS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, {kinds}, base_failed boolean, probability double, kept boolean")
