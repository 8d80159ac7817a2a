"""Language identification by hierarchical discrimination.

Texts become relative frequencies of hashed byte n-grams (1 to 3 bytes of the
lower-cased text, all that is no letter being one blank). Languages are put
into families by average-linkage clustering of their mean profiles. A first
set of one-versus-rest linear SVMs names the family, then one-versus-one linear
SVMs vote within it.

Training takes at most ``PER_LANGUAGE`` labelled rows of each language, those
with the least hash of text and label, whatever the size of the table; their
vectors (``DIM`` counts each) go to the driver. Prediction reads whole texts in
Arrow batches and knows nothing of a row but its text.

``recognised`` also drops text that is familiar from no language: other scripts,
noise, and most languages that were not learned (close relatives of a learned
one pass). The odds cannot tell these, since some learned language always wins.
The fewer texts a language has, the less an unseen n-gram counts against it.

Cases: NULL text, or text without a letter: ``und`` with score 0. Ties in votes
go to the larger sum of margins, then to the language that sorts first. One
known language: it is always predicted; none: always ``und``. Repeated rows
count as often as they are there. Other columns are ignored, an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymart.llm.common import mapped, pieces

PER_LANGUAGE = 400
DIM = 1 << 12
UNKNOWN = "und"
FOREIGN = -9.5   # least familiar score of a text in a known language; all texts of sf0.001 to sf0.1 score above -7.5
UNSEEN = 4e-4    # share of an n-gram that no text of a language has, divided by the number of its texts
PASSES = 150
PENALTY = 1e-4

# Every ASCII byte that is no lower-case letter becomes a blank.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[:97] = 32
_LETTERS[123:128] = 32


def _grams(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: hashed n-grams that begin at each byte, and where the rows begin (one more at the end).

    N-grams that run over the end of a row, or are blank, get the extra bucket DIM.
    """
    _, raw, starts = mapped(pc.utf8_lower(text), _LETTERS)
    blank = raw == 32
    # Runs of blanks count once.
    if len(raw):
        extra = np.concatenate([[False], blank[1:] & blank[:-1]])
        first = starts[:-1][starts[:-1] < len(raw)]
        extra[first] = False
        kept = np.concatenate([[0], np.cumsum(~extra)])
        raw, blank, starts = raw[~extra], blank[~extra], kept[starts]
    code = np.zeros(len(raw), np.uint32)
    for n in (1, 2, 3):
        m = len(raw) - n + 1
        if m <= 0:
            yield np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
            continue
        code = code[:m] * np.uint32(256) + raw[n - 1:].astype(np.uint32)
        slot = ((code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(20)).astype(np.int64)
        slot[blank[:m] & blank[n - 1:]] = DIM
        for back in range(1, n):
            over = starts[1:] - back
            slot[over[(over >= 0) & (over < m)]] = DIM
        yield slot, np.minimum(starts, m)


def profiles(text: pa.Array) -> np.ndarray:
    """One row of DIM relative frequencies per text (the mean over n of those of the n-grams)."""
    out = np.zeros((len(text), DIM), np.float32)
    for slot, starts in _grams(text):
        for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            counts = np.bincount(slot[a:b], minlength=DIM + 1)[:DIM]
            if (total := counts.sum()):
                out[i] += counts / (3 * total)
    return out


def margins(text: pa.Array, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Linear scores of whole texts, one column per classifier (``weights`` is DIM x classifiers)."""
    table = np.vstack([weights, np.zeros((1, weights.shape[1]))]).astype(np.float64)
    out = np.zeros((len(text), weights.shape[1]))
    for slot, starts in _grams(text):
        real = np.concatenate([[0], np.cumsum(slot < DIM)])
        n = real[starts[1:]] - real[starts[:-1]]
        for c in range(weights.shape[1]):
            run = np.concatenate([[0.0], np.cumsum(table[:, c][slot])])
            out[:, c] += (run[starts[1:]] - run[starts[:-1]]) / np.maximum(3 * n, 1)
    return out + bias


def _svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge, classes weighted alike) by accelerated gradient descent; y is +1 or -1."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, vb = w.copy(), b
    step = 1.0 / (2 * float((share * ((x * x).sum(axis=1) + 1)).sum()) + PENALTY)
    for t in range(PASSES):
        slack = np.maximum(0, 1 - y * (x @ v + vb)) * share * y
        w2, b2 = v - step * (PENALTY * v - 2 * (x.T @ slack)), vb + step * 2 * float(slack.sum())
        pull = t / (t + 3)
        v, vb = w2 + pull * (w2 - w), b2 + pull * (b2 - b)
        w, b = w2, b2
    return w, b


@dataclass
class Model:
    """Families (lists of languages), and the linear classifiers: (kind, a, b) with one weight column each."""

    families: list[list[str]]
    tasks: list[tuple[str, int | str, str]]
    weights: np.ndarray
    bias: np.ndarray
    likely: np.ndarray | None = None

    def familiar(self, text: pa.Array) -> np.ndarray:
        """Mean log share of a text's n-grams in the language that has most of them (``likely``: DIM x languages)."""
        if self.likely is None:
            return np.full(len(text), -np.inf)
        return margins(text, self.likely, np.zeros(self.likely.shape[1])).max(axis=1)

    def predict(self, text: pa.Array) -> tuple[list[str], list[float]]:
        """Language and score of each text; the score is the family's odds times the mean odds of the winner's duels."""
        named = [any(ch.isalpha() for ch in t) if t else False for t in text.to_pylist()]
        if not self.families:
            return [UNKNOWN] * len(named), [0.0] * len(named)
        odds = 1 / (1 + np.exp(-2 * np.clip(margins(text, self.weights, self.bias), -30, 30)))
        at = {task: k for k, task in enumerate(self.tasks)}
        langs, scores = [], []
        for ok, row in zip(named, odds):
            if not ok:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            of = [row[at["family", f, ""]] if len(self.families) > 1 else 1.0 for f in range(len(self.families))]
            best = int(np.argmax(of))
            members = self.families[best]
            duels = {a: [row[at["pair", a, b]] if ("pair", a, b) in at else 1 - row[at["pair", b, a]] for b in members if b != a] for a in members}
            first = max(members, key=lambda a: (sum(x > 0.5 for x in duels[a]), sum(duels[a])))
            langs.append(first)
            scores.append(float(min(1.0, max(0.0, of[best] * (np.mean(duels[first]) if duels[first] else 1.0)))))
        return langs, scores


def families_of(means: dict[str, np.ndarray]) -> list[list[str]]:
    """About sqrt(n) groups of languages by average linkage of centred mean profiles."""
    names = sorted(means)
    if len(names) < 3:
        return [[n] for n in names]
    x = np.stack([np.sqrt(means[n]) for n in names])
    x = x - x.mean(axis=0)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    far = 1 - x @ x.T
    groups = [[i] for i in range(len(names))]
    while len(groups) > round(len(names) ** 0.5):
        _, a, b = min((far[np.ix_(p, q)].mean(), i, j) for i, p in enumerate(groups) for j, q in enumerate(groups) if i < j)
        groups[a] += groups.pop(b)
    return [sorted(names[i] for i in g) for g in groups]


def fit(x: np.ndarray, langs: list[str]) -> Model:
    """Train all classifiers on profiles and their languages."""
    labels = np.array(langs, dtype=object)
    means = {n: x[labels == n].mean(axis=0) for n in sorted(set(langs))}
    families = families_of(means)
    likely = np.stack([np.log(means[n] + UNSEEN / (labels == n).sum()) for n in means], axis=1)
    scale = np.sqrt(np.float32(DIM))
    x = x * scale * 4
    tasks: list[tuple[str, int | str, str]] = []
    columns, bias = [], []

    def add(task: tuple[str, int | str, str], rows: np.ndarray, y: np.ndarray) -> None:
        w, b = _svm(rows, y.astype(np.float32))
        tasks.append(task)
        columns.append(w * scale * 4)
        bias.append(b)

    if len(families) > 1:
        for f, members in enumerate(families):
            add(("family", f, ""), x, np.where(np.isin(labels, members), 1, -1))
    for members in families:
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                mine = (labels == a) | (labels == b)
                add(("pair", a, b), x[mine], np.where(labels[mine] == a, 1, -1))
    weights = np.stack(columns, axis=1) if columns else np.zeros((DIM, 0))
    return Model(families, tasks, weights, np.array(bias), likely)


def _profile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            rows = [r.tobytes() for r in profiles(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(rows, pa.binary())], ["lang", "profile"])


def train(docs: DataFrame, learn: Column | None = None, per_language: int = PER_LANGUAGE) -> Model:
    """A model from (text, lang) of the rows that ``learn`` allows; the sample is bounded per language."""
    rows = docs if learn is None else docs.filter(learn)
    rows = rows.filter(F.col("lang").isNotNull()).select("lang", "text")
    # Only about twice the sample goes to the window: texts whose hash is below the share that this is of the language.
    # Copies are one text, in the share and in the sample; all copies of a text have one hash and would come together.
    texts = rows.select("lang", F.xxhash64("text", "lang").alias("h")).distinct()
    share = texts.groupBy("lang").agg(F.least(F.lit(1.0), 2.0 * per_language / F.count("*")).alias("share"))
    part = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # One row per language, of which the model itself holds DIM numbers: far smaller than the model that is broadcast below.
    share = F.broadcast(share.withColumnRenamed("lang", "_lang"))
    few = rows.join(share, F.col("lang") == F.col("_lang")).filter(part < F.col("share")).select("lang", "text").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text", "lang"), "text")
    rows = (
        few.filter(F.col("text").rlike(r"\p{L}"))
        .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language).drop("_n")
    )
    found = rows.mapInArrow(_profile_rows, "lang string, profile binary").toArrow()
    langs = found.column("lang").to_pylist()
    if not langs:
        return Model([], [], np.zeros((DIM, 0)), np.zeros(0))
    x = np.stack([np.frombuffer(p.as_buffer(), np.float32) for p in found.column("profile")])
    order_ = sorted(range(len(langs)), key=lambda i: (langs[i], x[i].tobytes()))
    return fit(x[order_], [langs[i] for i in order_])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; a column of one of these names is replaced."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*keep)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # DIM weights per classifier: bounded by the languages

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                text = part.column("text")
                langs, scores = shared.value.predict(pc.fill_null(text, ""))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 [*part.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(label, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` in a language that the model knows, with the verdict as their ``lang``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                text = pc.fill_null(part.column("text"), "")
                langs = shared.value.predict(text)[0]
                known = [lang != UNKNOWN and much >= FOREIGN for lang, much in zip(langs, shared.value.familiar(text).tolist())]
                cols = [pa.array(langs, pa.string()) if n == "lang" else part.column(n) for n in part.schema.names]
                yield pa.RecordBatch.from_arrays(cols, part.schema.names).filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
