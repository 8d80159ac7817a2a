"""Drawing documents that look like a target set: importance resampling on hashed word runs.

Features of a text are its runs of 1 to ``LONGEST`` words, each hashed to one
of ``BUCKETS`` by the crc32 of its bytes. A bucket's gain is the logarithm of
how much more often it is met in the target than in all documents; the gains
are one array of fixed size, and a document's weight is the sum over its
features, looked up in that array. Noise of the Gumbel form, from a hash of
the id, turns "the highest scores" into a draw without replacement with
chances in proportion to the weights.

The draw never sorts all documents. Scores are persisted; then exact count
jobs over them narrow the score at which the draw ends (``PROBES`` thresholds
a job), and the same is done for the id among the rows with just that score.
Only the drawn rows are put in order, over range partitions.

The crc32 of a run follows from those of its words: crc(AB) is crc(A) moved on
by the length of B, which is linear, xor crc(B). So only distinct words of a
batch are hashed byte by byte, everything else is table lookups in numpy.

Cases: NULL and empty texts have no features and weight 0. A row without an id
counts in the statistics, has no score and is never drawn. Repeated rows are
drawn one by one; of rows with the same id and score as many as fit. An empty
target leaves the documents' own statistics; no documents, no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import LETTERS, coded, pieces, words_of
from quaymart.operators.ranking import positions
from quaymart.session import stage

BUCKETS = 10_000
LONGEST = 3
PERCENT = 5
LEAST_WORDS = 20
SEED = 42
PROBES = 15
_POLYNOMIAL = 0xEDB88320
_NEAR = 96        # moves of fewer bytes than this have a table of their own


def crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(_POLYNOMIAL), c >> 1)
    return c


def _move_tables() -> np.ndarray:
    """For n < ``_NEAR``, byte k and its value b: b << 8k moved on by n zero bytes, as one flat array."""
    step = crc_table()
    at = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    out = [at]
    for _ in range(_NEAR - 1):
        at = (at >> 8) ^ step[at & 255]
        out.append(at)
    return np.stack(out).reshape(-1)


def _move(tables: np.ndarray, crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each crc moved on by as many zero bytes."""
    at = np.minimum(by, _NEAR - 1) << 10
    out = tables[at + (crc & 255)] ^ tables[at + 256 + ((crc >> 8) & 255)]
    out ^= tables[at + 512 + ((crc >> 16) & 255)] ^ tables[at + 768 + (crc >> 24)]
    far = np.flatnonzero(by >= _NEAR)
    if len(far):    # very long words: the rest of the way, in steps of _NEAR - 1 at most
        out[far] = _move(tables, out[far], by[far] - (_NEAR - 1))
    return out


def run_hashes(text: pa.Array, tables: np.ndarray, longest: int = LONGEST) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Per run length the crc32 of the run that begins at each word and whether it ends in the same text; word bounds of the texts."""
    words, bounds = words_of(text, table=LETTERS)
    codes, distinct = coded(words)
    raw = distinct.cast(pa.large_binary()).to_pylist()
    own = np.fromiter((zlib.crc32(w) for w in raw), np.uint32, len(raw))[codes]
    led = np.fromiter((zlib.crc32(b" " + w) for w in raw), np.uint32, len(raw))[codes]
    size = np.fromiter(map(len, raw), np.int64, len(raw))[codes]
    ends = np.repeat(bounds[1:], np.diff(bounds))
    place = np.arange(len(codes))
    runs, run = [(own, np.ones(len(codes), bool))], own
    for n in range(2, longest + 1):
        m = max(0, len(codes) - n + 1)
        run = _move(tables, run[:m], size[n - 1:] + 1) ^ led[n - 1:]
        runs.append((run, place[:m] + n <= ends[:m]))
    return runs, bounds


def _counting(buckets: int, longest: int, tables: np.ndarray):
    """Task: texts to one row per bucket met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in pieces(batch):
                for hashes, whole in run_hashes(part.column("text"), tables, longest)[0]:
                    total += np.bincount(hashes[whole] % np.uint32(buckets), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``bucket, n`` of all features of all rows; every task sends at most one row per bucket."""
    counted = texts.select("text").mapInArrow(_counting(buckets, longest, _move_tables()), "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """The array of gains. What reaches the driver is two rows per bucket at most."""
    counts = np.zeros((2, buckets), np.int64)
    for i, texts in enumerate((docs, target)):
        for bucket, n in bucket_counts(texts, buckets, longest).collect():
            counts[i, bucket] = n
    all_s, all_t = (float(n) + buckets for n in counts.sum(axis=1))
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in counts.T.tolist()], np.int64)


def _weighing(gain: np.ndarray, longest: int, tables: np.ndarray):
    """Task: (doc_id, text) to (doc_id, n_words, n_features, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = np.uint32(len(gain))
        for batch in batches:
            for part in pieces(batch):
                runs, bounds = run_hashes(part.column("text"), tables, longest)
                per_word = np.zeros(bounds[-1], np.int64)
                for hashes, whole in runs:
                    per_word[:len(hashes)] += np.where(whole, gain[hashes % buckets], 0)
                weight = np.diff(np.concatenate([[0], np.cumsum(per_word)])[bounds])
                words = np.diff(bounds)
                features = sum(np.maximum(words - n, 0) for n in range(longest))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(key: str, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scores(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", "text").mapInArrow(
        _weighing(gain, longest, _move_tables()), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")
    return weighed.withColumn("score", F.col("weight") + noise("doc_id", seed))


def least_with(rows: DataFrame, value: Column, need: int) -> int:
    """The least whole number that at least ``need`` rows do not exceed, by exact counts of ever narrower thresholds."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        probes = sorted({low + (high - low) * i // (PROBES + 1) for i in range(1, PROBES + 1)})
        counts = rows.agg(*[F.count_if(value <= F.lit(p)) for p in probes]).first()
        enough = [p for p, n in zip(probes, counts) if n >= need]
        short = [p for p, n in zip(probes, counts) if n < need]
        low, high = (short[-1] + 1 if short else low), (enough[0] if enough else high)
    return low


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds ``rank``: 1, 2, 3 ... for the drawn rows, highest score first, NULL for the others. ``scored`` is staged."""
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    pool = scored.filter(able)
    need = percent * pool.count() // 100
    undrawn = F.lit(None).cast("bigint")
    if not need:
        return scored.withColumn("rank", undrawn)
    last = -least_with(pool, -F.col("score"), need)
    tied = pool.filter(F.col("score") == last).select("doc_id")
    last_id = least_with(tied, F.col("doc_id"), need - pool.filter(F.col("score") > last).count())
    taken = able & ((F.col("score") > last) | ((F.col("score") == last) & (F.col("doc_id") <= last_id)))
    ranked = positions(scored.filter(taken), [F.col("score").desc(), F.col("doc_id")], "rank")
    # Rows that repeat the last id and score may be more than are needed.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= need, F.col("rank")))
    return ranked.unionByName(scored.filter(~F.coalesce(taken, F.lit(False))).withColumn("rank", undrawn)).select(*scored.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``."""
    return draw(stage(scores(docs, gains(docs, target), seed=seed)), percent, least_words)
