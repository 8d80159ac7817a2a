"""Shared helpers: bounded text batches, words as arrays, hashes, table reading.

Everything here is vectorised over Arrow buffers, so a task touches Python
objects per batch or per distinct word, never per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

# Bytes of text a task handles at a time; a single longer text is one piece.
PIECE_BYTES = 2 << 20

# ASCII white space as the word rule `[^\x20\x09-\x0D]+` has it.
_SPACES = np.arange(256, dtype=np.uint8)
_SPACES[9:14] = 32
_LOWER = _SPACES.copy()
_LOWER[65:91] += 32
# The word rule `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: letters, digits, all beyond ASCII.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[48:58] = np.arange(48, 58)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text each (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at, n = 0, len(sizes)
    while at < n:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def plain(text: pa.Array) -> pa.Array:
    """A string array without offset and without NULL (NULL: empty text)."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    return pa.concat_arrays([text, pa.array([], pa.large_string())]) if text.offset else text


def mapped(text: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``plain`` text with each byte put through a table; also its bytes and offsets.

    The table must map ASCII to ASCII and leave other bytes alone, so the
    result is valid UTF-8 with the same offsets.
    """
    text = plain(text)
    offsets = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1]
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = table[raw[offsets[0]: offsets[-1]]]
    offsets = offsets - offsets[0]
    out = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes()))
    return out, raw, offsets


def words_of(text: pa.Array, lower: bool = False, table: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and for each text the index of its first word (one more at the end).

    ``table`` maps bytes to those of words, others to blanks; by default only white space parts words.
    """
    spaced, _, _ = mapped(text, table if table is not None else _LOWER if lower else _SPACES)
    parts = pc.split_pattern(spaced, " ")
    flat = parts.flatten()
    bounds = np.asarray(parts.offsets, dtype=np.int64)
    keep = pc.not_equal(flat, "")
    seen = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return flat.filter(keep), seen[bounds - bounds[0]]


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Word numbers and the distinct words they stand for."""
    enc = words.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary


def hash_words(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of distinct words."""
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct.cast(pa.large_binary()).to_pylist()),
                       np.uint64, len(distinct))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing, so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
