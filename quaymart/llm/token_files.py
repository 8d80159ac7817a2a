"""Token ids in bit-packed files with random access.

Documents are put in ascending id order over files. A file holds all ids of
its documents, one after the other, in blocks of ``BLOCK`` ids; each id takes
the bits that the vocabulary's largest id needs. Layout, little-endian:

    magic "QBP2", bits u32, ids in all u64, documents u64, blocks u64, documents without an id u64
    block offsets      u64 x (blocks + 1), bytes from the start of the data
    document ids       i64 x documents
    document bounds    u64 x (documents + 1), ids before each document
    data               blocks of packed ids, padded to whole bytes

A block is unpacked by numpy alone, and block offsets and document bounds find
any range of ids without reading what lies before it.

Tasks write one file each under a name of their own and report it; only
reported names are in the manifest table, so what a lost or repeated task left
behind is never read. Files go through ``pyarrow.fs``, to the shared folder.

Encoding: a text is cut before a blank that stands between two other
characters that are no white space; the pre-tokenizer always starts a new unit
there, so ids of the units in order are the ids of the text. Every distinct
unit of a batch goes to the tokenizer once.

Cases: NULL text is empty and has the end id only. Rows that share an id
follow each other, ordered by text. NULL ids come first; the head of a file
counts them, and they are NULL again when read. An empty table writes no file. A text longer than a piece is one piece. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaymart.llm.common import coded, pieces, plain
from quaymart.session import scratch_path, stage

MAGIC = b"QBP2"
HEAD = "<4sIQQQQ"
HEAD_BYTES = struct.calcsize(HEAD)
BLOCK = 4096
FILE_BYTES = 64 << 20
# Bytes of text looked at together: fewer passes over the table of units.
TASK_PIECE = 6 << 20
END_ID = 2
KNOWN_UNITS = 800_000
# Units that the tokenizer gets in one call.
AT_ONCE = 5_000
_CUT = "\0"
_ODD = r"(?:^|\s) | (?:\s|$)"
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids, ``bits`` each, lowest bit first, padded to whole bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1, bitorder="little")[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    out = np.zeros((count, 32), np.uint8)
    out[:, :bits] = flat
    return np.packbits(out.reshape(-1), bitorder="little").view("<u4")


def packed_size(count: int, bits: int) -> int:
    return (count * bits + 7) // 8


class FileWriter:
    """Collects documents in order; ids are packed as soon as a block is full, so memory holds packed bytes only."""

    def __init__(self, bits: int):
        self.bits, self.blocks, self.open, self.docs, self.bounds, self.unnamed = bits, [], np.zeros(0, np.uint32), [], [0], 0

    def add(self, docs: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents in ascending order of their ids, those without one first."""
        self.unnamed += docs.count(None)
        self.docs += [0 if d is None else d for d in docs]
        self.bounds += (self.bounds[-1] + np.cumsum(lengths)).tolist()
        ids = np.concatenate([self.open, ids])
        full = len(ids) // BLOCK * BLOCK
        for a in range(0, full, BLOCK):
            self.blocks.append(pack(ids[a:a + BLOCK], self.bits))
        self.open = ids[full:].copy()

    def write(self, where: fs.FileSystem, path: str) -> int:
        blocks = self.blocks + ([pack(self.open, self.bits)] if len(self.open) else [])
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
        with where.open_output_stream(path) as out:
            out.write(struct.pack(HEAD, MAGIC, self.bits, self.bounds[-1], len(self.docs), len(blocks), self.unnamed))
            out.write(offsets.tobytes())
            out.write(np.array(self.docs, "<i8").tobytes())
            out.write(np.array(self.bounds, "<u8").tobytes())
            for block in blocks:
                out.write(block)
        return self.bounds[-1]


class FileReader:
    """Random access to one file: the index is read at once, blocks on demand."""

    def __init__(self, where: fs.FileSystem, path: str):
        self.file = where.open_input_file(path)
        magic, self.bits, self.count, docs, blocks, self.unnamed = struct.unpack(HEAD, self.file.read(HEAD_BYTES))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.offsets = np.frombuffer(self.file.read(8 * (blocks + 1)), "<u8")
        self.docs = np.frombuffer(self.file.read(8 * docs), "<i8")
        self.bounds = np.frombuffer(self.file.read(8 * (docs + 1)), "<u8").astype(np.int64)
        self.data = HEAD_BYTES + 8 * (blocks + 1) + 8 * docs + 8 * (docs + 1)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids [start, stop) of the file."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        self.file.seek(self.data + int(self.offsets[first]))
        raw = self.file.read(int(self.offsets[last + 1] - self.offsets[first]))
        at, out = 0, []
        for b in range(first, last + 1):
            n = min(BLOCK, self.count - b * BLOCK)
            size = packed_size(n, self.bits)
            out.append(unpack(raw[at:at + size], n, self.bits))
            at += size
        return np.concatenate(out)[start - first * BLOCK: stop - first * BLOCK]

    def documents(self, step: int = 256 * BLOCK) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, ids before it, its ids), reading about ``step`` ids at a time."""
        n, at = len(self.docs), 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(self.bounds, self.bounds[at] + step, side="right")) - 1)
            ids = self.ids(int(self.bounds[at]), int(self.bounds[to]))
            for k in range(at, to):
                a, b = self.bounds[k] - self.bounds[at], self.bounds[k + 1] - self.bounds[at]
                yield int(self.docs[k]) if k >= self.unnamed else None, int(self.bounds[k]), ids[a:b]
            at = to


class UnitEncoder:
    """Texts to ids with the tokenizers library, each distinct unit once."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self._forget()

    def _forget(self) -> None:
        # Row k of the table are the ids of unit k - 1; row 0 is the end of a text.
        self.known = pa.array([], pa.large_string())
        self.flat, self.lengths = [np.zeros(1, np.uint32)], [np.ones(1, np.int32)]

    def close(self) -> None:
        """Give the memory back: a worker process outlives its task, and its executor is charged for what it holds."""
        self._forget()
        self.tokenizer = None
        pa.default_memory_pool().release_unused()

    def _units(self, text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The units of all texts in any order, where each text's begin among them, and how many it has."""
        odd = pc.or_(pc.match_substring_regex(text, _ODD), pc.match_substring(text, _CUT)).to_numpy(zero_copy_only=False)
        # White space beyond ASCII is part of a unit; only odd rows need the rule character by character.
        parts = pc.split_pattern(pc.replace_substring(text.filter(pa.array(~odd)), " ", _CUT + " "), _CUT)
        units, begins, counts = parts.flatten(), np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        offsets = np.asarray(parts.offsets, np.int64)
        begins[~odd], counts[~odd] = offsets[:-1] - offsets[0], np.diff(offsets)
        if odd.any():
            rest, some, at = [units], [], len(units)
            for row in np.flatnonzero(odd).tolist():
                mine = _BETWEEN.split(text[row].as_py())
                begins[row], counts[row] = at, len(mine)
                at += len(mine)
                some += mine
                if len(some) > 100_000:
                    rest.append(pa.array(some, pa.large_string()))
                    some = []
            units = pa.concat_arrays([*rest, pa.array(some, pa.large_string())])
        return units, begins, counts

    def encode(self, text: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin (one more at the end); ``end_id`` closes each text."""
        if len(self.known) > KNOWN_UNITS:
            self._forget()
        units, at, counts = self._units(plain(text))
        numbers, distinct = coded(units)
        del units
        begins = np.concatenate([[0], np.cumsum(counts)])
        numbers = numbers[np.arange(begins[-1]) + np.repeat(at - begins[:-1], counts)]
        distinct = distinct.cast(pa.large_string())
        rows = pc.index_in(distinct, value_set=self.known)
        fresh = distinct.filter(pc.is_null(rows))
        if len(fresh):
            seen = len(self.known)
            self.known = pa.concat_arrays([self.known, fresh])
            rows = rows.to_numpy(zero_copy_only=False)
            rows[np.isnan(rows)] = np.arange(seen, seen + len(fresh))
            for a in range(0, len(fresh), AT_ONCE):
                found = [e.ids for e in self.tokenizer.encode_batch_fast(fresh[a:a + AT_ONCE].to_pylist(), add_special_tokens=False)]
                self.flat.append(np.array(list(chain.from_iterable(found)), np.uint32))
                self.lengths.append(np.array(list(map(len, found)), np.int32))
            self.flat, self.lengths = [np.concatenate(self.flat)], [np.concatenate(self.lengths)]
        starts = np.concatenate([[0], np.cumsum(self.lengths[0])]).astype(np.int32)
        table = pa.ListArray.from_arrays(pa.array(starts), pa.array(self.flat[0]))
        which = (np.asarray(rows).astype(np.int64) + 1)[numbers]
        if end_id is not None:
            self.flat[0][0] = end_id
            which = np.insert(which, begins[1:], 0)
            begins = begins + np.arange(len(begins))
        ids = table.take(pa.array(which))
        return ids.values.to_numpy(), np.asarray(ids.offsets, np.int64)[begins]


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _file_count(docs: DataFrame) -> int:
    """Files of about FILE_BYTES of input each, and at least one per core."""
    size = docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-int(str(size)) // FILE_BYTES))


def write(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID, folder: str | None = None,
          files: int | None = None) -> DataFrame:
    """Encode and write all documents; the manifest: ``file, part, n_tokens, n_docs, before``, one row per file.

    ``before`` is the number of ids in all files that come earlier.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    where, root = _open(folder)
    where.create_dir(root, recursive=True)
    bits = max(Tokenizer.from_str(tokenizer_json).get_vocab_size() - 1, end_id, 1).bit_length()
    shared = spark.sparkContext.broadcast(tokenizer_json)  # the vocabulary: a bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, out = None, FileWriter(bits)
        for batch in batches:
            encoder = encoder or UnitEncoder(shared.value)
            for part in pieces(batch, most=TASK_PIECE):
                ids, begins = encoder.encode(part.column("text"), end_id)
                out.add(part.column("doc_id").to_pylist(), np.diff(begins), ids)
                del ids, begins
        if encoder:
            encoder.close()
        if out.docs:
            name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.qbp"
            fs_, root_ = _open(folder)
            count = out.write(fs_, f"{root_}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "part": [TaskContext.get().partitionId()], "n_tokens": [count], "n_docs": [len(out.docs)]},
                                             schema=pa.schema([("file", pa.string()), ("part", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]))

    # Files of a fair size: a task that sees more text meets more of its words again.
    placed = docs.select("doc_id", "text").repartitionByRange(files or _file_count(docs), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    manifest = stage(placed.mapInArrow(run, "file string, part int, n_tokens bigint, n_docs bigint"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    return stage(manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0))))


def read_back(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files of a manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                where, name = _open(path)
                rows = [(d, before + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, at, ids in FileReader(where, name).documents()]
                for a in range(0, len(rows), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[a:a + 50_000])],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("file", "before").repartition(max(1, spark.sparkContext.defaultParallelism * 2), "file")
    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
