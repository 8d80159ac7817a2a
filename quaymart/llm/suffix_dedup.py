"""Removing repeated byte strings: shard Burrows-Wheeler transforms merged by interleave refinement.

Every byte that a ``SPAN``-byte string covers which also starts earlier in the
corpus (smaller id, or earlier in the same text) is removed. Strings never
cross texts and are judged on the input.

The transforms hold only text in which a repeat is possible. Each window of
SPAN bytes is owned by one anchor, its ``GRAM``-byte string of least hash (the
leftmost such), so two equal windows have equal anchors at equal distance:

1. anchors that occur once in the corpus are dropped, and with them all windows
   they own; nothing else is ever left out;
2. occurrences of an anchor whose owned windows are the same bytes are a class.
   The windows of all but its earliest occurrence are repeats. An anchor with
   one class is done;
3. the earliest occurrences of the other anchors' classes are cut into cells of
   up to ``CELL`` windows at fixed distances from the anchor. All windows of a
   cell share a core of bytes, so equal windows are in cells of equal core. Cells
   of equal bytes are classes again, and cores with one class are done;
4. the cells of the other cores are dealt to tasks by core. A task gets them as
   shards, builds the transform of each, and merges these: the interleave of
   all shards is refined one symbol per round, each round a stable sort of the
   merged transforms by symbol, and the rank blocks which it splits give the
   common prefixes. After SPAN rounds a block is a set of equal windows (a
   repeated interval); all but the earliest are repeats. No suffix of one shard
   is ever compared or sorted against another's.

A string that very many texts share folds to its classes before it meets
others, so no task gets all its occurrences; a core's cells differ in at most
CELL - 1 bytes on either side.

Cases: NULL text is empty, nothing is removed. Texts shorter than SPAN stay
whole. Rows with the same id and the same text are one document, and all of
them get its result; rows with the same id and other texts are ordered by a
hash of the text; NULL ids come first. An empty table gives an empty result;
other columns are ignored. Classes are told apart by 128 bits of hash, blocks by the bytes.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.llm.common import mapped, mix, pieces
from quaymart.operators.ranking import positions
from quaymart.session import stage

SPAN = 100
GRAM = 28
CELL = 32
CORE = SPAN - CELL + 1
CHUNK = 1 << 16            # window starts looked at together; their hashes stay in the cache of a core
SHARD = 1 << 18            # bytes of one shard
TASK = 1 << 20             # bytes of cells a merge task is to get
NEAR = 8                   # rounds whose ranks are picked out together
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SAME = np.arange(256, dtype=np.uint8)
_LOW = np.uint64((1 << 22) - 1)
_MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)      # the factors of ``mix``
_EACH = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))


def _powers(raw: np.ndarray, held: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Hashes of the 1, 2, 4, 8 and 16 bytes from each place on, in the arrays ``held``: new ones for every chunk would
    cost more than the hashes. The array 0 is for steps in between."""
    h = {1: np.take(_EACH, raw, out=held[1][:len(raw)], mode="clip")}
    size = 1
    while size < 16:
        n = max(len(raw) - 2 * size + 1, 0)
        x, step = held[2 * size][:n], held[0][:n]
        np.multiply(h[size][:n], _A, out=x)
        x += h[size][size:size + n]
        for factor in _MIX:
            np.bitwise_xor(x, np.right_shift(x, np.uint64(33), out=step), out=x)
            x *= factor
        np.bitwise_xor(x, np.right_shift(x, np.uint64(33), out=step), out=x)
        h[2 * size] = x
        size *= 2
    return h


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _at(h16: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """Hashes of size (16, 32 or 64) bytes from the places."""
    if size == 16:
        return h16[place]
    half = size // 2
    return mix(_at(h16, place, half) * _A + _at(h16, place + half, half))


def _long_hash(h16: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of size (64 to 192) bytes from each start."""
    end = start + size - 64
    return mix(mix(_at(h16, start, 64) * _A + _at(h16, (start + end) // 2, 64)) * _B + _at(h16, end, 64) + size.astype(np.uint64))


def anchors(raw: np.ndarray, offsets: np.ndarray, wide: bool):
    """Yields arrays per chunk: owner text, first owned window (in the text), windows owned, anchor hash and, if
    ``wide``, the hash of all owned bytes and the anchor's place in the text."""
    total = len(raw)
    held = {size: np.empty(min(total, CHUNK + SPAN - 1), np.uint64) for size in (0, 1, 2, 4, 8, 16)}
    for a in range(0, max(total - SPAN + 1, 0), CHUNK):
        part = raw[a: a + CHUNK + SPAN - 1]
        h = _powers(part, held)
        m = len(part) - GRAM + 1
        gram = mix(h[16][:m] * _A + h[8][16:16 + m] * _B + h[4][24:24 + m])
        ranked = (gram & ~_LOW) | np.arange(m, dtype=np.uint64)
        place = (_window_least(ranked, SPAN - GRAM + 1) & _LOW).astype(np.int64)
        starts = np.arange(len(place), dtype=np.int64)
        low, high = np.searchsorted(offsets, [a, a + len(starts) - 1], side="right") - 1
        ends = offsets[low + 1:high + 2] - a
        length = np.diff(np.clip(ends, 0, len(starts)), prepend=0)
        owner = np.repeat(np.arange(low, high + 1), length)
        inside = starts <= np.repeat(ends - SPAN, length)
        starts, place, owner = starts[inside], place[inside], owner[inside]
        if not len(starts):
            continue
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]))
        count = np.diff(np.concatenate([new, [len(starts)]]))
        first, owner, place = starts[new], owner[new], place[new]
        # Windows at the end of a text are no neighbours of the next text's, so a run is without gaps.
        found = [owner, first + a - offsets[owner], count, gram[place].view(np.int64)]
        if wide:
            found += [_long_hash(h[16], first, count + SPAN - 1).view(np.int64), place + a - offsets[owner]]
        yield found


def _texts(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    _, raw, offsets = mapped(part.column("text"), _SAME)
    return raw, offsets


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            for found in anchors(*_texts(part), wide=False):
                yield pa.RecordBatch.from_arrays([pa.array(found[3])], ["gram"])


_OWNED = "gram bigint, name bigint, doc bigint, at bigint"


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """at: first window, number of windows (8 bits) and distance of the anchor (8 bits) in one number."""
    for batch in batches:
        for part in pieces(batch):
            docs = part.column("doc").to_numpy(zero_copy_only=False)
            for owner, first, count, gram, name, place in anchors(*_texts(part), wide=True):
                at = first << 16 | count << 8 | (place - first)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(name), pa.array(docs[owner]), pa.array(at)], ["gram", "name", "doc", "at"])


_CELLS = "core bigint, name bigint, doc bigint, first bigint, bytes binary"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of the asked occurrences (``ats``) of each text."""
    for batch in batches:
        for part in pieces(batch):
            raw, offsets = _texts(part)
            asked = part.column("ats")
            at = asked.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
            docs = part.column("doc").to_numpy(zero_copy_only=False)[owner]
            first, count, far = at >> 16, at >> 8 & 255, at & 255
            anchor = first + far
            for k in range((SPAN - GRAM) // CELL + 1):
                # Windows whose distance to the anchor is in [CELL * k, CELL * k + CELL).
                low = np.maximum(first, anchor - (CELL * k + CELL - 1))
                high = np.minimum(first + count - 1, anchor - CELL * k)
                some = np.flatnonzero(low <= high)
                for a in range(0, len(some), 50_000):
                    rows = some[a:a + 50_000]
                    base = offsets[owner[rows]]
                    begin, size = base + low[rows], high[rows] - low[rows] + SPAN
                    core = base + anchor[rows] - CELL * k
                    upto = np.concatenate([[0], np.cumsum(size)])
                    flat = raw[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
                    cells = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(upto.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_each(raw, core, np.full(len(rows), CORE), k)), pa.array(_each(raw, begin, size, k)),
                         pa.array(docs[rows]), pa.array(low[rows]), cells], ["core", "name", "doc", "first", "bytes"])


def _each(raw: np.ndarray, start: np.ndarray, size: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of raw[start:start + size], with a salt."""
    out = np.full(len(start), salt, np.uint64)
    eight = raw
    for k in range(0, int(size.max()) if len(size) else 0, 8):
        word = np.zeros(len(start), np.uint64)
        for j in range(8):
            here = k + j < size
            word = word << np.uint64(8)
            word[here] |= eight[start[here] + k + j].astype(np.uint64) + np.uint64(0)
        out = mix(out * _A + word)
    return mix(out + size.astype(np.uint64)).view(np.int64)


# The transforms: strings of bytes, each closed by a byte that UTF-8 never has and read as a circle.
END = 0xFF


def transform(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rotations (to SPAN symbols at least) of a shard, as places in its text, and the symbols before them."""
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    starts = np.cumsum(sizes) - sizes
    text = np.full(int(sizes.sum()), END, np.uint8)
    for s, a in zip(strings, starts.tolist()):
        text[a:a + len(s)] = s
    start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    place = np.arange(len(text)) - start

    def ahead(step: int) -> np.ndarray:
        return start + (place + step) % size

    key = np.zeros(len(text), np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | text[ahead(j)]
    step = 8
    while True:
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[0], (key[1:] != key[:-1]).cumsum()])
        if step >= SPAN or new[-1] == len(text) - 1:
            return order, text[ahead(-1)][order]
        rank = np.empty_like(new)
        rank[order] = new
        key = (rank * (int(new[-1]) + 1) + rank[ahead(step)]).astype(np.uint64)
        step *= 2


def refine(befores: list[np.ndarray], ahead: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of shards by SPAN symbols: the shard of each merged rank, and its block of equal prefixes.

    ``befores`` are the shards' transforms; ``ahead`` has, for each of their ranks, the least and the largest round
    (exclusive) in which it is a window's suffix that still lacks its first symbols: round r extends the suffixes that
    begin SPAN - r bytes into a window by the symbol before them. Other ranks would not change the result.
    """
    shard = block = None
    # Rounds from the first on, below their number: one comparison of bytes, as rounds before the first wrap round.
    ahead = [(first.astype(np.uint8), np.clip(last - first, 0, SPAN).astype(np.uint8)) for first, last in ahead]
    for r in range(SPAN):
        if r % NEAR == 0:
            near = []
            for b, (first, number) in zip(befores, ahead):
                some = np.flatnonzero((first < r + NEAR) & (first + number > r))
                near.append((b[some], first[some], number[some]))
        live = [b[np.uint8(r) - first < number] for b, first, number in near]
        if shard is None:
            shard = np.repeat(np.arange(len(live)), [len(b) for b in live]).astype(np.uint8)
            block = np.zeros(len(shard), np.int32)
            symbols = np.empty(len(shard), np.uint8)
        for k, b in enumerate(live):
            symbols[shard == k] = b
        order = np.argsort(symbols, kind="stable")
        shard, block, ordered = shard[order], block[order], symbols[order]
        split = (ordered[1:] != ordered[:-1]) | (block[1:] != block[:-1])
        block = np.concatenate([[0], np.cumsum(split, dtype=np.int32)]).astype(np.int32)
    return shard, block


def repeats(cells: list[np.ndarray], doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (doc, start) of the cells that equal an earlier window of another cell."""
    # At most 255 shards, which one byte tells apart.
    most = max(SHARD, sum(map(len, cells)) // 200)
    shards: list[list[int]] = [[]]
    held = 0
    for i, cell in enumerate(cells):
        if held + len(cell) > most and shards[-1]:
            shards.append([])
            held = 0
        shards[-1].append(i)
        held += len(cell) + 1
    befores, ahead, places = [], [], []
    for rows in shards:
        order, before = transform([cells[i] for i in rows])
        sizes = np.array([len(cells[i]) + 1 for i in rows], np.int64)
        cell = np.repeat(np.array(rows), sizes)[order]
        offset = (np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order]
        windows = np.repeat(sizes, sizes)[order] - SPAN
        # Offset i + SPAN - r for a window i in [0, windows): in rounds SPAN - offset to SPAN - offset + windows.
        befores.append(before)
        ahead.append((np.maximum(SPAN - offset, 0).astype(np.int16), (SPAN - offset + windows).astype(np.int16)))
        whole = offset < windows
        places.append((cell[whole], offset[whole]))
    shard, block = refine(befores, ahead)
    which, offset = np.empty(len(shard), np.int64), np.empty(len(shard), np.int64)
    for k, (cell, begin) in enumerate(places):
        at = shard == k
        which[at], offset[at] = cell, begin
    docs, start = doc[which], first[which] + offset
    order = np.lexsort((start, docs, block))
    docs, start, block = docs[order], start[order], block[order]
    later = np.concatenate([[False], block[1:] == block[:-1]])
    return docs[later], start[later]


def _merge(table: pa.Table) -> pa.Table:
    """Runs of repeated windows in the cells of one task."""
    cells = [np.frombuffer(x.as_buffer(), np.uint8) for chunk in table.column("bytes").chunks for x in chunk]
    docs, starts = repeats(cells, table.column("doc").to_numpy(), table.column("first").to_numpy())
    order = np.lexsort((starts, docs))
    docs, starts = docs[order], starts[order]
    new = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1] + 1)])) if len(docs) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([new, [len(docs)]])).astype(np.int64)
    return pa.table({"doc": pa.array(docs[new], pa.int64()), "first": pa.array(starts[new], pa.int64()), "count": pa.array(count, pa.int64())})


def covered(size: int, owned: np.ndarray, kept: np.ndarray, runs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which bytes of a text go. ``owned``: occurrences of repeated anchors, without those ``kept``; runs: (first, count)."""
    owned = owned[~np.isin(owned, kept)]
    edge = np.zeros(size + 1, np.int64)
    for first, count in [(owned >> 16, owned >> 8 & 255), *runs]:
        np.add.at(edge, first, 1)
        np.add.at(edge, first + count + SPAN - 1, -1)
    return np.cumsum(edge[:-1]) > 0


_OUT = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary"


def _cut(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(column: pa.Array, i: int) -> np.ndarray:
            x = column[i]
            return x.values.to_numpy(zero_copy_only=False).astype(np.int64) if x.is_valid else np.zeros(0, np.int64)

        for batch in batches:
            for part in pieces(batch):
                raw, offsets = _texts(part)
                rows = []
                for i in range(part.num_rows):
                    text = raw[offsets[i]:offsets[i + 1]]
                    marks = [arrays(part.column(c), i) for c in ("owned", "kept", "cells", "cells_kept", "runs")]
                    gone = np.zeros(len(text), bool)
                    if any(len(m) for m in marks):
                        owned, kept, cells, cells_kept, runs = marks
                        cells = cells[~np.isin(cells >> 8, cells_kept)]
                        gone = covered(len(text), owned, kept, [(cells >> 8, cells & 255), (runs >> 32, runs & 0xFFFFFFFF)])
                    left = text[~gone].tobytes()
                    spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
                    rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left if with_bytes else None))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                    ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    return run


def _release(spark: SparkSession) -> None:
    """Let the cleaner drop the shuffle files of phases that are done; their results are tables by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def dedup(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept_bytes``) of each row of ``docs`` (doc_id, text)."""
    odd = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if odd.isEmpty():
        found = _dedup(docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text"), with_bytes)
        return found.withColumnRenamed("doc", "doc_id")
    named = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("name"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("name")]
    numbered = stage(positions(named.select("doc_id", "name").distinct(), order, "pos").select(F.col("doc_id").alias("_id"), F.col("name").alias("_name"), F.col("pos").alias("doc")))
    keyed = stage(named.join(numbered, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("name") == F.col("_name"))).select("doc_id", "doc", "text"))
    found = _dedup(keyed.select("doc", "text").dropDuplicates(["doc"]), with_bytes)
    return keyed.select("doc_id", F.col("doc").alias("_doc")).join(found, F.col("_doc") == F.col("doc")).drop("doc", "_doc")


def _dedup(docs: DataFrame, with_bytes: bool) -> DataFrame:
    spark = docs.sparkSession
    twice = stage(docs.mapInArrow(_grams, "gram bigint").groupBy("gram").count().filter("count > 1").select(F.col("gram").alias("g")))
    _release(spark)
    owned = stage(docs.mapInArrow(_owned, _OWNED).join(twice, F.col("gram") == F.col("g")).drop("g"))
    _release(spark)
    classes = stage(owned.groupBy("gram", "name").agg(F.min(F.struct("doc", "at")).alias("rep")).select("gram", "rep.*"))
    several = stage(classes.groupBy("gram").count().filter("count > 1").select(F.col("gram").alias("g")))
    asked = classes.join(several, F.col("gram") == F.col("g")).groupBy("doc").agg(F.collect_list("at").alias("ats"))
    asked = stage(asked.select(F.col("doc").alias("d"), "ats"))
    _release(spark)
    cells = stage(docs.join(asked.hint("shuffle_hash"), F.col("doc") == F.col("d")).select("doc", "text", "ats").mapInArrow(_cells, _CELLS))
    _release(spark)
    windows = F.octet_length("bytes") - (SPAN - 1)
    kinds = stage(cells.groupBy("core", "name").agg(F.min(F.struct("doc", "first")).alias("rep")).select("core", "name", "rep.*"))
    mixed = stage(kinds.groupBy("core").count().filter("count > 1").select(F.col("core").alias("c")))
    open_cells = kinds.join(mixed, F.col("core") == F.col("c")).select("core", F.col("doc").alias("d"), F.col("first").alias("f"))
    # A cell is named by its first window: every window is in one cell.
    merge = stage(cells.drop("core").join(open_cells, (F.col("doc") == F.col("d")) & (F.col("first") == F.col("f"))).select("core", "doc", "first", "bytes"))
    size = merge.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    tasks = max(1, -(-size // TASK))
    runs = stage(merge.withColumn("task", F.pmod(F.xxhash64("core"), F.lit(tasks))).groupBy("task").applyInArrow(_merge, "doc bigint, first bigint, count bigint"))
    _release(spark)

    def marks(df: DataFrame, name: str, value) -> DataFrame:
        return df.select(F.col("doc").alias("d"), F.lit(name).alias("kind"), value.cast("bigint").alias("value"))

    # A kept occurrence that was cut into cells is judged by them; the others stay as they are.
    every = (
        marks(owned, "owned", F.col("at")).unionByName(marks(classes, "kept", F.col("at")))
        .unionByName(marks(cells, "cells", F.col("first") * 256 + windows)).unionByName(marks(kinds, "cells_kept", F.col("first")))
        .unionByName(marks(runs, "runs", F.col("first") * (1 << 32) + F.col("count")))
    )
    lists = [F.collect_list(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k in ("owned", "kept", "cells", "cells_kept", "runs")]
    per_doc = stage(every.groupBy("d").agg(*lists))
    _release(spark)
    full = docs.join(per_doc.hint("shuffle_hash"), F.col("doc") == F.col("d"), "left").drop("d")
    out = full.mapInArrow(_cut(with_bytes), _OUT)
    return out if with_bytes else out.drop("kept_bytes")
