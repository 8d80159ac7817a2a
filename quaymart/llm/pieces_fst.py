"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file and composed with each input:
the normaliser (blank to its mark, mark put in front), the pieces (a trie whose
final states emit a piece id), and the byte fallback (a character that no piece
covers leaves as one id per UTF-8 byte). The model's merges are the third
weight: a path may take piece b after piece a at weight 0 if merging the text
of a and b gives back exactly a and b, otherwise at infinity. In the tropical
semiring (min, +) the shortest path over the lattice is then the path of
weight 0 plus a penalty for each byte-fallback character, and it is the segmentation that the
model's own merging finds. One forward pass keeps, per position, the arcs of
least weight; the way back reads off the pieces.

No piece has a blank mark behind another character, so no path crosses the
start of a word: a text is a sequence of words, each with the marks before it.
Tasks compose each distinct word of a batch once and put texts together from
word results as arrays.

Cases: NULL text is the empty text and has no ids. NUL, unpaired or unknown
characters go to byte fallback. Decoding is the inverse transducer: bytes join
to UTF-8, marks become blanks, the mark in front is dropped. Repeated rows are
encoded alike; an empty table gives an empty result; other columns stay.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quaymart.llm.common import coded, pieces, plain

MARK = "▁"
INF = float("inf")
# Words kept per task before the table is emptied.
KNOWN_WORDS = 300_000
# Words whose lattices advance together.
TOGETHER = 40_000
# Words up to this length, of covered characters, are composed many at a time.
WIDE = 48
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_LINE = re.compile("(\n)")
_CUT = "\0"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _hash(piece: str) -> np.uint64:
    """Polynomial hash of a piece, last character first."""
    code, power = 0, 1
    for ch in reversed(piece):
        code = (code + (ord(ch) + 1) * power) & 0xFFFFFFFFFFFFFFFF
        power = power * int(_BASE) & 0xFFFFFFFFFFFFFFFF
    return _mix(np.array([code], np.uint64))[0]


class Transducer:
    """The compiled model. ``encode`` gives ids of a normalised word; ``normalise`` maps a text to words."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.text: list[bytes] = []
        self.rank: dict[str, tuple[float, int]] = {}
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.text.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                self.rank[piece] = (-model.get_score(i), i)
                self.text.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece crosses the start of a word: words can't be encoded apart")
        self.longest = max(map(len, self.rank), default=1)
        # A line feed that is in no piece ends a word, too.
        self.breaks = not any("\n" in p for p in self.rank)
        self._compile()

    def _compile(self) -> None:
        """Arrays of the same machines, for many words at a time.

        Pieces are numbered by id. ``halves`` are the two pieces that a piece's last merge joins; ``joins`` maps a
        pair of pieces to the rank of their join. Ranks are dense, equal scores being equal ranks.
        """
        size = len(self.text)
        order = {r: n for n, r in enumerate(sorted({r for r, _ in self.rank.values()}))}
        self.dense = np.full(size, -1, np.int64)       # -1: a character, which no merge made
        self.halves = np.full((2, size), -1, np.int64)
        hashes, ids, pairs, joined = [], [], [], []
        for piece, (rank, i) in self.rank.items():
            trace: list[tuple[str, str]] = []
            if len(piece) > 1:
                for k in range(1, len(piece)):
                    left, right = self.rank.get(piece[:k]), self.rank.get(piece[k:])
                    if left is not None and right is not None:
                        pairs.append(left[1] << 32 | right[1])
                        joined.append(order[rank])
                if self.merged(piece, trace) != [piece]:
                    continue                            # its own characters merge to something else
                if any(x not in self.rank for x in trace[-1]):
                    continue                            # made of characters that are no pieces: left to the plain search
                self.dense[i] = order[rank]
                self.halves[:, i] = [self.rank[x][1] for x in trace[-1]]
            hashes.append(_hash(piece))
            ids.append(i)
        at = np.argsort(np.array(hashes, np.uint64))
        self.hashes, self.hash_ids = np.array(hashes, np.uint64)[at], np.array(ids, np.int64)[at]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.hashes >> np.uint64(42)).astype(np.int64)] = True
        at = np.argsort(np.array(pairs, np.int64))
        self.pairs, self.joined = np.array(pairs, np.int64)[at], np.array(joined, np.int64)[at]

    def _caches(self) -> None:
        """What a task remembers; not part of the model that travels."""
        self.fits = lru_cache(maxsize=1 << 18)(self._fits)
        self.sound = lru_cache(maxsize=1 << 18)(self._sound)
        self.pair_key = np.full(1 << 21, -1, np.int64)
        self.pair_ok = np.zeros(1 << 21, bool)

    def merged(self, text: str, trace: list[tuple[str, str]] | None = None) -> list[str]:
        """Pieces of a short text by the model's merges: best rank first, then leftmost."""
        parts = list(text)
        while True:
            best, at = (INF, 0), -1
            for i in range(len(parts) - 1):
                found = self.rank.get(parts[i] + parts[i + 1])
                if found is not None and (found[0], i) < best:
                    best, at = (found[0], i), i
            if at < 0:
                return parts
            if trace is not None:
                trace.append((parts[at], parts[at + 1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _sound(self, piece: str) -> bool:
        """Whether merging the piece's characters gives the piece."""
        return len(piece) == 1 or self.merged(piece) == [piece]

    def _fits(self, a: str, b: str) -> bool:
        """Weight 0 for b after a (else infinity): their text merges to just these two."""
        return self.merged(a + b) == [a, b]

    def segments(self, word: str) -> list[str]:
        """The shortest path through the lattice of a word, as pieces (single characters where none covers)."""
        n = len(word)
        # arcs[i]: the pieces that end at i on a path of finite weight, with that weight and their predecessor.
        arcs: list[dict[str, tuple[int, str | None]]] = [{} for _ in range(n + 1)]
        for end in range(1, n + 1):
            here = arcs[end]
            for start in range(max(0, end - self.longest), end):
                piece = word[start:end]
                if piece in self.rank:
                    if not self.sound(piece):
                        continue
                    weight = 0
                elif end - start == 1:
                    weight = 1
                else:
                    continue
                if start == 0:
                    here[piece] = (weight, None)
                    continue
                least = min(((w, p) for p, (w, _) in arcs[start].items() if self.fits(p, piece)), default=None)
                if least is not None:
                    here[piece] = (least[0] + weight, least[1])
        if not n:
            return []
        if not arcs[n]:
            raise ValueError("no path through the lattice")
        piece = min(arcs[n], key=lambda p: arcs[n][p][0])
        out, at = [], n
        while piece is not None:
            out.append(piece)
            before = arcs[at][piece][1]
            at -= len(piece)
            piece = before
        return out[::-1]

    def _join_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a and b would merge to, or a number above all ranks."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.joined[at], 1 << 40)

    def _fit_many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_fits`` for arrays: undo the last merge at the border again and again; the border must never be the
        better merge. Of equal ranks the left one goes first."""
        ok = np.zeros(len(a), bool)
        rows = np.arange(len(a))
        limit = np.full(len(a), 1 << 40)               # the border merges if its rank is below
        while len(rows):
            stays = self._join_rank(a, b) >= limit
            rows, a, b = rows[stays], a[stays], b[stays]
            left = self.dense[a] > self.dense[b]
            ended = ~left & (self.dense[b] < 0)
            ok[rows[ended]] = True
            rows, a, b, left = rows[~ended], a[~ended], b[~ended], left[~ended]
            limit = np.where(left, self.dense[a], self.dense[b] + 1)
            a, b = np.where(left, self.halves[1][a], a), np.where(left, b, self.halves[0][b])
        return ok

    def _fit_cached(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = (_mix(key.view(np.uint64)) >> np.uint64(43)).astype(np.int64)
        ok = self.pair_ok[at]
        new = np.flatnonzero(self.pair_key[at] != key)
        if len(new):
            ok[new] = self._fit_many(a[new], b[new])
            self.pair_key[at[new]] = key[new]
            self.pair_ok[at[new]] = ok[new]
            # Two new pairs may share a place: keep the answer that belongs to the key kept there.
            odd = new[self.pair_key[at[new]] == key[new]]
            self.pair_ok[at[odd]] = ok[odd]
        return ok

    def encode_many(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        return [x for a in range(0, len(words), TOGETHER) for x in self._encode_some(words[a:a + TOGETHER])]

    def _encode_some(self, words: list[str]) -> list[np.ndarray]:
        """The lattices of all plain words advance together, position by position."""
        out: list[np.ndarray | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if 0 < len(w) <= WIDE and MARK not in w[1:]]
        plain.sort(key=lambda i: -len(words[i]))
        lengths = np.array([len(words[i]) for i in plain], np.int64)
        count = len(plain)
        if count:
            wide = int(lengths[0])
            chars = np.zeros((wide, count), np.uint32)
            flat = np.frombuffer("".join([words[i] for i in plain]).encode("utf-32-le", "surrogatepass"), np.uint32)
            starts = np.cumsum(lengths) - lengths
            for k in range(wide):
                live = int(np.searchsorted(-lengths, -k, side="left"))   # words longer than k
                chars[k, :live] = flat[starts[:live] + k]
            last = np.full((wide + 1, count), -1, np.int32)      # the piece that ends at a position
            size = np.zeros((wide + 1, count), np.uint8)
            odd = np.zeros(count, bool)                           # words for the plain search
            powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.longest, _BASE)]), dtype=np.uint64)
            for end in range(1, wide + 1):
                live = int(np.searchsorted(-lengths, -end, side="right"))
                code = np.zeros(live, np.uint64)
                for n in range(1, min(end, self.longest) + 1):
                    code = code + (chars[end - n, :live].astype(np.uint64) + np.uint64(1)) * powers[n - 1]
                    h = _mix(code)
                    rows = np.flatnonzero(self.maybe[(h >> np.uint64(42)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(self.hashes, h[rows]), len(self.hashes) - 1)
                    hit = self.hashes[at] == h[rows]
                    rows, piece = rows[hit], self.hash_ids[at[hit]]
                    if end > n:
                        before = last[end - n, rows].astype(np.int64)
                        there = before >= 0
                        rows, piece, before = rows[there], piece[there], before[there]
                        fit = self._fit_cached(before, piece)
                        rows, piece = rows[fit], piece[fit]
                    odd[rows[last[end, rows] >= 0]] = True        # two shortest paths: not decided here
                    last[end, rows] = piece
                    size[end, rows] = n
            cols = np.arange(count)
            odd |= last[lengths, cols] < 0
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            rows, at = cols[~odd], lengths[~odd].copy()
            while len(rows):
                found.append((rows, at, last[at, rows]))
                at = at - size[at, rows]
                rows, at = rows[at > 0], at[at > 0]
            if found:
                row, pos, piece = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((pos, row))
                row, piece = row[order], piece[order].astype(np.int32)
                bounds = np.searchsorted(row, np.arange(count + 1)).tolist()
                for c in np.flatnonzero(~odd).tolist():
                    out[plain[c]] = piece[bounds[c]:bounds[c + 1]]
        return [np.array(self.encode_word(w), np.int32) if x is None else x for w, x in zip(words, out)]

    def encode_word(self, word: str) -> list[int]:
        out: list[int] = []
        for piece in self.segments(word):
            found = self.rank.get(piece)
            out += [found[1]] if found is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]
        return out

    @staticmethod
    def normalise(text: str) -> str:
        """The identity normaliser with blanks marked and a mark in front."""
        return MARK + text.replace(" ", MARK) if text else ""

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of ids; one blank in front, which encoding put there, is dropped."""
        raw = b"".join([self.text[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])
        return raw.decode("utf-8", "replace").removeprefix(" ")


class Encoder:
    """Texts to id arrays, with a bounded table of the words met so far."""

    def __init__(self, transducer: Transducer):
        self.fst = transducer
        transducer._caches()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _words(self, text: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of the normalised texts, and where each text's words begin (one more at the end)."""
        odd = pc.starts_with(text, " ")
        for sign in ("  ", MARK, _CUT):
            odd = pc.or_(odd, pc.match_substring(text, sign))
        rows = odd.to_numpy(zero_copy_only=False) | (not self.fst.breaks)
        marked = pc.replace_substring(pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), text, pa.scalar("", pa.large_string())), " ", _CUT + MARK)
        marked = pc.if_else(pc.equal(text, ""), pa.scalar("", pa.large_string()), pc.replace_substring(marked, "\n", f"{_CUT}\n{_CUT}"))
        if rows.any():
            # Texts with marks, cuts or runs of blanks: words by the rule, with the same line breaks.
            as_list = marked.to_pylist()
            for i in np.flatnonzero(rows).tolist():
                parts = _LINE.split(self.fst.normalise(text[i].as_py())) if self.fst.breaks else [self.fst.normalise(text[i].as_py())]
                as_list[i] = [w for part in parts for w in ([part] if part == "\n" else _WORD.findall(part))]
            as_list = [x if isinstance(x, list) else x.split(_CUT) for x in as_list]
            starts = np.concatenate([[0], np.cumsum([len(x) for x in as_list])])
            return pa.array([w for x in as_list for w in x], pa.large_string()), starts
        parts = pc.split_pattern(marked, _CUT)
        return parts.flatten(), np.asarray(parts.offsets, np.int64) - parts.offsets[0].as_py()

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        words, begins = self._words(plain(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())))
        numbers, distinct = coded(words)
        del words
        distinct = distinct.to_pylist()
        known = self.known
        fresh = [w for w in distinct if w not in known]
        if fresh:
            found = self.fst.encode_many(fresh)
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            self.flat = np.concatenate([self.flat, *found])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) for x in found])])
        which = np.array([known[w] for w in distinct], np.int64)[numbers]
        table = pa.ListArray.from_arrays(pa.array(self.starts.astype(np.int32)), pa.array(self.flat))
        taken = table.take(pa.array(which))
        ids, bounds = taken.values.to_numpy(), np.asarray(taken.offsets)[begins].tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with ``ids``: the piece ids of ``text``. The model file is read on the driver."""
    from pyspark.sql.types import ArrayType, IntegerType, StructType

    docs = docs.select(*[c for c in docs.columns if c != "ids"])
    shared = docs.sparkSession.sparkContext.broadcast(Transducer(model_file))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in pieces(batch):
                found = encoder.encode(part.column("text"))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), flat)],
                                                 [*part.schema.names, "ids"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("ids", ArrayType(IntegerType())))


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded`` (with ``ids``) with ``decoded``: the text of the ids."""
    from pyspark.sql.types import StringType, StructType

    encoded = encoded.select(*[c for c in encoded.columns if c != "decoded"])
    shared = encoded.sparkSession.sparkContext.broadcast(Transducer(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = shared.value
        for batch in batches:
            # Ids take at least as many bytes as a piece of text; rows are handled one after the other.
            texts = [fst.decode(x.values.to_numpy()) if x.is_valid else None for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields]).add("decoded", StringType()))


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, round_trip`` of each row: its ids in digest, and whether decoding them gives the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(Transducer(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in pieces(batch):
                found = encoder.encode(part.column("text"))
                same = [encoder.fst.decode(ids) == (text.as_py() or "") for text, ids in zip(part.column("text"), found)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) for x in found], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, round_trip boolean")
