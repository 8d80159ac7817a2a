"""Near-duplicate documents: SuperMinHash signatures, banding, verified links, union-find groups.

A document's set holds the 64-bit hashes of its distinct five-word shingles
(ASCII letters lower-cased); with fewer words, the whole sequence is one
shingle. SuperMinHash gives every element one rank per round and a permutation
of the ``SLOTS`` signature slots: in round j the element offers j + (a random
fraction) to the j-th slot of its permutation. A slot that is filled in one
round cannot change in a later one, so a document stops as soon as all slots
are filled, which takes one or two rounds for ordinary lengths. ``BANDS`` bands
of ``ROWS`` slots miss a pair of similarity 0.75 with odds of 5e-6.

Documents with equal sets fold to one representative first. In each bucket the
members are compared with the bucket's least member only, on full sets; links
are grouped. Members of buckets that still hold several groups are told by how
they differ from the elements that most of them hold (see ``_apart``): the
least different one takes in all that are linked with it for certain, and of
the others only those are compared whose differences can share enough for a
link (see ``_across``). Both are exact.
No bucket, candidate or link is left out, and a bucket whose
members are already one group costs nothing more.

Cases: NULL, empty or blank text has an empty set, is linked with nothing and
is its own component. Repeated rows are copies. Rows that share an id are one
node: its links are those of all its texts. A NULL id belongs to no group
(component NULL). An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaymart.llm.common import coded, hash_words, mix, pieces, words_of
from quaymart.llm.groups import components
from quaymart.session import stage

SHINGLE = 5
ROWS, BANDS = 4, 32
SLOTS = ROWS * BANDS          # a power of two, at most 128
NUM, DEN = 75, 100            # link when DEN * intersection >= NUM * union

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(text: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, starts = words_of(text, lower=True)
    ids, distinct = coded(words)
    w = mix(hash_words(distinct))[ids] if len(ids) else np.zeros(0, np.uint64)
    n = len(w) - SHINGLE + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(SHINGLE):
        if n > 0:
            rolled += w[k: n + k] * _ODD[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= SHINGLE:
            h = np.sort(rolled[a: b - SHINGLE + 1])
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        elif b > a:
            few = (w[a:b] * _ODD[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([few], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _slot(element: np.ndarray, j: int) -> np.ndarray:
    """Where the element's own permutation of the slots has j: a keyed bijection on SLOTS numbers."""
    key = mix(element ^ np.uint64(0x5851F42D4C957F2D))
    low = np.uint64(SLOTS - 1)
    x = np.full(len(element), j, np.uint64)
    for k in range(3):
        x = (x * ((key >> np.uint64(14 * k)) | np.uint64(1)) + (key >> np.uint64(14 * k + 7))) & low
        x ^= x >> np.uint64(3)
    return x.astype(np.int64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of each set, one row of SLOTS values; a slot's value is its round and a 32-bit fraction."""
    sig = np.full((len(sets), SLOTS), _FREE, np.uint64)
    if not sets:
        return sig
    element = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = sig.reshape(-1)
    for j in range(SLOTS):
        if not len(element):
            break
        rank = (mix(element + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(32)) | np.uint64(j << 32)
        np.minimum.at(flat, doc * SLOTS + _slot(element, j), rank)
        live = np.unique(doc)
        unfilled = np.zeros(len(sets), bool)
        unfilled[live] = (sig[live] == _FREE).any(axis=1)
        keep = unfilled[doc]
        element, doc = element[keep], doc[keep]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One hash per band of each signature."""
    rows = sig.reshape(len(sig), BANDS, ROWS)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[4], (len(sig), 1))
    for k in range(ROWS):
        key = mix(key + rows[:, :, k] * _ODD[k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            sets = shingle_sets(part.column("text"))
            names = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            keys = band_keys(signatures(sets))
            full = np.array([len(s) > 0 for s in sets], bool)
            offsets = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([(x >> 64) - (1 << 63) for x in names], pa.int64()),
                pa.array([(x & (1 << 64) - 1) - (1 << 63) for x in names], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].reshape(-1)))],
                ["doc_id", "n_shingles", "name_a", "name_b", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            sets = [s.tobytes() for s in shingle_sets(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "elements"])


def _both_sets(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(batch.column("left"), batch.column("right")):
        yield np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)


def _inside(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of x (sorted) are in y (sorted, not empty)."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(len(x), len(y), int(_inside(*((x, y) if len(x) <= len(y) else (y, x))).sum())) for x, y in _both_sets(batch)]
        cols = list(zip(*found)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *[pa.array(c, pa.int64()) for c in cols]], ["a", "b", "n_a", "n_b", "both"])


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("left")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("right")), "b")
    )


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sizes and intersection of the full sets of each pair (a, b)."""
    return _with_sets(pairs, sets).select("a", "b", "left", "right").mapInArrow(_overlap, "a bigint, b bigint, n_a bigint, n_b bigint, both bigint")


LINKED = f"both * {NUM + DEN} >= (n_a + n_b) * {NUM}"


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (doc_id, text)."""
    base = stage(docs.select("doc_id", "text").mapInArrow(
        _sign, "doc_id bigint, n_shingles bigint, name_a bigint, name_b bigint, bands array<bigint>"))
    known = base.filter("n_shingles > 0 and doc_id is not null")
    names = stage(known.groupBy("name_a", "name_b").agg(F.min("doc_id").alias("rep")))
    standing = known.join(names.select("rep", F.col("name_a").alias("a"), F.col("name_b").alias("b")),
                          (F.col("doc_id") == F.col("rep")) & (F.col("name_a") == F.col("a")) & (F.col("name_b") == F.col("b")))
    keyed = standing.select("rep", F.explode("bands").alias("key"))
    shared = stage(keyed.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).filter("lead < last").select("key", "lead"))
    members = stage(keyed.join(shared, "key").distinct())
    involved = members.select("rep").distinct()
    sets = stage(docs.select("doc_id", "text").join(involved.hint("shuffle_hash"), F.col("doc_id") == F.col("rep"))
                 .select("doc_id", "text").mapInArrow(_sets, "doc_id bigint, elements binary"))
    tried = stage(overlaps(members.filter("rep > lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct(), sets))
    links = stage(tried.filter(LINKED).select("a", "b").distinct().unionByName(_same_id(known, names)))
    ties = components(links)
    placed = _placed(members, ties)
    if not placed.isEmpty():
        apart = stage(_apart(placed, ties, sets))
        ties = _joined(ties, overlaps(_sure(apart), sets).filter(LINKED).select("a", "b"))
        rest = stage(_across(apart, ties).join(tried.select("a", "b"), ["a", "b"], "left_anti"))
        ties = _joined(ties, overlaps(rest, sets).filter(LINKED).select("a", "b"))
    rep_of = names.withColumnRenamed("name_a", "a").withColumnRenamed("name_b", "b")
    out = base.join(rep_of, (F.col("name_a") == F.col("a")) & (F.col("name_b") == F.col("b")) & F.col("doc_id").isNotNull(), "left")
    # Rows that share an id may have different sets, hence different representatives: take the least component.
    tied = out.select("doc_id", "n_shingles", "rep").join(ties, F.col("rep") == F.col("u"), "left")
    return tied.select("doc_id", "n_shingles", F.coalesce("v", "rep", "doc_id").alias("component_id"))


def _same_id(known: DataFrame, names: DataFrame) -> DataFrame:
    """Links between an id and the representatives of its texts, where rows share an id but not a set."""
    name = F.struct("name_a", "name_b")
    many = known.groupBy("doc_id").agg(F.min(name).alias("x"), F.max(name).alias("y")).filter("x <> y").select(F.col("doc_id").alias("id"))
    return (
        known.join(many, F.col("doc_id") == F.col("id")).join(names, ["name_a", "name_b"])
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    )


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "elements"):
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("elements")]
            sizes = [len(s) for s in sets]
            home, crowd = [pa.array(np.repeat(part.column(c).to_numpy(zero_copy_only=False), sizes), pa.int64()) for c in ("home", "crowd")]
            yield pa.RecordBatch.from_arrays([home, crowd, pa.array(np.concatenate(sets))], ["home", "crowd", "element"])


def _mixed(placed: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    keys = stage(placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("key"))
    return placed.join(keys, "key")


def _placed(members: DataFrame, ties: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component besides their lead, which has been compared with all."""
    comp = F.coalesce("v", "rep").alias("comp")
    return stage(_mixed(stage(members.filter("rep > lead").join(ties, F.col("rep") == F.col("u"), "left").select("key", "lead", "rep", comp))))


def _joined(ties: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links."""
    links = stage(links.distinct())
    return ties if links.isEmpty() else components(ties.select(F.col("v").alias("a"), F.col("u").alias("b")).unionByName(links))


_APART = "home bigint, rep bigint, part bigint, comp bigint, n bigint, excess bigint, element bigint"


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements that either a member or its home's middle has, after one row without an element.

    ``part`` tells the texts of rows that share an id apart.
    """
    for batch in batches:
        for some in pieces(batch, "elements"):
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in some.column("elements")]
            found = [np.setxor1d(x, y.values.to_numpy(), assume_unique=True) for x, y in zip(sets, some.column("middle"))]
            rows = np.array([len(d) + 1 for d in found], np.int64)
            n, d = np.array([len(x) for x in sets], np.int64), rows - 1
            part = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in sets], np.int64)
            element = np.concatenate([x for d in found for x in (np.zeros(1, np.int64), d)])
            none = np.zeros(len(element), bool)
            none[np.cumsum(rows) - rows] = True
            ids = [some.column(c).to_numpy(zero_copy_only=False) for c in ("home", "rep", "comp")]
            home, rep, comp, part, n, excess = [np.repeat(c, rows) for c in (*ids, part, n, (NUM + DEN) * d - (DEN - NUM) * n)]
            for at in range(0, len(element), 1 << 20):
                cut = slice(at, at + (1 << 20))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c[cut], pa.int64()) for c in (home, rep, part, comp, n, excess)], pa.array(element[cut], mask=none[cut])],
                    ["home", "rep", "part", "comp", "n", "excess", "element"])


def _apart(placed: DataFrame, ties: DataFrame, sets: DataFrame) -> DataFrame:
    """How members of mixed buckets differ from the middle of their home: a row per member and one per element.

    The home of a bucket is the component of its lead, its middle the set of the elements that more than half of the
    home's members hold: of many edited copies of a text, about the text itself, though nobody may have it unedited.

    Let d elements be in one of a member's set of n and the middle only. Two sets are linked when at most (n1 + n2) *
    (DEN - NUM) / (DEN + NUM) elements are in one of them only, and that number is d1 + d2 - 2 * (the elements which
    are in both differences). So with ``excess`` = (NUM + DEN) * d - (DEN - NUM) * n, two members are linked exactly
    when their differences share at least (excess1 + excess2) / (2 * (NUM + DEN)) elements.
    """
    home = placed.select("lead").distinct().join(ties, F.col("lead") == F.col("u"), "left").select("lead", F.coalesce("v", "lead").alias("home"))
    pool = stage(placed.select("lead", "rep", "comp").distinct().join(home, "lead").select("home", "rep", "comp").distinct())
    full = pool.join(sets, F.col("rep") == F.col("doc_id"))
    crowd = stage(pool.join(sets.select("doc_id"), F.col("rep") == F.col("doc_id")).groupBy("home").agg(F.count("*").alias("crowd")))
    # Each element brings the crowd along, so that only those of the middle travel to their home.
    held = full.join(crowd, "home").select("home", "crowd", "elements").mapInArrow(_elements, "home bigint, crowd bigint, element bigint")
    often = held.groupBy("home", "crowd", "element").agg(F.count("*").alias("often")).filter("often * 2 > crowd")
    middle = stage(stage(often.select("home", "element")).groupBy("home").agg(F.collect_list("element").alias("middle")))
    beside = full.join(middle, "home", "left").withColumn("middle", F.coalesce("middle", F.array().cast("array<bigint>")))
    return beside.select("home", "rep", "comp", "elements", "middle").mapInArrow(_differences, _APART)


def _sure(apart: DataFrame) -> DataFrame:
    """The pairs of each home's least different member with all that its difference alone shows to be linked with it.

    All pairs without any need to share differences are linked through that member, too.
    """
    each = apart.filter("element is null")
    best = stage(each.groupBy("home").agg(F.min(F.struct("excess", "rep", "comp")).alias("best")))
    near = each.join(best, "home").filter("comp <> best.comp and excess + best.excess <= 0")
    return near.select(F.least("rep", "best.rep").alias("a"), F.greatest("rep", "best.rep").alias("b")).distinct()


def _across(apart: DataFrame, ties: DataFrame) -> DataFrame:
    """Pairs of a home that are in different components so far and may still be linked.

    Their differences must share elements (see ``_apart``), and only elements that members of several components have
    in their differences count. With these in a common order, the rarest first, a member shares at most as many as
    follow the first shared one: this is asked of each element against the least excess in any other component,
    which leaves a few elements of most members to be indexed, and then of each pair that meets at one.
    """
    rows = stage(apart.drop("comp").join(ties, F.col("rep") == F.col("u"), "left").withColumn("comp", F.coalesce("v", "rep")).drop("u", "v"))
    each = rows.filter("element is null").groupBy("home", "comp").agg(F.min("excess").alias("excess"))
    first = stage(each.groupBy("home").agg(F.min(F.struct("excess", "comp")).alias("first")))
    other = each.join(first, "home").filter("comp <> first.comp").groupBy("home").agg(F.min("excess").alias("second"))
    rivals = stage(first.join(other, "home"))
    common = (
        rows.filter("element is not null").groupBy("home", "element").agg(F.count("*").alias("often"), F.min("comp").alias("x"), F.max("comp").alias("y"))
        .filter("x < y").select("home", "element", "often")
    )
    mine = Window.partitionBy("home", "rep", "part")
    useful = rows.join(rivals, "home").join(common, ["home", "element"])
    useful = useful.withColumn("left", F.count("*").over(mine) - F.row_number().over(mine.orderBy("often", "element")) + 1)
    rival = F.when(F.col("comp") == F.col("first.comp"), F.col("second")).otherwise(F.col("first.excess"))
    indexed = stage(useful.filter(F.col("left") * 2 * (NUM + DEN) >= F.col("excess") + rival).select("home", "element", "rep", "comp", "n", "excess", "left"))
    other = indexed.select("home", "element", *[F.col(c).alias(f"{c}_b") for c in ("rep", "comp", "n", "excess", "left")])
    fit = (F.col("rep") < F.col("rep_b")) & (F.col("comp") != F.col("comp_b"))
    fit &= F.least("n", "n_b") * DEN >= F.greatest("n", "n_b") * NUM
    fit &= F.least("left", "left_b") * 2 * (NUM + DEN) >= F.col("excess") + F.col("excess_b")
    same = [indexed[c] == other[c] for c in ("home", "element")]
    return indexed.join(other, [*same, fit]).select(F.col("rep").alias("a"), F.col("rep_b").alias("b")).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group, that of the least id. Rows without an id or without words all stay."""
    found = stage(classes(docs))
    gone = found.filter("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone.hint("shuffle_hash"), F.col("doc_id") == F.col("_gone"), "left_anti")
    many = stage(found.filter("n_shingles > 0").groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select(F.col("doc_id").alias("_many")))
    if many.isEmpty():
        return kept
    once = kept.join(many, F.col("doc_id") == F.col("_many")).drop("_many").dropDuplicates(["doc_id"])
    return kept.join(many, F.col("doc_id") == F.col("_many"), "left_anti").unionByName(once)
