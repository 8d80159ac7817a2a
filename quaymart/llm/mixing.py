"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target size: its share of the budget by weight, at most
``cap`` times what it holds, with the excess reshared among the others. A
document is then to be copied target / size-of-source times on average. The
whole part of that number is certain; the rest is a probability which is
rounded so that the words taken stay what they are expected to be.

Pivotal step: two fractional documents of one source trade words until one of
them has none or all; the direction is random, with odds that keep every
probability. The other keeps the open remainder. A block folds its documents
one after the other and leaves one remainder, the remainders of many blocks
form the blocks of the next level, up to one remainder per source, which is
rounded by its own probability. So a source misses its target by less than one
document. Blocks hold about ``BLOCK`` documents, however large the source.

Only DataFrame functions are used; random numbers are hashes, so reruns agree.

Cases: NULL text or text without words has size 0, takes nothing and is never
open. A NULL source is a source of its own, last in order. Repeated rows (and
repeated ids) are rounded as separate documents. An empty table gives an empty
result. A source without words has target 0. Columns other than the three that
are named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymart.session import stage

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2.0
BLOCK = 128
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"

_ITEM = "struct<doc_id:bigint,size:bigint,held:double,tie:bigint>"
_DONE = "array<struct<doc_id:bigint,size:bigint,extra:int>>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
                   cap: float = CAP) -> DataFrame:
    """One row per source: ``source, n_docs, source_size, target``.

    ``sizes`` has (source, size). A source is full if its target reaches ``cap`` times its size; ordered by
    cap-to-weight ratio, the full ones come first, so one running sum finds the level that the others share.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("bigint")).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(n)) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    every = Window.partitionBy()
    ratio = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    return (
        per.withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(budget)))
        .withColumn("weights", F.sum("weight").over(every))
        # Level if this source and all with a larger ratio share what the smaller ones leave.
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                    / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("open", F.col("ratio") >= F.col("level"))
        # The level is settled at the first source that is not full.
        .withColumn("settled", F.min(F.when(F.col("open"), F.struct("ratio", "level"))).over(every))
        .withColumn("target", F.when(F.coalesce(F.col("ratio") < F.col("settled.ratio"), F.lit(True)), F.col("most"))
                    .otherwise(F.least(F.col("most"), F.col("settled.level") * F.col("weight"))))
        .select("source", "n_docs", "source_size", "target")
    )


def _uniform(*parts: Column) -> Column:
    """[0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _trade(acc: Column, item: Column) -> Column:
    """Fold one open document into the open remainder of its block."""
    one, two = acc["open"], item
    a, m, b, k = one["size"].cast("double"), one["held"], two["size"].cast("double"), two["held"]
    up = F.least(a - m, k)      # words that the first can gain from the second
    down = F.least(m, b - k)    # and lose to it
    gain = _uniform(one["doc_id"], two["doc_id"], one["tie"], two["tie"], F.lit(SEED)) * (up + down) < down
    first_ends = F.when(gain, a - m <= k).otherwise(m <= b - k)
    left = F.when(first_ends, F.when(gain, k - (a - m)).otherwise(k + m)).otherwise(F.when(gain, m + k).otherwise(m - (b - k)))
    stays = F.when(first_ends, two).otherwise(one)
    ended = F.when(first_ends, one).otherwise(two)
    extra = F.when(first_ends, gain.cast("int")).otherwise((~gain).cast("int"))
    size = stays["size"].cast("double")
    open_ = F.struct(stays["doc_id"].alias("doc_id"), stays["size"].alias("size"),
                     F.greatest(F.lit(0.0), F.least(left, size)).alias("held"), stays["tie"].alias("tie"))
    done = F.array(F.struct(ended["doc_id"].alias("doc_id"), ended["size"].alias("size"), extra.alias("extra")))
    return F.struct(open_.cast(_ITEM).alias("open"), F.concat(acc["done"], done).cast(_DONE).alias("done"))


def _fold(items: DataFrame, level: int, blocks: Column) -> DataFrame:
    """One remainder and the settled documents of each block of a source."""
    block = F.pmod(F.xxhash64("doc_id", "tie", F.lit(SEED + level)), blocks)
    zero = F.struct(F.element_at("items", 1).cast(_ITEM).alias("open"), F.array().cast(_DONE).alias("done"))
    return (
        items.withColumn("block", block)
        .groupBy("source", "n_docs", "block")
        # Large documents first, so that what stays open at the end is small.
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("order"), "doc_id", "tie", "size", "held"))).alias("items"))
        .withColumn("items", F.transform("items", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"),
                                                                     x["held"].alias("held"), x["tie"].alias("tie")).cast(_ITEM)))
        .select("source", "n_docs", F.aggregate(F.slice("items", F.lit(2), F.greatest(F.size("items") - 1, F.lit(0))), zero, _trade).alias("out"))
    )


def mix_sizes(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """``doc_id, size, source, source_size, target, copies`` for each row of (doc_id, source, size)."""
    sizes = stage(sizes.select("doc_id", "source", "size"))
    targets = stage(source_targets(sizes, weights, budget, cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    docs = (
        sizes.withColumnRenamed("source", "s").join(targets, F.col("s").eqNullSafe(F.col("source")))
        .withColumn("rate", rate).withColumn("base", F.floor("rate").cast("int"))
        .withColumn("held", (F.col("rate") - F.col("base")) * F.col("size"))
    )
    is_open = (F.col("size") > 0) & (F.col("rate") > F.col("base"))
    # Equal rows of one id are told apart by the order in which a partition holds them; any of them will do.
    items = docs.filter(is_open).select("doc_id", "source", "n_docs", "size", "held", F.xxhash64("size", "source").alias("tie"))
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    settled, level, open_count = [], 0, most
    while True:
        ends = open_count <= BLOCK
        blocks = F.greatest(F.ceil(F.col("n_docs") / F.lit(float(BLOCK) ** (level + 1))), F.lit(1)) if not ends else F.lit(1)
        folded = stage(_fold(items, level, blocks))
        settled.append(folded.select("source", F.explode("out.done").alias("d")).select("source", "d.*"))
        items = folded.select("out.open.doc_id", "source", "n_docs", "out.open.size", "out.open.held", "out.open.tie")
        if ends:
            break
        level, open_count = level + 1, -(-open_count // BLOCK)
    chance = _uniform(F.col("doc_id"), F.col("tie"), F.lit(SEED - 1)) * F.col("size") < F.col("held")
    settled.append(items.select("source", "doc_id", "size", chance.cast("int").alias("extra")))
    rounded = settled[0]
    for part in settled[1:]:
        rounded = rounded.unionByName(part)
    whole = docs.filter(~is_open).select("source", "doc_id", "size", F.lit(0).alias("extra"))
    return (
        rounded.unionByName(whole).withColumnRenamed("source", "s")
        .join(targets.withColumn("rate", rate), F.col("s").eqNullSafe(F.col("source")))
        .select("doc_id", "size", "source", "source_size", "target", (F.floor("rate").cast("int") + F.col("extra")).alias("copies"))
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """The mix of ``docs`` (doc_id, source, text): see ``mix_sizes``; sizes are words."""
    return mix_sizes(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), weights, budget, cap)


def repeat(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Rows of ``docs`` as often as ``mixed`` says; rows that share an id share out its copies."""
    per = mixed.groupBy("doc_id").agg(F.array_sort(F.collect_list("copies")).alias("_copies"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(*[c for c in docs.columns if c != "doc_id"]))
    times = F.coalesce(F.get("_copies", F.col("_nth") - 1), F.lit(0))
    return (
        docs.withColumn("_nth", nth).withColumnRenamed("doc_id", "_id")
        .join(per, F.col("_id").eqNullSafe(F.col("doc_id"))).drop("doc_id").withColumnRenamed("_id", "doc_id")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), times))).filter(F.col("_copy") < times)
        .select(*docs.columns)
    )
