"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.llm import ann, hard_negatives, html_wrappers, lang_id, licenses, mixing, near_dup, pieces_fst, quality, resampling, secrets, suffix_dedup, token_files, twins
from quaymart.llm.common import read
from quaymart.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_TWINS: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """A public vocabulary file, as the installed package names it."""
    import public_tokenizers

    return public_tokenizers.path(name)


PIECE_MODEL = "piece_bpe_32k.model"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_settings(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_fst.round_trip(read(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL))


@query
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrappers.main_texts(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"))


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return token_files.read_back(spark, token_files.write(read(spark, sf_dir, "documents"), tokenizer))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, read(spark, sf_dir, "labels")))


@query
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


@query
def op8_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.classes(read(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    counts = [secrets.count_kind("findings", k).alias(f"n_{k}") for k in secrets.BASE_KINDS]
    base = F.sha2(secrets.joined("findings", secrets.BASE_KINDS).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secrets.joined("findings").alias("spans"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = lang_id.held_out()
    found = lang_id.predict(docs.select("doc_id", "text"), lang_id.train(docs, ~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), moved)


SQL_TWINS["op12_hard_negatives"] = twins.NEGATIVES_SQL


@query
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


SQL_TWINS["op13_importance_resample"] = twins.RESAMPLE_SQL
