"""From raw documents to token ids: five stages, each one operator of ``quaymart.llm``.

Every stage gets all rows that its predecessor kept; between stages the rows
are a Parquet table. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaymart.llm import lang_id, mixing, near_dup, pieces_fst, secrets
from quaymart.llm.common import read
from quaymart.llm.queries import PIECE_MODEL, tokenizer_file
from quaymart.session import apply_settings, stage


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, which becomes their ``lang``; the others go."""
    apply_settings(spark)
    return lang_id.recognised(docs, lang_id.train(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    apply_settings(spark)
    return near_dup.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their text masked."""
    apply_settings(spark)
    return secrets.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    apply_settings(spark)
    return mixing.repeat(docs, mixing.mix(docs))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    apply_settings(spark)
    return pieces_fst.encode(docs, tokenizer_file(PIECE_MODEL)).select("doc_id", "lang", "source", "ids")


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
    ("sentencepiece", encode_stage),
]

# Models, hashes and random rounding have no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(apply_settings(spark), sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
