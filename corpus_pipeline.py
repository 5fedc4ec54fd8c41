"""A training corpus in five stages: toxicity, lines, near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next one's docs.  All but the last return the columns of documents, unchanged but for the text and n_chars: what an
operator adds is dropped again, and columns of docs that bear the name of such an addition, or any other, keep their values.
Empty tables give empty tables; rows that repeat are documents like others.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfilm.llm.line_dedup import dedup_lines
from skyfilm.llm.mixing import mix_sources
from skyfilm.llm.ngram_join import keep_one_of_each
from skyfilm.llm.packing import pack_documents
from skyfilm.llm.scratch import Scratch, numbered, small_batches
from skyfilm.llm.toxicity import fit_lexicon, score_toxicity

COLUMNS = ("doc_id", "text", "source")


def _aside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage over docs with all columns but doc_id, text and source set aside under one name, and put back behind it."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in COLUMNS]
    out = stage(docs.select(*COLUMNS, F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")) if others else docs.select(*COLUMNS))
    return out.select(*[F.col("others")[c].alias(c) if c in others else F.col(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; null and empty texts score as clean."""
    small_batches(spark)
    lexicon = fit_lexicon(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _aside(docs, lambda d: score_toxicity(d, lexicon).where("predicted = 0"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are on too many distinct documents of their source; n_chars, where docs has it, follows the text.

    A null text stays null and keeps its n_chars; a null source is a source of its own.
    """
    out = _aside(docs, lambda d: dedup_lines(d, copies_once=True))
    if "n_chars" not in docs.columns:
        return out
    n_chars = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return out.withColumn("n_chars", n_chars)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that with the smallest doc_id, and all documents without words."""
    return _aside(docs, lambda d: keep_one_of_each(spark, d))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, the order in which the files hold them; the next stage packs in this order."""
    others = [c for c in docs.columns if c not in COLUMNS]
    own = docs.select(*COLUMNS, F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")) if others else docs.select(*COLUMNS)
    mixed = mix_sources(own).repartitionByRange("mix_position").sortWithinPartitions("mix_position")
    return mixed.select(*[F.col("others")[c].alias(c) if c in others else F.col(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, with their ids and the document's place in the mixture.

    Sequences follow the files' order, the mixture.  Null and empty texts are one piece, the end id.
    """
    small_batches(spark)
    return pack_documents(numbered(docs.select("doc_id", "text"), "position"), public_tokenizers.path("word_bpe_49k.json"), position="position")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can express neither the learnt lexicon nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    scratch = Scratch(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
