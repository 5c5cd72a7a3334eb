"""From raw documents to packed sequences.

Each stage takes all rows that its predecessor kept and returns the columns of documents, but for the last, which
returns the pieces of the packed sequences. Empty tables pass through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import exact_dedup, language, mixing, near_dup, packing
from tideline.llm.common import documents, stage
from tideline.llm.encode import tokenizer_path

NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the language of the others is the predicted one."""
    model = language.train(docs.where(~language.held_out()))
    new = f"p{uuid.uuid4().hex[:12]}_"
    kept = language.identify(docs, model, new).where(~F.col(f"{new}rejected"))
    return kept.select(*[F.col(f"{new}lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.representatives(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1).placed
    return packed.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
