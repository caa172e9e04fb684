"""A corpus pipeline of four operators: quality, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's documents. All but the last return the columns of `documents`, whatever
further columns there are and however they are named; those are passed on unseen.

Odd rows: a NULL text counts as the empty one in every stage, and whole texts are read, whatever
their length. Rows that repeat are rows of their own, but where near duplicates go, all rows of a
doc_id go or stay together. Rows without a doc_id go through every stage and are near duplicates of nothing.
An empty table passes through every stage as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhaul.llm import minhash, packing, pieces, quality, secrets
from roundhaul.llm.common import Scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects; equal texts score alike. Without labels all score 0.5 and go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five words a shingle, 80 %; texts without words all stay."""
    return minhash.one_of_each(docs, Scratch(spark, "near-duplicates"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in a text with a mask; all documents stay, `n_chars` follows the text (NULL for a NULL text)."""
    text = secrets.redacted(spark, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"))
    cleaned = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(kind))
    return cleaned.select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document, with a digest of its ids; an empty text is one piece of one id."""
    rows = pieces.token_pieces(
        docs, public_tokenizers.path("word_bpe_49k.json"), "word", packing.CAPACITY, packing.END_ID
    )
    return packing.pack(rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), pieces.shard_count(docs))


STAGES = [
    ("quality_classifier", keep_quality),
    ("minhash_near_duplicates", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_documents),
]

#: SQL can express neither the classifier nor the tokenizers; tests hold `run` against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
