"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhaul.llm import (
    chat,
    embedding_dedup,
    hard_negatives,
    html_text,
    merkle,
    minhash,
    mixing,
    packing,
    pieces,
    quality,
    secrets,
    sentencepieces,
    token_output,
    whitening,
)
from roundhaul.llm.common import Scratch
from roundhaul.llm.oracles import ORACLES  # noqa: F401 - the entry module reads it here
from roundhaul.session import local_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentencepiece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = sentencepieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    rows = pieces.token_pieces(docs, vocabulary, "word", packing.CAPACITY, packing.END_ID)
    digests = rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests, pieces.shard_count(docs))


def packed_id_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_output.packed_matrices(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "token")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secrets.scan(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.fingerprints(_table(spark, sf_dir, "documents"))
    return rows.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


def chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = local_table(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = chat.examples(given.unionByName(added))
    longest = F.max_by("text", "n_turns")
    replies = F.array_sort(
        F.collect_list(
            F.when(
                F.col("target").isNotNull(),
                F.struct("target", chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("text")),
            )
        )
    )
    read = rows.groupBy("conv_id").agg(
        chat.turns_of(longest).alias("turns"),
        F.array_join(F.transform(replies, lambda r: r["text"]), "").alias("loss"),
        F.sum(F.char_length("text").cast("long")).alias("formatted_chars"),
    )
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), Scratch(spark, "vectors"))


def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark, "documents"), words=4)


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        (F.coalesce(quality.crc_remainder("doc_id"), F.lit(0)) == 2).alias("held_out"),
        quality.score(spark, "text", model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "mix")
    sized = mixing.sizes(_table(spark, sf_dir, "documents"), scratch)
    rows = mixing.copies(sized, mixing.rates(sized, scratch))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    found = hard_negatives.hard_negatives(vectors, Scratch(spark, "negatives"), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings"), Scratch(spark, "whitening"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicate_vectors": near_duplicate_vectors,
    "op2_sentencepiece": sentencepiece_ids,
    "op3_minhash_near_duplicates": near_duplicate_documents,
    "op4_sum_of_squares_packing": packed_sequences,
    "op5_packed_id_matrices": packed_id_matrices,
    "op6_secret_spans": secret_spans,
    "op7_quality_votes": quality_scores,
    "op8_main_text": main_text,
    "op9_merkle_fingerprints": merkle_fingerprints,
    "op10_chat_examples": chat_examples,
    "op11_mixed_sources": mixed_sources,
    "op12_hard_negatives": mined_negatives,
    "op13_whitened_vectors": whitened_vectors,
}
