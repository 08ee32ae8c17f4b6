"""The training-data operators bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, cross_alignment, decontaminate, jaccard_join, minhash_dedup, quartile_digest, rendezvous,
               sentencepiece_viterbi, token_files, toxicity, url_reputation, warc_store, whitening)
from .common import scratch, table, written

SHARDS = 24
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# fixed values: (verdict, host, path)
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc_store.write_archive(table(spark, sf_dir, "pages"), path)
    return warc_store.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.shard_documents(table(spark, sf_dir, "documents"),
                                      [1.0] * SHARDS, [1.0] * (SHARDS + 1))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled page outcomes: the label row whose doc_id is the page_id; bad
    if it is toxic or of low quality."""
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge_urls(table(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir), URL_RULES)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary(BYTE_BPE))
    return token_files.read_documents(spark, path)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    turns = turns.select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts"))
    out = written(chat_format.format_conversations(turns), "chat")
    got = out.select("conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns"),
                     chat_format.read_loss(F.col("formatted"), F.col("loss")).alias("trained"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n")))
    return got.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.encode("trained", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_viterbi.encode_documents(docs, vocabulary(PIECES)).select(
        "doc_id", "n_tokens", "ids_crc32", "round_trip", "ids")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.fingerprint_documents(table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")
    return toxicity.score_documents(table(spark, sf_dir, "documents"), labels).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_components(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_alignment.cross_align(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_warc": op2_warc,
    "op3_sharding": op3_sharding,
    "op4_urls": op4_urls,
    "op5_tokens": op5_tokens,
    "op6_chat": op6_chat,
    "op7_decontamination": op7_decontamination,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_fingerprints": op9_fingerprints,
    "op10_toxicity": op10_toxicity,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}
