"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination and
SentencePiece ids, each over all that the stage before it kept.

Every stage judges each row on its own text, whatever its doc_id: rows that share
a doc_id, or have none, do not share a fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrysight.llm import decontaminate, minhash_dedup, sentencepiece_viterbi, toxicity
from quarrysight.llm.common import free_name, table, written
from quarrysight.llm.queries import PIECES, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the score, learned from all labels, does not reject.

    A null or empty text has the score of no evidence; rows with equal or null doc_id,
    and repeated rows, are each scored on their own text; without usable labels nothing is
    rejected; an empty table gives no rows; other columns pass as they are, whatever their
    names."""
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): that with
    the smallest doc_id, null last; of equal doc_ids the one whose text, then whole row, has
    the smallest hash.

    Every row stands for itself, by a number that it is given as the rows are stored. Null
    and empty texts, and texts without words, are copies of nothing and all stay; repeated
    rows with words are copies; an empty table gives no rows; other columns pass as they
    are, whatever their names."""
    row = free_name(docs, "_row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    near = written(
        minhash_dedup.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text")).where("n_shingles > 0")
        .select(F.col("doc_id").alias("row"), "component_id"), "groups")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("doc_id"),
                    F.xxhash64("text").alias("text"), F.xxhash64(*docs.columns).alias("whole"), F.col(row).alias("row"))
    first = (
        near.join(numbered.select(F.col(row).alias("_of"), rank.alias("rank")), F.col("row") == F.col("_of"))
        .groupBy("component_id").agg(F.min("rank")["row"].alias("_kept")))
    # by row, not by group: a large group is not one key
    gone = free_name(docs, "_copy")
    copies = written(near.join(first.select("_kept"), F.col("row") == F.col("_kept"), "left_anti")
                     .select(F.col("row").alias(gone)), "copies")
    return numbered.join(copies, F.col(row) == F.col(gone), "left_anti").drop(row)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which the fingerprints of item-sized windows, and then exact counts, find no
    passage of the benchmark, as in op7.

    Null and empty texts hold none; a row goes by its own text, so rows with equal or null
    doc_id share no fate and repeated rows go or stay together; an empty table, or an empty
    benchmark, changes nothing; other columns pass as they are, whatever their names."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, and whether these decode to the text.

    A null or empty text has no ids; of paths of equal score the one with the longest last
    piece is taken; every row is encoded, repeated ones too; an empty table gives no rows;
    other columns pass, but for those named like a new one, which are replaced."""
    return sentencepiece_viterbi.encode_documents(docs, vocabulary(PIECES))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode_pieces),
]

# learned scores, MinHash links and Viterbi paths have no SQL form; tests/llm
# hold the pipeline against the operators and brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
