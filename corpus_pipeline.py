"""The corpus pipeline: five stages over ``documents``, each works on all that the one before kept.

1. Quality rules: documents that fail the base rules or a certified cutoff go.
2. N-gram Jaccard join: of each near-duplicate class the document with the smallest id stays.
3. Substring dedup: word windows that occur earlier are cut out of the texts.
4. Benchmark decontamination: documents that hold benchmark text go.
5. SentencePiece encoding: ids and byte spans of every text, decoded again.

Each stage is a function of (spark, docs, sf_dir). ``run`` writes every stage's
result to the shared folder and reads it back, so a lost executor never costs
more than a stage. Stages 1 to 4 keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.llm import decontam, jaccard_join, quality_rules, spiece, substring_dedup
from cellar.llm.common import fresh, materialize, table

TOKENIZER = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a null id are kept: they stand for no class."""
    mine = fresh(docs, "class_doc")
    classes = jaccard_join.near_duplicates(docs)
    gone = classes.where("class_id <> doc_id").select(F.col("doc_id").alias(mine)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[mine], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.remove(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, first and end (byte spans), and whether decoding gives the text back."""
    import public_tokenizers

    model = public_tokenizers.path(TOKENIZER)
    plain = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    coded = spiece.encode(plain, model, decoded="decoded")
    return coded.select("doc_id", "lang", "source", F.size("tokens.ids").cast("bigint").alias("n_tokens"), "tokens.ids", "tokens.first", "tokens.end", (F.col("decoded") == F.col("text")).alias("decodes"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages), ("benchmark decontamination", benchmark_leaks), ("SentencePiece encoding", encode)]
ORACLE_SQL = None  # risk bounds, seeds with substitutions and byte-pair merges are not SQL; tests check every stage by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return docs
