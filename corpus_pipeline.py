"""From documents to encoded training text, in four stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns a table that is written
to the shared folder and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ligature.llm import bpe, common, mixing, neardup, quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier, taught by the labels of ``sf_dir``, accepts; columns that are
    named like its own stay as they are."""
    model = quality.learn(docs, common.table(spark, sf_dir, "labels"))
    own = {c: f"__own_{c}" for c in ("score", "predicted") if c in docs.columns}
    kept = quality.score(docs.withColumnsRenamed(own), model).where("predicted = 1")
    return kept.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8): that with the smallest
    id. Documents without an id stay."""
    found = neardup.near_duplicates(docs)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__kept")).distinct()
    named = docs.where("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col("__kept"), "left_semi")
    return named.unionByName(docs.where("doc_id IS NULL"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix draws them, dealt out by shard and shuffled within each."""
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document of the mix, and digests of them and of the text that they decode to."""
    return bpe.encode_checked(docs, bpe.default_vocabulary(), keep=("doc_id", "source"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("source_mix", source_mix),
    ("bpe_encoding", bpe_encoding),
]

#: No SQL expresses the classifier or the encoding; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = common.stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
