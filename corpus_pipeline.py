"""A training corpus from raw documents: rules, classifier, near-duplicates, repeated passages, packing.

Every stage works on all that the one before kept. Its rows are written as Parquet and read again, so a lost
executor costs no more than a part of the stage at work.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_cnn, host_rules, packing, passages, simhash
from tidemark.llm.staging import stage

END = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose source is not rejected.

    Texts are judged twice, for the sources' rates and for the rows to keep: that is cheaper than a second copy of them.
    """
    judged = docs.select(F.struct("*").alias("row"), F.col("source").alias("source"), host_rules.text_counts("text").alias("c"))
    judged = judged.select("row", "source", host_rules.base_failed("c").alias("failed"))
    return host_rules.passing(judged, "source", "failed").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, takes for good."""
    model = byte_cnn.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct("*").alias("row"), byte_cnn.scored_by(model, "text").alias("score"))
    return rows.where(F.col("score") >= byte_cnn.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints of three-word shingles within two bits."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that occur earlier."""
    return passages.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, packed into sequences of at most 4096."""
    return packing.with_checksums(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: A trained classifier and a tokenizer are beyond SQL; a test holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
