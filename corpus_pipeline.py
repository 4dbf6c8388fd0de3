"""The training-corpus pipeline: each stage applies one operator of strata.llm.

Quality rules, exact dedup, near dedup, source mixing, encoding.  Every stage
takes all that the one before kept and returns the columns of ``documents``; the
last returns the ids and whether they decode to the text.  The mixture draws pseudorandom blocks and the last stage
needs a tokenizer, so no SQL gives the rows; tests hold each stage against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, exact_dedup, mixing, ngram_join, quality_rules
from strata.llm.common import documents, kept_table
from strata.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the current quality policy keeps."""
    return quality_rules.keep_clean(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return ngram_join.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mixture takes, as documents; a document that is taken again
    in a later epoch is a further row."""
    return mixing.Mixture(docs, texts=True).texts()


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every text, the digest of the
    text decoded from the ids, and whether it is that of the text itself."""
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    coded = bpe.encode(docs, tokenizer_path(), carry=["doc_id", "lang", "source", "text_sha256"], decoded=True)
    return coded.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("decoded_sha256", F.sha2("decoded", 256)) \
        .withColumn("round_trip", F.col("decoded_sha256") == F.col("text_sha256")).drop("decoded", "text_sha256")


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and
    read again."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = kept_table(docs, "stage-" + name.lower().replace(" ", "-"))
    return docs


ORACLE_SQL = None
