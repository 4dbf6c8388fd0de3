"""The registered query of each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (align, bpe, exact_dedup, fim, kneser_ney, lang_id, mixing, ngram_join, quality_model, quality_rules,
                        string_kernel, substring_dedup, token_counts)
from strata.llm.common import crc_remainder, documents
from strata.llm.oracles import ORACLE

__all__ = ["ORACLE", "QUERIES", "tokenizer_path"]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = crc_remainder("doc_id", 3) == 1
    model = lang_id.fit(docs, ~held)
    return lang_id.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = substring_dedup.remove(documents(spark, sf_dir), carry=["doc_id"])
    return r.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = mixing.Mixture(documents(spark, sf_dir)).taken()
    return t.select("doc_id", "size", "source_size", "target", "taken")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = exact_dedup.mark(documents(spark, sf_dir), carry=["doc_id"])
    return m.select("row.doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = quality_rules.verdicts(quality_rules.stored_ledger(documents(spark, sf_dir)))
    return v.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept", "failed_bits")


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.ablations(quality_rules.stored_ledger(documents(spark, sf_dir)))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = bpe.encode(documents(spark, sf_dir), tokenizer_path(), decoded=True)
    return e.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = crc_remainder("doc_id", 5) == 0
    model = quality_model.fit(docs, documents(spark, sf_dir, "labels"), ~held)
    return quality_model.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = token_counts.lengths(documents(spark, sf_dir), tokenizer_path())
    return token_counts.limits(token_counts.histogram(sizes))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = crc_remainder("doc_id", 7) == 2
    model = kneser_ney.fit(docs, ~held)
    return kneser_ney.score(docs, model).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = crc_remainder("doc_id", 5) == 0
    model = string_kernel.fit(docs, documents(spark, sf_dir, "labels"), ~held)
    return string_kernel.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(documents(spark, sf_dir), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), hashed=True) \
        .withColumnRenamed("groups", "groups_sha256")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fim.transform(documents(spark, sf_dir))
    return t.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_bpe": op7_bpe,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_token_counts": op9_token_counts,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_toxicity": op11_toxicity,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_fill_in_middle": op13_fill_in_middle,
    "quality_rule_ablations": quality_rule_ablations,
}
