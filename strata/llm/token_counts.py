"""Token counts for every context limit from one exact length histogram.

Documents are encoded once and reduced, map-side, to (encoded length, number of
documents).  Suffix sums over the histogram then answer, for any limit L: how
many documents are at least that long, how many tokens remain when every
document is truncated to L, how many are lost, and (from the prefix side) any
quantile of the lengths.  The histogram has one row per distinct length, so it
is bounded by the longest document, not by the corpus.

Its suffix sums run in two levels (within a block of lengths, then over block
totals), so no task gets the whole histogram.

Defined results: a null or empty text has length 0.  An empty table gives an
empty histogram.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe import SPLIT_CHARS, codec, encode_text
from strata.llm.common import column, kept_table, map_chunks, pick

LENGTHS_PER_BLOCK = 4096


def lengths(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every whole text."""
    src = pick(docs, doc_id=doc_id, text=F.coalesce(docs[text], F.lit("")))
    kind = src.schema["doc_id"].dataType.simpleString()

    def count(rows: pa.RecordBatch, _) -> dict:
        c = codec(path)
        return {"doc_id": column(rows, "doc_id"),
                "n_tokens": [len(encode_text(c, t, SPLIT_CHARS)) for t in column(rows, "text").to_pylist()]}

    return map_chunks(src, count, f"doc_id {kind}, n_tokens long")


def histogram(sizes: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row per distinct length; written once, so that
    every later question reads it and not the texts."""
    return kept_table(sizes.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")


def limits(hist: DataFrame) -> DataFrame:
    """The histogram with its suffix sums: every length taken as context limit.

    docs_at_least / docs_longer: documents of at least / more than this length;
    truncated_tokens: tokens left when all documents are cut to it; lost_tokens:
    the rest; docs_upto: documents of at most this length (for quantiles);
    total_docs, total_tokens: of the whole corpus.
    """
    h = hist.select("n_tokens", "n_docs", F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK).cast("long").alias("block"),
                    (F.col("n_tokens") * F.col("n_docs")).alias("mass"))
    totals = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("mass").alias("bm"))
    over = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    above = totals.select("block", F.coalesce(F.sum("bd").over(over), F.lit(0)).alias("ad"),
                          F.coalesce(F.sum("bm").over(over), F.lit(0)).alias("am"),
                          F.sum("bd").over(every).alias("total_docs"), F.sum("bm").over(every).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    s = h.withColumn("sd", F.sum("n_docs").over(inside)).withColumn("sm", F.sum("mass").over(inside)).join(above, "block")
    at_least, mass = F.col("sd") + F.col("ad"), F.col("sm") + F.col("am")
    left = F.col("total_tokens") - mass + at_least * F.col("n_tokens")
    return s.select("n_tokens", "n_docs", at_least.alias("docs_at_least"), (at_least - F.col("n_docs")).alias("docs_longer"),
                    (F.col("total_docs") - at_least + F.col("n_docs")).alias("docs_upto"), left.alias("truncated_tokens"),
                    (F.col("total_tokens") - left).alias("lost_tokens"), "total_docs", "total_tokens")


def quantile(table: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share q of the documents do not exceed."""
    return table.filter(F.col("docs_upto") >= F.lit(q) * F.col("total_docs")).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(table: DataFrame, limit: int) -> DataFrame:
    """Tokens left at any limit, from the next smaller length in the table."""
    below = F.max(F.when(F.col("n_tokens") <= limit, F.struct("n_tokens", "truncated_tokens", "docs_longer")))
    return table.agg(below.alias("b"), F.max("total_docs").alias("n")).select(F.coalesce(
        F.col("b.truncated_tokens") + F.col("b.docs_longer") * (F.lit(limit) - F.col("b.n_tokens")),
        F.col("n") * limit, F.lit(0)).alias("truncated_tokens"))
