"""Exact dedup with a two-pass Bloom filter, in DataFrame functions only.

Pass 1 reads the texts, sets ``k`` bits per row in a blocked Bloom filter (a
row's bits lie in one 4 KB block) and keeps the bits that at least two rows
set.  Pass 2 probes every row: a text that occurs twice has all its bits set
twice, so a row with any other bit is unique and passes straight through with
no shuffle.  Only the remaining rows (every true copy, and a few false alarms)
are shuffled and grouped exactly, by SHA-256.

Bounds: the filter has ``bits_per_row`` bits a row and at most ``max_bits``
(128 MB); it is the only thing broadcast.  Past that bound more unique rows
fail the probe and are shuffled; the result stays exact.  A group of copies of
any size is one row per map task in the aggregate; in the join back the group
is on the side that AQE splits.

Defined results: a null text counts as empty.  Of equal texts the row with the
largest id stays, exactly one row even when that row is repeated; null ids are
smallest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import kept_table

BLOCK = 32768  # bits per block, as bitmap_construct_agg builds them


def _bits(h: str, k: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(h), F.lit(100 + i)), F.lit(BLOCK)).cast("int") for i in range(k)]


def repeat_filter(hashes: DataFrame, h: str, blocks: int, k: int) -> DataFrame:
    """(block, bits): the filter bits that at least two rows set."""
    positions = hashes.select(F.pmod(F.xxhash64(F.col(h), F.lit(7)), F.lit(blocks)).alias("block"),
                              F.explode(F.array_distinct(F.array(*_bits(h, k)))).alias("bit"))
    twice = positions.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))


def _is_set(bits: str, bit: Column) -> Column:
    byte = F.substring(F.col(bits), F.shiftright(bit, 3) + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), bit.bitwiseAND(F.lit(7))) == 1


def mark(docs: DataFrame, carry: list[str] | None = None, doc_id: str = "doc_id", text: str = "text",
         bits_per_row: int = 16, max_bits: int = 1 << 30, k: int = 3) -> DataFrame:
    """One row per document: ``row`` (the carried columns), keep_id, group_size,
    kept and sha (the text's SHA-256, binary)."""
    carry = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs[doc_id].alias("id"),
                       F.coalesce(docs[text], F.lit("")).alias("body"))
    n = rows.count()
    blocks = max(1, math.ceil(min(n * bits_per_row, max_bits) / BLOCK))
    seen = kept_table(repeat_filter(rows.select(F.xxhash64("body").alias("h")), "h", blocks, k), "bloom")

    tested = rows.withColumn("h", F.xxhash64("body")) \
        .withColumn("block", F.pmod(F.xxhash64(F.col("h"), F.lit(7)), F.lit(blocks))) \
        .join(F.broadcast(seen), "block", "left")
    possible = F.lit(True)
    for b in _bits("h", k):
        possible = possible & _is_set("bits", b)
    tested = tested.withColumn("possible", F.coalesce(possible, F.lit(False))) \
        .withColumn("sha", F.unhex(F.sha2(F.col("body").cast("binary"), 256))).select("row", "id", "sha", "possible")

    alone = tested.filter(~F.col("possible")).select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    again = kept_table(tested.filter("possible").select("row", "id", "sha")
                       .withColumn("at", F.monotonically_increasing_id()), "repeats")
    # written, so that both sides of the join below are plain exchanges and AQE can split a large group
    groups = kept_table(again.groupBy("sha").agg(F.max(F.struct("id", "at")).alias("best"), F.count(F.lit(1)).alias("group_size")),
                        "groups")
    settled = again.join(groups, "sha").select(
        "row", F.col("best.id").alias("keep_id"), "group_size", (F.col("at") == F.col("best.at")).alias("kept"), "sha")
    return alone.unionByName(settled)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with their columns."""
    return mark(docs, **options).filter("kept").select("row.*")
