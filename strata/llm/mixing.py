"""Mixing sources to target weights by blocks, shards and index permutations.

* Each source's words form one stream (documents in the order of a hash of their id), packed into
  blocks of ``block`` words; a block is an index, 0 to n - 1.
* The mixture is a number of output shards of ``slots`` slots.  A seeded
  multinomial draw per shard says how many slots each source gets there.  The
  draws are then settled against each source's exact total: slots past a
  source's total are passed on, in order, to sources that are short.
* A source's slots are numbered through all shards; slot j reads index
  ``perm(j mod n)`` of epoch ``j div n``, where ``perm`` is a keyed Feistel
  permutation of 0 .. n - 1.  So an epoch takes every block once, and no block is
  taken more than ``ceil(slots / n)`` times.
* Slots meet blocks by an equi-join on (source, index).

Targets share all words by weight (5, 2, 1, repeating over the sources in code
point order, null last).  A target stops at ``max_epochs`` times its source; the
excess is shared again by weight among the others.

Scale: positions in a source's stream come from a two-level prefix sum (buckets
of the id hash, then inside a bucket), so a hot source is many small windows.
What reaches the driver is one row per source.

Defined results: null text has size 0 and is never taken; null is a source like
any other; repeated rows are separate documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strata.llm.common import kept_table, python_ready
from strata.llm.textbytes import mix

BLANKS = r"[\x20\x09-\x0D]+"
BLOCK = 64
SLOTS = 8192
SLOTS_PER_TASK = 1 << 19
BUCKET_ROWS = 20_000
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
ROUNDS = 4
SEED = 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def n_words(text: Column) -> Column:
    """Words of a text: the runs of bytes outside the six blanks."""
    return F.coalesce(F.size(F.filter(F.split(text, BLANKS), lambda x: x != "")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[int], total: int, most: int = MAX_EPOCHS) -> list[float]:
    """Share ``total`` by weight with a ceiling of ``most`` times each size.

    Sources are settled in the order in which a growing level reaches their
    ceiling, which is where repeated resharing ends.
    """
    out = [0.0] * len(sizes)
    left, weight = float(total), float(sum(weights))
    for i in sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i]):
        share = left * weights[i] / weight if weight else 0.0
        out[i] = min(share, float(most * sizes[i]))
        left -= out[i]
        weight -= weights[i]
    return out


def source_table(docs: DataFrame, block: int = BLOCK) -> pd.DataFrame:
    """One row per source, in order: size, blocks, target, slots in the mixture."""
    got = docs.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(((r["source"], r["size"] or 0) for r in got), key=lambda r: (r[0] is None, (r[0] or "").encode()))
    sizes = [r[1] for r in rows]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    t = targets(sizes, weights, sum(sizes))
    blocks = [-(-s // block) for s in sizes]
    return pd.DataFrame({"source": pd.array([r[0] for r in rows], "object"), "src": range(len(rows)), "source_size": sizes, "blocks": blocks,
                         "target": t, "slots": [round(b * x / s) if s else 0 for b, x, s in zip(blocks, t, sizes)]})


def shard_counts(spark: SparkSession, table: pd.DataFrame, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, src, n): the multinomial draw of every output shard."""
    total = int(table["slots"].sum())
    n_shards = -(-total // slots)
    share = (table["slots"] / total).tolist() if total else []

    def draw(frames):
        for f in frames:
            for shard in f["id"]:
                size = min(slots, total - shard * slots)
                got = np.random.Generator(np.random.PCG64([seed, int(shard)])).multinomial(size, share)
                src = np.flatnonzero(got)
                yield pd.DataFrame({"shard": shard, "src": src.astype("int32"), "n": got[src]})

    return spark.range(n_shards).mapInPandas(draw, "shard long, src int, n long")


def settled(spark: SparkSession, draws: DataFrame, table: pd.DataFrame) -> DataFrame:
    """(shard, src, start, n): runs of slots numbered per source, totals met exactly.

    A source's draws are numbered through the shards.  Numbers past its total
    are surplus; surplus and missing slots are both numbered in (source, shard)
    order and equal numbers are matched by cutting both lines at each other's
    ends.
    """
    w = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    own = spark.createDataFrame([(int(s), int(n)) for s, n in zip(table["src"], table["slots"])], "src int, want long")
    runs = draws.withColumn("stop", F.sum("n").over(w)).join(F.broadcast(own), "src") \
        .withColumn("start", F.col("stop") - F.col("n"))
    kept = runs.filter("start < want").select("shard", "src", "start", F.least("n", F.col("want") - F.col("start")).alias("n"))
    # per source: what the draws gave too much or too little (one row per source)
    drawn = draws.groupBy("src").agg(F.sum("n").alias("got")).collect()
    got = {r["src"]: r["got"] for r in drawn}
    short = [(int(s), int(got.get(s, 0)), int(n) - int(got.get(s, 0)))
             for s, n in zip(table["src"], table["slots"]) if n > got.get(s, 0)]
    over = [(int(s), int(got[s] - n)) for s, n in zip(table["src"], table["slots"]) if got.get(s, 0) > n]
    extra = []
    lines = iter(short)
    cur = next(lines, None)
    for s, n in over:  # match surplus intervals [at, at + n) of source s with missing slots
        lo = 0
        while n and cur:
            take = min(n, cur[2])
            extra.append((s, lo, cur[0], cur[1], take))
            cur = (cur[0], cur[1] + take, cur[2] - take)
            lo, n = lo + take, n - take
            if not cur[2]:
                cur = next(lines, None)
    if not extra:
        return kept
    moves = spark.createDataFrame(extra, "src int, off long, to_src int, to_start long, take long")
    spill = runs.filter("stop > want").select("shard", "src", (F.greatest("start", "want") - F.col("want")).alias("lo"),
                                             (F.col("stop") - F.col("want")).alias("hi"))
    moved = spill.join(F.broadcast(moves), "src") \
        .withColumn("a", F.greatest("lo", "off")).withColumn("b", F.least("hi", F.col("off") + F.col("take"))).filter("a < b") \
        .select("shard", F.col("to_src").alias("src"), (F.col("to_start") + F.col("a") - F.col("off")).alias("start"),
                (F.col("b") - F.col("a")).alias("n"))
    return kept.unionByName(moved)


def feistel(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed pseudorandom permutation of 0 .. n - 1, element by element.

    An alternating Feistel network permutes the smallest a * b >= n with
    a = ceil(sqrt n); an image of n or more is permuted again until it lands
    below n, which it does because a cycle of a permutation returns.
    """
    n = n.astype(np.uint64)
    a = np.ceil(np.sqrt(n.astype(np.float64))).astype(np.uint64)
    b = (n + a - np.uint64(1)) // a

    def step(x, a, b, key):
        lo, hi = x % a, x // a
        for r in range(ROUNDS):
            if r % 2 == 0:
                lo = (lo + mix(hi * _ODD + key + np.uint64(r)) % a) % a
            else:
                hi = (hi + mix(lo * _ODD + key + np.uint64(r)) % b) % b
        return hi * a + lo

    out = step(index.astype(np.uint64), a, b, key)
    todo = np.flatnonzero(out >= n)
    while len(todo):
        out[todo] = step(out[todo], a[todo], b[todo], key[todo])
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


@F.pandas_udf(LongType())
def permuted(index: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(feistel(index.to_numpy(), n.to_numpy(), key.to_numpy().astype(np.int64).view(np.uint64)))


def slot_table(runs: DataFrame, table: pd.DataFrame, seed: int = SEED) -> DataFrame:
    """(shard, src, slot, epoch, index): every slot of the mixture and its block."""
    spark = runs.sparkSession
    size = spark.createDataFrame([(int(s), int(b)) for s, b in zip(table["src"], table["blocks"])], "src int, blocks long")
    # a run is a few numbers but may be thousands of slots: spread the runs by what they become
    tasks = max(1, -(-int(table["slots"].sum()) // SLOTS_PER_TASK))
    slots = runs.repartition(tasks, "src", "shard").join(F.broadcast(size), "src").select(
        "shard", "src", "blocks", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("slot")) \
        .withColumn("epoch", F.floor(F.col("slot") / F.col("blocks")).cast("int")) \
        .withColumn("at", F.pmod(F.col("slot"), F.col("blocks")))
    return slots.withColumn("index", permuted("at", "blocks", F.xxhash64("src", "epoch", F.lit(seed)))).drop("at", "blocks")


def pieces(docs: DataFrame, table: pd.DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc key, src, index, first, n): the part of each document in each block.

    ``first`` is the word of the document with which the part begins.
    """
    spark = docs.sparkSession
    src = spark.createDataFrame([(s, int(i)) for s, i in zip(table["source"], table["src"])], "source string, src int")
    rows = docs.join(F.broadcast(src), docs["source"].eqNullSafe(src["source"])).select(docs["*"], "src")
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.floor(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) * F.lit(buckets) / F.lit(1 << 40)).cast("int"))
    totals = rows.groupBy("src", "bucket").agg(F.sum("size").alias("mass"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("src", "bucket", F.coalesce(F.sum("mass").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "bucket").orderBy("doc_id", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.filter("size > 0").withColumn("off", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(base, ["src", "bucket"]) \
        .withColumn("lo", F.col("base") + F.col("off")).withColumn("hi", F.col("base") + F.col("off") + F.col("size"))
    first, last = F.floor(F.col("lo") / block).cast("long"), F.floor((F.col("hi") - 1) / block).cast("long")
    cut = placed.select("row_id", "doc_id", "src", "lo", "hi", F.explode(F.sequence(first, last)).alias("index"))
    return cut.select("row_id", "doc_id", "src", "index", (F.greatest("lo", F.col("index") * block) - F.col("lo")).alias("first"),
                      (F.least("hi", (F.col("index") + 1) * block) - F.greatest("lo", F.col("index") * block)).alias("n"))


def numbered(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with row_id, written once so that the ids hold."""
    return kept_table(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"),
                                  F.monotonically_increasing_id().alias("row_id")), "mix-documents")


class Mixture:
    """The mixture of a corpus: its sources, slots and document parts."""

    def __init__(self, docs: DataFrame, block: int = BLOCK, slots: int = SLOTS, seed: int = SEED, doc_id: str = "doc_id",
                 text: str = "text", source: str = "source", texts: bool = False):
        spark = docs.sparkSession
        python_ready(spark)
        self.docs = numbered(docs, text) if texts else None
        src = self.docs.select("row_id", F.col(f"row.{doc_id}").alias("doc_id"), F.col(f"row.{source}").alias("source"), "text") if texts \
            else docs.select(F.monotonically_increasing_id().alias("row_id"), docs[doc_id].alias("doc_id"), docs[source].alias("source"),
                             docs[text].alias("text"))
        self.rows = kept_table(src.select("row_id", "doc_id", F.col("source").cast("string").alias("source"),
                                          n_words(F.col("text")).alias("size")), "mix-sizes")
        self.table = source_table(self.rows, block)
        draws = kept_table(shard_counts(spark, self.table, slots, seed), "mix-draws")
        self.slots = slot_table(settled(spark, draws, self.table), self.table, seed)
        self.pieces = pieces(self.rows, self.table, block)

    def blocks(self) -> DataFrame:
        """The mixture itself: (shard, src, slot, epoch, index, row_id, doc_id,
        first, n), one row per part of a taken block; words first .. first + n - 1
        of the document."""
        return self.slots.join(self.pieces, ["src", "index"])

    def taken(self) -> DataFrame:
        """One row per document: doc_id, size, source_size, target, taken."""
        spark = self.rows.sparkSession
        times = self.slots.groupBy("src", "index").agg(F.count(F.lit(1)).alias("times"))
        used = self.pieces.join(times, ["src", "index"]).groupBy("row_id").agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
        src = spark.createDataFrame([(s, int(a), float(t)) for s, a, t in zip(self.table["source"], self.table["source_size"], self.table["target"])],
                                    "name string, source_size long, target double")
        rows = self.rows.join(used, "row_id", "left")
        return rows.join(F.broadcast(src), rows["source"].eqNullSafe(src["name"])).select(
            "row_id", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def texts(self, text: str = "text", length: str = "n_chars") -> DataFrame:
        """The mixture as documents (needs ``texts=True``): per document and
        epoch one row whose text is the words taken, in order.  A document taken
        whole keeps its text as it is."""
        per = self.blocks().groupBy("row_id", "epoch").agg(
            F.sort_array(F.collect_list(F.struct("first", "n"))).alias("parts"), F.sum("n").alias("got"))
        cut = per.join(self.rows.select("row_id", "size"), "row_id").select(
            "row_id", F.when(F.col("got") < F.col("size"), F.col("parts")).alias("parts"))
        j = self.docs.join(cut, "row_id")
        ws = F.filter(F.split("text", BLANKS), lambda x: x != "")
        # the words are the element of a one-element array, so the lambda over the parts has them as
        # a variable; named directly they would be split from the text again for every part
        some = F.transform(F.array(ws), lambda w: F.array_join(F.flatten(F.transform(
            "parts", lambda p: F.slice(w, p["first"].cast("int") + 1, p["n"].cast("int")))), " "))[0]
        j = j.withColumn("mixed", F.when(F.col("parts").isNull(), F.col("text")).otherwise(some))
        names = self.docs.schema["row"].dataType.names
        return j.select(*[F.col("mixed").alias(c) if c == text else F.length("mixed").cast("long").alias(c) if c == length
                          else F.col(f"row.{c}").alias(c) for c in names])
