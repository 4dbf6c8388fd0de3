"""Helpers shared by the operators: reading, Arrow mapping, scratch tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from strata.llm.textbytes import CHUNK_BYTES, Chunk, chunks
from strata.session import shared_dir

#: Rows per Arrow batch.  A batch holds whole texts, so the default of 10,000
#: rows could reach gigabytes when texts are long.
BATCH_ROWS = 512
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table of the given folder."""
    python_ready(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Settings of the Python workers: small Arrow batches, and the folder of this
    package on their path (workers on this machine, or where it is mounted alike;
    a cluster may ship the package with --py-files as well)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def pick(docs: DataFrame, **cols) -> DataFrame:
    """Only the named inputs, under the operator's own names (``text='text'``)."""
    return docs.select(*[docs[c].alias(n) if isinstance(c, str) else c.alias(n) for n, c in cols.items()])


def map_chunks(df: DataFrame, fn: Callable[[pa.RecordBatch, Chunk], dict], schema: str,
               lower: bool = False, limit: int = CHUNK_BYTES) -> DataFrame:
    """mapInArrow over byte-bounded pieces of the column ``text``.

    ``fn(rows, chunk)`` gets the rows of one piece and returns the output
    columns (name -> array) or None for no rows.
    """
    python_ready(df.sparkSession)
    struct: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            for c in chunks(b.column(b.schema.get_field_index("text")), limit, lower):
                out = fn(b.slice(c.lo, c.rows), c)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [_as(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def _as(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if not isinstance(values, pa.Array):
        return pa.array(values, kind)
    return values if values.type == kind else values.cast(kind)


def column(rows: pa.RecordBatch, name: str) -> pa.Array:
    return rows.column(rows.schema.get_field_index(name))


def kept_table(df: DataFrame, purpose: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame under the cluster's shared folder and read it back.

    Cuts the lineage with one job; a lost executor costs a re-read, not a
    recomputation of everything before it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    w = df.write.mode("error")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def smallest(rows: DataFrame, group: str, h: str, per_group: int) -> DataFrame:
    """At most ``per_group`` rows of each group: those with the smallest hash.

    Rows are first counted by group and by the top 18 bits of the hash, which
    combines map-side; only rows up to the bucket where a group has enough are
    then ranked.  So little more than the sample itself is shuffled, however
    large a group is.  One row per group is broadcast: groups are classes or
    languages, a small domain.
    """
    part = F.shiftrightunsigned(F.col(h), 46)
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.groupBy(group, part.alias("part")).agg(F.count(F.lit(1)).alias("c")) \
        .withColumn("had", F.coalesce(F.sum("c").over(before), F.lit(0))).filter(F.col("had") < per_group) \
        .groupBy(group).agg(F.max("part").alias("last_part"))
    few = rows.join(F.broadcast(last), group).filter(part <= F.col("last_part")).drop("last_part")
    order = Window.partitionBy(group).orderBy(*[c for c in [h, *few.columns] if c != group])
    return few.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_group).drop("nth")


def crc_remainder(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def marked_apart(rows: DataFrame, cols: list[str], marks: DataFrame, n: int, max_bits: int = 1 << 28) -> tuple[DataFrame, DataFrame]:
    """(rows surely without a mark, rows that may have one), by a bit filter.

    ``marks`` holds the marked values of ``cols``.  The filter has 16 bits for
    each of the n rows, at most ``max_bits`` (32 MB), and is what is broadcast;
    past that bound more unmarked rows land in the second frame, where the
    caller's exact join sorts them out.
    """
    blocks = max(1, -(-min(16 * n, max_bits) // 32768))
    slot = F.pmod(F.xxhash64(*cols), F.lit(blocks * 32768))
    block, bit = F.floor(slot / 32768).cast("long"), F.pmod(slot, F.lit(32768))
    seen = kept_table(marks.select(block.alias("filter_block"), bit.alias("b")).groupBy("filter_block")
                      .agg(F.bitmap_construct_agg("b").alias("filter_bits")), "marks")
    byte = F.substring(F.col("filter_bits"), F.shiftright(bit.cast("int"), 3) + 1, F.lit(1))
    hit = F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), bit.cast("int").bitwiseAND(F.lit(7))) == 1, F.lit(False))
    tested = rows.withColumn("filter_block", block).join(F.broadcast(seen), "filter_block", "left").withColumn("filter_hit", hit)
    return tested.filter(~F.col("filter_hit")).select(*rows.columns), tested.filter("filter_hit").select(*rows.columns)
