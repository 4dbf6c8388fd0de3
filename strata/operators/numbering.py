"""Dense surrogate keys: 1, 2, 3, ... in a declared order, over any number of loads."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_dir
from ..sinks.writes import write_parquet
from ..sources.files import path_exists


def numbered(df: DataFrame, order_by: Sequence[str], id_col: str, after: int = 0) -> DataFrame:
    """The rows with ``id_col`` = after + 1, after + 2, ... in the given order.

    Rows are range-partitioned by the order and sorted within partitions, and
    written once, so that places hold; a partition's first number is the sum of
    the sizes of those before it.  No task sees more than its range, and what is
    summed up and broadcast is one number per partition.  Rows that tie in the
    order are told apart by a hash of all their columns, so only equal rows may
    swap their numbers in a rerun."""
    spark = df.sparkSession
    rest = F.xxhash64(*[F.col(c) for c in df.columns])
    place = F.monotonically_increasing_id()  # partition number << 33 | row number
    rows = df.withColumn("__tie", rest)
    order = [*order_by, "__tie"]
    path = shared_dir(spark, "numbered")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", place).drop("__tie")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    part = F.shiftright("__place", 33)
    sizes = {r["p"]: r["n"] for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], after
    for p in sorted(sizes):  # one number per partition
        starts.append((p, total))
        total += sizes[p]
    first = spark.createDataFrame(starts, "__part long, __first long")
    return rows.withColumn("__part", part).join(F.broadcast(first), "__part") \
        .withColumn(id_col, F.col("__first") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1) \
        .select(id_col, *df.columns)


def append_numbered(spark: SparkSession, new: DataFrame, target: str, order_by: Sequence[str], id_col: str,
                    schema: StructType, partition_by: Sequence[str] | None = None) -> int:
    """Append rows whose ids continue after the largest of the target; returns the
    rows written.  The maximum comes from the footers of the target's files where
    Spark pushes it down.  One writer at a time."""
    after = 0
    if path_exists(spark, target):
        after = spark.read.schema(schema).parquet(target).agg(F.max(id_col)).first()[0] or 0
    return write_parquet(numbered(new, order_by, id_col, after).select(*schema.fieldNames()), target, "append", partition_by,
                         sort_within=[id_col])
