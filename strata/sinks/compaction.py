"""Merging the small files that many appends leave behind.

Sizes come from the files' own metadata (no column is read for them).  Only
partitions with several small files are rewritten; rows keep their partition,
and the rebalance hint lets AQE pack them into files of the session's advisory
size and split a partition that needs several.  A ``KeyIndex`` of the table
takes up the new names at its next refresh.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .writes import replace_table, touched_partitions, write_parquet

TARGET_BYTES = 128 << 20


def file_sizes(spark: SparkSession, path: str, schema: StructType,
               partition_by: Sequence[str] = ()) -> DataFrame:
    """(partition columns, file, bytes): one row for each data file that holds rows."""
    t = spark.read.schema(schema).parquet(path)
    return t.select(*partition_by, F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_size").alias("bytes")).distinct()


def crowded(files: DataFrame, partition_by: Sequence[str], target_bytes: int) -> DataFrame:
    """Partitions with two files or more of under half of ``target_bytes``."""
    small = files.filter(F.col("bytes") * 2 < target_bytes)
    return small.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("small_files")).filter("small_files > 1")


def compact(spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = (),
            target_bytes: int = TARGET_BYTES, sort_within: Sequence[str] | None = None) -> int:
    """Rewrite the crowded partitions of a table; returns the rows rewritten (0: nothing to do).

    The values of crowded partitions pass through the driver, as partition metadata.
    An unpartitioned table is written beside itself and swapped; partitions are
    replaced in dynamic mode.  One writer a table.  A second call finds nothing
    to do unless AQE's advisory size is below half of ``target_bytes``."""
    by = list(partition_by)
    todo = crowded(file_sizes(spark, path, schema, by), by, target_bytes)
    if not todo.take(1):
        return 0
    table = spark.read.schema(schema).parquet(path)
    if not by:
        packed = table.hint("rebalance")
        return replace_table(spark, packed.sortWithinPartitions(*sort_within) if sort_within else packed, path)
    rows = table.filter(touched_partitions(todo, by))
    if len(by) > 1:  # the filter takes every combination of the values; keep the crowded ones
        parts = todo.select(*[F.col(c).alias(f"__{c}") for c in by])
        on = [rows[c].eqNullSafe(parts[f"__{c}"]) for c in by]
        rows = rows.join(parts, on, "left_semi")
    return write_parquet(rows, path, "overwrite", by, sort_within, replace="partitions")
