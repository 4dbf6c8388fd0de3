"""Data-quality checks as DataFrames (one small result row per check)."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import missing_keys


def orphan_check(source: DataFrame, target: DataFrame, source_key: str, target_key: str | None = None,
                 source_name: str = "source", target_name: str = "target") -> DataFrame:
    """Referential integrity: distinct source keys missing from target.

    One row: source, target, orphan_keys, status ('Success' when none).
    """
    return orphan_row(missing_keys(source, target, source_key, target_key), source_name, target_name)


def orphan_row(missing: DataFrame, source_name: str, target_name: str) -> DataFrame:
    """The result row of ``orphan_check`` from the distinct missing keys."""
    n = missing.agg(F.count(F.lit(1)).alias("orphan_keys"))
    return n.select(F.lit(source_name).alias("source"), F.lit(target_name).alias("target"),
                    F.col("orphan_keys"),
                    F.when(F.col("orphan_keys") == 0, F.lit("Success")).otherwise(F.lit("Failed"))
                    .alias("status"))


def run_record_counts(tables: Mapping[str, DataFrame], run_filter: Column | str) -> DataFrame:
    """Rows loaded by this run, per table; ``ok`` is false for a table with none.
    ``run_filter`` is a Column or a SQL predicate string."""
    parts = [df.where(run_filter).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table_name"), F.col("rows")) for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("ok", F.col("rows") > 0)


def nonempty_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table and whether it has any row (the value is tested,
    not merely that a count query returned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("rows") > 0)


def key_violations(df: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """Declared-key check: keys held by more than one row, and rows with a null key part."""
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(F.when(~any_null & (F.col("n") > 1), 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).cast("long").alias("null_key_rows"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
             "duplicate_keys", "null_key_rows")


def null_violations(df: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
    """Count of nulls per declared NOT NULL column (one pass over the table)."""
    aggs = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]
    wide = df.agg(*aggs)
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("null_rows")) for c in columns
    ])).alias("s"))
    return stacked.select(F.lit(table_name).alias("table_name"), "s.column_name", "s.null_rows")
