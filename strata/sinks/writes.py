"""Writers.  See package docstring."""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from ..operators.dedup import first_by_key, first_row_last_columns
from ..sources.files import _fs, path_exists


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def for_partitioned_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows grouped by their output partition before a partitioned write.

    Without it every task writes a file into every partition value it holds
    (tasks x values small files).  The rebalance hint shuffles by the partition
    columns and lets AQE split a value holding a large share of the rows into
    several advisory-sized tasks and merge small ones, so each directory gets
    few, evenly sized files and no task receives a hot value whole."""
    return df.hint("rebalance", *partition_by)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None,
                  sort_within: Sequence[str] | None = None, replace: str = "table",
                  options: dict[str, str] | None = None) -> int:
    """Parquet write (overwrite / append), optionally partitioned; returns rows written.

    An overwrite replaces the whole table; with ``replace="partitions"`` only
    the partitions that the rows touch (dynamic mode, for this write alone).
    ``sort_within`` sorts each task's rows before writing, so every file's
    row groups cover narrow ranges of those columns and a range filter on a
    later read skips them by their min/max statistics.  ``options`` go to the
    parquet writer (``bloom_options``)."""
    if partition_by:
        df = for_partitioned_write(df, partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    d, obs = _observed(df, "write")
    w = d.write.mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    w.parquet(path)
    return int(obs.get["rows"])


def bloom_options(values_per_row_group: dict[str, int]) -> dict[str, str]:
    """Writer options for a Bloom filter on each named column, sized for that many
    distinct values in a row group.  An equality filter on the column then skips row
    groups (and, of most files, all data) that cannot hold the value, where min/max
    statistics say nothing because the table is not sorted by it."""
    out = {}
    for c, n in values_per_row_group.items():
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(n)
    return out


SINGLE_FILE_ROWS = 1_000_000


def single_file_overwrite(df: DataFrame, path: str, max_rows: int = SINGLE_FILE_ROWS) -> int:
    """Full refresh of a small table as one file.

    One task writes one file, so the row count is checked first: beyond
    ``max_rows`` the write is an ordinary one, of as many files as it has tasks."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return write_parquet(df.coalesce(1) if small else df, path, "overwrite")


def load_table(df: DataFrame, path: str, append: bool = True,
               partition_by: Sequence[str] | None = None) -> int:
    """INSERT INTO ... SELECT (append) or truncate-then-insert (overwrite)."""
    return write_parquet(df, path, "append" if append else "overwrite", partition_by)


def _key_match(new: DataFrame, old: DataFrame, keys: Sequence[str], null_safe: bool):
    cond = [(new[k].eqNullSafe(old[k]) if null_safe else new[k] == old[k]) for k in keys]
    return reduce(lambda a, b: a & b, cond)


def incremental_load(spark: SparkSession, new: DataFrame, target: str, keys: Sequence[str],
                     partition_by: Sequence[str] | None = None, *, schema: StructType | None = None,
                     null_safe: bool = True, refresh: bool = False,
                     prune_by: Sequence[str] | None = None, range_by: Sequence[str] | None = None,
                     sort_within: Sequence[str] | None = None) -> int:
    """Idempotent incremental load: append only rows whose key is not in the
    target yet; create the target when absent.  Loading the same data twice
    equals loading it once.

    ``null_safe`` makes a null key match an existing null key (otherwise an
    anti join re-appends null-key rows on every run).  ``refresh=True``
    instead overwrites the partitions the new rows touch (dynamic partition
    overwrite) -- for late rows of an already-loaded key.
    ``prune_by`` names partition columns that the key determines (a match's
    date, say): the existing keys are then read only from the partitions the
    new rows fall in (a partition filter on the scan) instead of the whole table.
    Those values are fetched by a small job over ``new`` before the write, so
    ``new`` is evaluated twice: use it when ``new`` is cheap to re-read (a
    batch of files) and the target is large.
    ``range_by`` names key columns whose [min, max] over ``new`` bounds the
    existing keys read (exact: rows outside cannot match); with the target
    written ``sort_within`` those columns, the filter skips row groups of
    older data by their statistics instead of reading them.
    Single writer per target: append + anti join is not atomic across writers.
    """
    if refresh:
        if not partition_by:
            raise ValueError("refresh needs partition columns")
        return write_parquet(new, target, "overwrite", partition_by, sort_within, replace="partitions")
    if path_exists(spark, target):
        todo = rows_not_in_target(spark, new, target, keys, schema=schema, null_safe=null_safe,
                                  prune_by=prune_by, range_by=range_by)
        return write_parquet(todo, target, "append", partition_by, sort_within)
    return write_parquet(new, target, "overwrite", partition_by, sort_within)


def _plain(df: DataFrame, c: str) -> Column:
    """A column as it can pass through the driver: an instant as microseconds.
    (A Python datetime is local time, which is ambiguous in the hour that a
    clock change repeats.)"""
    return F.unix_micros(c) if isinstance(df.schema[c].dataType, TimestampType) else F.col(c)


def _literal(df: DataFrame, c: str, value) -> Column:
    return F.timestamp_micros(F.lit(value)) if isinstance(df.schema[c].dataType, TimestampType) else F.lit(value)


def touched_partitions(new: DataFrame, partition_cols: Sequence[str]) -> Column:
    """A predicate on partition columns that every row of ``new`` satisfies:
    each column is one of the values ``new`` holds.

    The distinct values are partition metadata, one per directory that the load
    writes; as a filter on a partitioned scan they become ``PartitionFilters``,
    so only those directories are listed and read."""
    cols = list(partition_cols)
    rows = new.select(*[_plain(new, c).alias(c) for c in cols]).distinct().collect()
    pred = F.lit(True)
    for i, c in enumerate(cols):
        vals = {r[i] for r in rows}
        known = [_literal(new, c, v) for v in sorted(vals - {None})]
        cond = F.col(c).isin(known) if known else F.lit(False)
        pred = pred & ((cond | F.col(c).isNull()) if None in vals else cond)
    return pred


def key_ranges(new: DataFrame, cols: Sequence[str], keep_nulls: bool) -> Column:
    """Each column within its [min, max] over ``new`` (one small aggregate job);
    ``keep_nulls`` also keeps null values (null-safe key matching)."""
    cols = list(cols)
    bounds = new.agg(*[F.min(_plain(new, c)).alias(f"lo{i}") for i, c in enumerate(cols)],
                     *[F.max(_plain(new, c)).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    pred = F.lit(True)
    for i, c in enumerate(cols):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        cond = F.col(c).between(_literal(new, c, lo), _literal(new, c, hi)) if lo is not None else F.lit(False)
        if keep_nulls:
            cond = cond | F.col(c).isNull()
        pred = pred & cond
    return pred


def rows_not_in_target(spark: SparkSession, new: DataFrame, target: str, keys: Sequence[str], *,
                       schema: StructType | None = None, null_safe: bool = True,
                       prune_by: Sequence[str] | None = None,
                       range_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``new`` whose key the existing table at ``target`` lacks (the
    plan an incremental load appends).  Only the key columns of the target are
    read; with ``prune_by`` (partition columns the key determines) only the
    partitions holding the new rows' values; with ``range_by`` (key columns)
    only rows within the new rows' key range, a filter parquet applies to row
    group statistics."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    existing = r.parquet(target)
    if prune_by:
        existing = existing.where(touched_partitions(new, prune_by))
    if range_by:
        existing = existing.where(key_ranges(new, range_by, null_safe))
    existing = existing.select(*keys).distinct()
    return new.join(existing, _key_match(new, existing, keys, null_safe), "left_anti")


def replace_values(spark: SparkSession, new: DataFrame, target: str, column: str, partition_by: Sequence[str], *,
                   schema: StructType, sort_within: Sequence[str] | None = None) -> int:
    """Overwrite the rows of those values of ``column`` that ``new`` holds; rows of
    other values stay.  For tables whose partitions hold many values: what a dynamic
    overwrite does where each value is a partition.  ``new`` is evaluated several
    times (a stored frame); returns its rows."""
    if not path_exists(spark, target):
        return write_parquet(new, target, "overwrite", partition_by, sort_within, replace="partitions")
    old = spark.read.schema(schema).parquet(target).where(touched_partitions(new, partition_by))
    values = new.select(F.col(column).alias("__value")).distinct()
    kept = old.join(values, old[column].eqNullSafe(values["__value"]), "left_anti")
    write_parquet(new.unionByName(kept.select(*new.columns)), target, "overwrite", partition_by, sort_within, replace="partitions")
    return new.count()


def append_if_absent(spark: SparkSession, new: DataFrame, target: str, keys: Sequence[str],
                     order_by: Sequence[str], partition_by: Sequence[str] | None = None,
                     schema: StructType | None = None, drop_order: bool = True,
                     range_by: Sequence[str] | None = None,
                     sort_within: Sequence[str] | None = None) -> int:
    """INSERT ... ON CONFLICT (keys) DO NOTHING: the first new row per key is
    added unless the key is already in the target.  ``range_by`` /
    ``sort_within`` as in ``incremental_load`` (a fact keyed by time: a batch
    of later plays skips the row groups of earlier ones)."""
    firsts = first_by_key(new, keys, order_by)
    if drop_order:
        firsts = firsts.drop(*[c for c in order_by if c not in keys])
    return incremental_load(spark, firsts, target, keys, partition_by, schema=schema,
                            range_by=range_by, sort_within=sort_within)


def replace_table(spark: SparkSession, df: DataFrame, target: str,
                  partition_by: Sequence[str] | None = None) -> int:
    """Overwrite a table with data that may be read from that same table:
    write to a sibling directory first, then swap directories.

    The old table is moved aside (not deleted) before the swap and put back if
    the swap fails, so a failure at any point leaves a complete table at
    ``target`` or beside it, never nothing."""
    tag = uuid.uuid4().hex[:8]
    staging = f"{target.rstrip('/')}.__staging-{tag}"
    n = write_parquet(df, staging, "overwrite", partition_by)
    fs, t = _fs(spark, target)
    _, s = _fs(spark, staging)
    _, b = _fs(spark, f"{target.rstrip('/')}.__previous-{tag}")
    had_old = fs.exists(t)
    if had_old and not fs.rename(t, b):
        raise IOError(f"could not move {target} aside")
    if not fs.rename(s, t):
        if had_old:
            fs.rename(b, t)
        raise IOError(f"could not move {staging} to {target}")
    if had_old:
        fs.delete(b, True)
    return n


def upsert_columns(spark: SparkSession, new: DataFrame, target: str, keys: Sequence[str],
                   order_by: Sequence[str], update_columns: Sequence[str],
                   schema: StructType | None = None) -> int:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET c = EXCLUDED.c for c in
    ``update_columns``: existing rows keep their other values, every key takes
    the last new value of the updated columns.  Applying a batch at once equals
    applying its rows one by one in ``order_by`` order."""
    cols = [c for c in new.columns if c not in order_by]
    ordered = new.select(*cols, F.lit(1).alias("__batch"), *order_by)
    if path_exists(spark, target):
        r = spark.read.schema(schema) if schema is not None else spark.read
        old = r.parquet(target).select(*cols)
        old = old.select(*cols, F.lit(0).alias("__batch"), *[F.lit(None).cast(new.schema[c].dataType).alias(c)
                                                             for c in order_by])
        ordered = old.unionByName(ordered)
    o = ["__batch", *order_by]
    merged = first_row_last_columns(ordered, keys, o, update_columns).select(*cols)
    return replace_table(spark, merged, target)


def export_csv_quoted(df: DataFrame, path: str, single_file: bool = False) -> int:
    """CSV with a header line and every field quoted."""
    d = df.coalesce(1) if single_file else df
    d, obs = _observed(d, "csv")
    d.write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(path)
    return int(obs.get["rows"])


def create_table(spark: SparkSession, name: str, schema: StructType, path: str | None = None,
                 partition_by: Sequence[str] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS name (schema) USING parquet [PARTITIONED BY] [LOCATION]."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucketed_table(df: DataFrame, name: str, path: str, buckets: int, bucket_by: Sequence[str],
                   sort_by: Sequence[str] | None = None) -> None:
    """A catalog table bucketed (and sorted) by a join key, so joins of tables
    bucketed the same way on that key need no shuffle exchange."""
    w = df.write.mode("overwrite").option("path", path).format("parquet").bucketBy(buckets, *bucket_by)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(name)
