"""Key-based dedup policies (first row wins, last row wins, partial upserts).

Every policy follows an explicit arrival order, never "whatever row the
partition happened to see first".  Keeping a whole row per key is a
``row_number`` of 1, which Spark plans as ``WindowGroupLimit`` on both sides of
the shuffle: a key holding a third of all rows crosses it as one row per map
task, and near-unique keys (a fact) cost one sort, not an aggregate over
structs.  An upsert of some columns is a ``min_by`` / ``max_by`` aggregate, for
dimensions with few keys.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_struct(order_by: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], last: bool) -> DataFrame:
    order = _order_struct(order_by)
    return top_per_group(df, list(keys), [order.desc() if last else order.asc()])


def first_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` (insert-if-absent)."""
    return _pick(df, keys, order_by, last=False)


def last_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the largest ``order_by`` (primary-key upsert)."""
    return _pick(df, keys, order_by, last=True)


def first_row_last_columns(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                           update_columns: Sequence[str]) -> DataFrame:
    """Upsert that updates only ``update_columns``: first row's other values,
    last row's values of the updated columns (ON CONFLICT DO UPDATE SET c = new.c)."""
    keys, upd = list(keys), list(update_columns)
    keep = [c for c in df.columns if c not in keys and c not in upd]
    o = _order_struct(order_by)
    aggs = []
    if keep:
        aggs.append(F.min_by(F.struct(*keep), o).alias("__first"))
    if upd:
        aggs.append(F.max_by(F.struct(*upd), o).alias("__last"))
    out = df.groupBy(*keys).agg(*aggs)
    sel = [F.col(k) for k in keys] + [F.col(f"__first.{c}").alias(c) for c in keep] + \
        [F.col(f"__last.{c}").alias(c) for c in upd]
    return out.select(*sel).select(*df.columns)


def top_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str],
                  n: int = 1, rank_col: str | None = None) -> DataFrame:
    """Top-``n`` rows per group by ``row_number`` (planned as WindowGroupLimit)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)
