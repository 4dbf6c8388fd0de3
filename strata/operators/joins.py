"""Join helpers: single-row lookup, anti / semi joins.

No join forces a broadcast.  Spark broadcasts a side whose size in bytes it
knows to be below ``spark.sql.autoBroadcastJoinThreshold`` (from file sizes, or
at run time from real shuffle sizes), and no job runs while a plan is built.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_join(left: DataFrame, dim: DataFrame, left_keys: Sequence[str | Column],
                dim_keys: Sequence[str], take: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Left join that never changes the left row count.

    The dimension is first reduced to one row per lookup key (the smallest
    ``order_by`` wins -- a deterministic "first match"), then left-joined; an
    unmatched row keeps nulls.  The reduction is a partial (map-side) aggregate,
    so a hot key costs one row per map partition, not one task holding it all.
    """
    from .dedup import first_by_key
    one = first_by_key(dim.select(*dim_keys, *take, *[c for c in order_by if c not in take]),
                       list(dim_keys), list(order_by)).select(*dim_keys, *take)
    aliased = one.select(*[F.col(k).alias(f"__lk{i}") for i, k in enumerate(dim_keys)], *take)
    cond = None
    for i, lk in enumerate(left_keys):
        lc = F.col(lk) if isinstance(lk, str) else lk
        c = lc == F.col(f"__lk{i}")
        cond = c if cond is None else cond & c
    out = left.join(aliased, cond, "left")
    return out.drop(*[f"__lk{i}" for i in range(len(dim_keys))])


def missing_keys(source: DataFrame, target: DataFrame, source_key: str,
                 target_key: str | None = None) -> DataFrame:
    """Distinct source keys absent from target (left anti join; null keys kept)."""
    target_key = target_key or source_key
    # Both sides are reduced to distinct keys first: a partial aggregate, so a
    # key repeated across a third of the rows shuffles as one row per map task.
    t = target.select(F.col(target_key).alias("__tk")).distinct()
    s = source.select(source_key).distinct()
    return s.join(t, F.col(source_key) == F.col("__tk"), "left_anti")


def having_match(rows: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (left semi join).

    The keys are made distinct first: that combines map-side, so a key that a
    third of the rows hold reaches the join as one row per map task.  AQE
    cannot split the right side of a semi join."""
    return rows.join(keys.select(*([on] if isinstance(on, str) else on)).distinct(), on, "left_semi")
