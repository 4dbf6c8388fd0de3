"""A stored table of one row per key, cut into hash buckets of the key.

``upsert_columns`` rewrites its whole table.  Here the bucket of a key is a
partition column, so an upsert reads and replaces only the buckets that its
batch has keys in; the others are neither listed for reading nor written.  The
column's name holds the number of buckets: a table opened with another number
is refused, since its keys would be looked for in the wrong places.

One writer a table.  The new files of all touched buckets are written before the
first old one goes, but buckets are swapped one by one, so a reader may see some
of a batch's buckets before and some after, and a driver lost during the swap has
to repeat the batch from a copy of the table (as with every dynamic overwrite).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.dedup import first_row_last_columns
from ..sources.files import _fs, path_exists
from .writes import touched_partitions, write_parquet


@dataclass(frozen=True)
class KeyedTable:
    """``schema`` is the table's columns; ``buckets`` is fixed when it is first written."""

    path: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int = 64

    @property
    def column(self) -> str:
        return f"bucket_of_{self.buckets}"

    def _bucket(self) -> Column:
        # Keys are hashed in the table's types: an int and an equal long hash differently.
        typed = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*typed), F.lit(self.buckets)).cast("int")

    def _stored(self, spark: SparkSession) -> DataFrame:
        fs, root = _fs(spark, self.path)
        names = {s.getPath().getName().partition("=")[0] for s in fs.listStatus(root) if s.isDirectory()}
        other = sorted(n for n in names if n.startswith("bucket_of_") and n != self.column)
        if other:
            raise ValueError(f"{self.path} is kept by {other[0]}, not {self.column}")
        full = StructType([*self.schema.fields, StructField(self.column, IntegerType(), True)])
        return spark.read.schema(full).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).select(*self.schema.names)

    def lookup(self, spark: SparkSession, **key) -> DataFrame:
        """The row of one key, from its bucket alone (a partition filter)."""
        if set(key) != set(self.keys):
            raise ValueError(f"the key is {self.keys}")
        one = spark.range(1).select(*[F.lit(key[k]).alias(k) for k in self.keys])
        bucket = one.select(self._bucket()).first()[0]
        same = [F.col(k).eqNullSafe(F.lit(key[k]).cast(self.schema[k].dataType)) for k in self.keys]
        rows = self._stored(spark).filter(F.col(self.column) == bucket)
        for s in same:
            rows = rows.filter(s)
        return rows.select(*self.schema.names)

    def upsert(self, spark: SparkSession, batch: DataFrame, order_by: Sequence[str],
               update_columns: Sequence[str]) -> int:
        """ON CONFLICT (keys) DO UPDATE SET c = new.c for ``update_columns``: a stored row
        keeps its other values, a new key takes them from its first row, and every key
        of the batch ends with the last row's ``update_columns``.  Null keys are one key.
        Returns the rows of the buckets written.  The batch is read twice (its buckets,
        at most ``buckets`` numbers, come to the driver first)."""
        cols = self.schema.names
        typed = [F.col(c).cast(self.schema[c].dataType).alias(c) for c in cols]
        order = [c for c in order_by]
        new = batch.select(*typed, *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                           F.lit(1).alias("__batch"), self._bucket().alias(self.column))
        o = [f"__o{i}" for i in range(len(order))]
        rows = new
        if path_exists(spark, self.path):
            touched = touched_partitions(new, [self.column])
            old = self._stored(spark).filter(touched)
            old = old.select(*cols, *[F.lit(None).cast(new.schema[c].dataType).alias(c) for c in o],
                             F.lit(0).alias("__batch"), self.column)
            rows = old.unionByName(new)
        merged = first_row_last_columns(rows, [self.column, *self.keys], ["__batch", *o], update_columns)
        return write_parquet(merged.select(*cols, self.column), self.path, "overwrite", [self.column],
                             replace="partitions")
