"""Which data files of a table hold which keys: exact bitmaps beside the table.

An append-only table grows by files, and every load has to know which of its keys
the table holds already.  The index keeps, for each data file, a bitmap of an
integral key column: one row for each 32,768 consecutive key values that the file
touches (Spark's bitmap buckets).  A load joins its own keys with the bitmaps of
their buckets; data files are opened only where whole rows must be compared, and
then only those whose bitmap holds one of the keys.

The index lies in ``_key_index`` inside the table's folder, which readers of the
table skip.  It is append-only and names the file of every row: files that it does
not know (a first use, or a load that ended between its two writes) are indexed
when it is next opened, rows of files that are gone are ignored, and an overwrite
of the table removes it.  One writer at a time, as for the table itself.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from ..sources.files import path_exists

_INDEX = "file string, bucket long, bits binary"
_NO_BUCKET = -1 << 62


def bit_at(bits: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set (bitmaps count from the lowest bit of
    their first byte)."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position.cast("int"), 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, position.cast("int").bitwiseAND(F.lit(7))) == 1, F.lit(False))


class KeyIndex:
    """The key index of the table at ``target``; null keys are kept as well."""

    def __init__(self, spark: SparkSession, target: str, key: str, schema: StructType):
        if not isinstance(schema[key].dataType, (ByteType, ShortType, IntegerType, LongType)):
            raise ValueError(f"{key} is not an integral column")
        self.spark, self.target, self.key, self.schema = spark, target.rstrip("/"), key, schema
        self.path = f"{self.target}/_key_index"
        self.files: list[str] | None = None   # of the table, as of the last refresh
        self.stale = False                    # the index names files that are gone

    def _files(self) -> list[str]:
        """Data files of the table, relative to it (what any read of it lists)."""
        if not path_exists(self.spark, self.target):
            return []
        files = self.spark.read.schema(self.schema).parquet(self.target).inputFiles()
        return sorted(self._relative(f) for f in files)

    def _relative(self, file: str) -> str:
        name = self.target.rsplit("/", 1)[-1]
        return file.rsplit(f"/{name}/", 1)[-1]

    def _stored(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _INDEX)
        return self.spark.read.schema(_INDEX).parquet(self.path)

    def _read_files(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.target}/{unquote(f)}" for f in files]  # listed names are URL-encoded
        return self.spark.read.schema(self.schema).option("basePath", self.target).parquet(*paths)

    def refresh(self) -> int:
        """Index the data files that are not indexed yet; returns how many."""
        self.files = self._files()
        known = {r["file"] for r in self._stored().select("file").distinct().collect()}  # one name per data file
        new = sorted(set(self.files) - known)
        self.stale = bool(known - set(self.files))
        if not new:
            return 0
        name = self.target.rsplit("/", 1)[-1]
        rows = self._read_files(new).select(
            F.regexp_replace(F.substring_index(F.col("_metadata.file_path"), f"/{name}/", -1), "^/+", "").alias("file"),
            F.col(self.key).cast("long").alias("k"))
        index = rows.groupBy("file", F.bitmap_bucket_number("k").alias("bucket")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"))
        # Each file also has a row that matches no key, so that one without rows is not looked at again.
        marks = self.spark.createDataFrame([(f, _NO_BUCKET, None) for f in new], _INDEX)
        index.unionByName(marks).coalesce(1 + len(new) // 64).write.mode("append").parquet(self.path)
        return len(new)

    def hits(self, keys: DataFrame) -> DataFrame:
        """(key, file): the distinct keys that the table holds, and every file
        that holds them, as of the last refresh.  Reads no data file."""
        if self.files is None:
            self.refresh()
        k = F.col(self.key).cast("long")
        ids = keys.select(self.key).distinct().select(
            self.key, F.bitmap_bucket_number(k).alias("id_bucket"), F.bitmap_bit_position(k).alias("at"))
        index = self._stored()
        if self.stale:
            index = index.join(self.spark.createDataFrame([(f,) for f in self.files], "file string"), "file", "left_semi")
        same = index["bucket"].eqNullSafe(ids["id_bucket"])
        found = ids.join(index, same).filter(F.col("at").isNull() | bit_at(F.col("bits"), F.col("at")))
        return found.select(self.key, "file")

    def missing(self, rows: DataFrame) -> DataFrame:
        """The rows whose key the table does not hold (a null key is a key)."""
        held = self.hits(rows).select(F.col(self.key).alias("__held")).distinct()
        return rows.join(held, rows[self.key].eqNullSafe(held["__held"]), "left_anti")

    def read(self, keys: DataFrame) -> DataFrame:
        """The table's rows from the files that hold any of the keys (those files
        hold other keys as well)."""
        files = sorted(r["file"] for r in self.hits(keys).select("file").distinct().collect())
        return self._read_files(files)
