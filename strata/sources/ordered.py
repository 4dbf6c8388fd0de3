"""Rows of text files with the file and the line they come from.

"First row wins" and "last row wins" follow the order in which rows arrive: file by
file in the order of their paths, line by line.  A large file is read in splits by
many tasks, so the number of a line is found in two steps: lines are counted per
split, the counts of a file's splits are summed up to each split, and a line's
number is that sum and its place within the split.  No file is read by one task
and nothing is sorted; only one row per split is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import _csv_reader, _typed

ORDER = ("file", "line")


def ordered_lines(spark: SparkSession, path: str | list[str], *, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """(file, line, value): every line, numbered from 1 within its file."""
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    # Rows of a split come in order, so the ids increase along its lines.
    rows = r.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                               F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    splits = rows.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    places = splits.select("file", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return rows.join(places, ["file", "split"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")


def ordered_json(spark: SparkSession, path: str | list[str], schema: StructType, *, recursive: bool = False,
                 glob: str | None = "*.json") -> DataFrame:
    """JSON lines under a schema, with file and line; a malformed line raises."""
    lines = ordered_lines(spark, path, recursive=recursive, glob=glob if recursive else None).filter(F.trim("value") != "")
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return lines.select("file", "line", parsed.alias("r")).select("r.*", "file", "line")


def ordered_csv(spark: SparkSession, path: str | list[str], schema: StructType, *, recursive: bool = False,
                glob: str | None = None, **options) -> DataFrame:
    """The schema's columns of headed CSV files, by header name and typed, with
    file and line (the header is line 1 and left out).

    A column that the header lacks raises.  Every file must have the header of the
    first; another one raises when the file is read.  A quoted field must not
    contain a line break (such files have no row per line)."""
    names = _csv_reader(spark, True, recursive, glob, options).csv(path).columns
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"CSV header of {path} lacks {missing}; it has {names}")
    text = ", ".join(f"`{n}` string" for n in names)
    lines = ordered_lines(spark, path, recursive=recursive, glob=glob)
    parsed = lines.select("file", "line", F.from_csv("value", text, options).alias("r"))
    same = F.to_json(F.col("r")) == F.to_json(F.struct(*[F.lit(n).alias(n) for n in names]))
    other = F.raise_error(F.concat(F.lit("another CSV header in "), F.col("file")))
    checked = parsed.filter(F.when(F.col("line") > 1, F.lit(True)).when(same, F.lit(False)).otherwise(other.cast("boolean")))
    return checked.select("file", "line", "r.*").select(*[_typed(f).alias(f.name) for f in schema], "file", "line")
