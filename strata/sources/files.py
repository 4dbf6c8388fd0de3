"""File scans under explicit schemas; type inference and drift reports are separate reads."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.util import inheritable_thread_target


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def modified(spark: SparkSession, path: str) -> int:
    """When a path was last modified (epoch milliseconds, any scheme)."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop FileSystem of the path (any scheme)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


#: Reads that a table of many directories is split into, and how many are listed at once.
LISTINGS, LISTED_AT_ONCE = 32, 8


def read_directories(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A partitioned parquet table of very many directories, read under its schema
    (partition values from the directory names, as in any read of it).

    Spark fills in the values of a read's directories from a linked list by position,
    so listing n of them takes time in n squared.  The directories of the first
    partition column are dealt into up to LISTINGS reads, several listed at a time,
    and the rows are their union."""
    fs, p = _fs(spark, path)
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)]
    seen = sorted((n, d) for n, d in found if n[:1] != "." and (n[:1] != "_" or "=" in n))
    if len(seen) < 2 or not all(d and "=" in n for n, d in seen):
        return spark.read.schema(schema).parquet(path)
    dealt = [[f"{path.rstrip('/')}/{n}" for n, _ in seen[i::LISTINGS]] for i in range(min(LISTINGS, len(seen)))]

    def read(dirs: list[str]) -> DataFrame:
        return spark.read.schema(schema).option("basePath", path).parquet(*dirs)

    with ThreadPoolExecutor(LISTED_AT_ONCE) as pool:
        return reduce(DataFrame.union, pool.map(inheritable_thread_target(spark)(read), dealt))


def _csv_reader(spark: SparkSession, header: bool, recursive: bool, glob: str | None, options: dict):
    r = spark.read.option("header", str(header).lower())
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in options.items():
        r = r.option(k, v)
    return r


def csv_text(spark: SparkSession, path: str | list[str], schema: StructType, *, recursive: bool = False,
             glob: str | None = None, **options) -> DataFrame:
    """The schema's columns of headed CSV files, by header name, as text.

    The names come from a header line (no pass over the data).  A column the
    header lacks raises, and so does a further file whose header differs."""
    r = _csv_reader(spark, True, recursive, glob, options)
    names = r.csv(path).columns
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"CSV header of {path} lacks {missing}; it has {names}")
    text = StructType([StructField(n, StringType(), True) for n in names])
    return r.schema(text).option("enforceSchema", "false").csv(path).select(*schema.fieldNames())


def _typed(f: StructField) -> Column:
    c = F.col(f.name)
    return c if isinstance(f.dataType, StringType) else F.when(F.trim(c) != "", F.trim(c)).try_cast(f.dataType)


def csv_bad_fields(text: DataFrame, schema: StructType) -> DataFrame:
    """The text rows with ``bad_fields``: the columns whose text is not of the
    schema's type (a blank is a null, not a bad field)."""
    bad = [F.when((F.trim(F.col(f.name)) != "") & _typed(f).isNull(), F.lit(f.name))
           for f in schema if not isinstance(f.dataType, StringType)]
    fields = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return text.withColumn("bad_fields", fields)


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, *, header: bool = True,
             recursive: bool = False, glob: str | None = None, on_bad: str = "null", **options) -> DataFrame:
    """CSV under a schema; every file of a directory (optionally recursively) is
    read and concatenated -- one scan, not a per-file loop.

    With a header, columns are taken by name and checked (``csv_text``); without
    one, by position.  ``on_bad`` says what becomes of a row with a field of the
    wrong type: "null" keeps it with a null there, "drop" leaves the row out
    (count such rows with ``csv_rejects``)."""
    if on_bad not in ("null", "drop"):
        raise ValueError(f"unknown policy {on_bad!r}")
    if header:
        text = csv_text(spark, path, schema, recursive=recursive, glob=glob, **options)
    else:
        plain = StructType([StructField(f.name, StringType(), True) for f in schema])
        text = _csv_reader(spark, False, recursive, glob, options).schema(plain).csv(path)
    if on_bad == "drop":
        text = csv_bad_fields(text, schema).filter(F.size("bad_fields") == 0)
    return text.select(*[_typed(f).alias(f.name) for f in schema])


def csv_rejects(text: DataFrame, schema: StructType) -> DataFrame:
    """One row: rows read, rows with a bad field, bad fields in all."""
    n = F.size("bad_fields")
    return csv_bad_fields(text, schema).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(n > 0, 1)).alias("bad_rows"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("bad_fields"))


#: Types a text column can be found to hold, the narrowest first.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def _is(c: Column, kind: str) -> Column:
    """Whether a filled field is of a type, as type inference of CSV files counts it."""
    if kind == "boolean":
        return F.lower(c).isin("true", "false")
    fits = c.try_cast(kind).isNotNull()
    return fits & c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") if kind == "date" else fits


def _headed_text(spark: SparkSession, path: str | list[str], recursive: bool, glob: str | None, options: dict) -> DataFrame:
    """Every column of headed CSV files as text; files of another header raise."""
    return _csv_reader(spark, True, recursive, glob, {"enforceSchema": "false", **options}).csv(path)


def inferred_types(text: DataFrame, declared: StructType = StructType([])) -> DataFrame:
    """One row per column of text: column_name, filled (fields that are not blank),
    inferred, the narrowest type every filled field has ("string" if none, null
    without a filled field), and misfits, the filled fields that are not of the
    column's declared type (null for a column not declared).

    One aggregate over the rows; only counts are shuffled."""
    types = {f.name: f for f in declared}
    aggs = []
    for name in text.columns:
        v = F.trim(F.col(f"`{name}`"))
        v = F.when(v != "", v)
        filled = F.count(v)
        kind = F.when(filled == 0, F.lit(None).cast("string"))
        for k in INFERRED:
            kind = kind.when(F.count(F.when(_is(v, k), 1)) == filled, F.lit(k))
        misfits = F.count(F.when(v.isNotNull() & _typed(types[name]).isNull(), 1)) if name in types else F.lit(None).cast("long")
        aggs.append(F.struct(F.lit(name).alias("column_name"), filled.alias("filled"), kind.otherwise(F.lit("string")).alias("inferred"),
                             misfits.alias("misfits")))
    return text.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def read_csv_inferred(spark: SparkSession, path: str | list[str], *, recursive: bool = False, glob: str | None = None,
                      **options) -> DataFrame:
    """Headed CSV under the schema its fields show (two scans: types, then rows).
    A column without a filled field stays text."""
    text = _headed_text(spark, path, recursive, glob, options)
    types = {r["column_name"]: r["inferred"] or "string" for r in inferred_types(text).collect()}  # one row a column
    return text.select(*[F.when(F.trim(F.col(f"`{c}`")) != "", F.trim(F.col(f"`{c}`"))).cast(types[c]).alias(c)
                         if types[c] != "string" else F.col(f"`{c}`") for c in text.columns])


def schema_drift(spark: SparkSession, path: str | list[str], schema: StructType, *, recursive: bool = False,
                 glob: str | None = None, **options) -> DataFrame:
    """One row per column that headed CSV files or a declared schema name:
    column_name, declared, inferred (types), filled, misfits (filled fields that
    are not of the declared type) and status: "fits", "misfits", "missing" (only
    declared) or "extra" (only in the files).  One pass over the files."""
    found = inferred_types(_headed_text(spark, path, recursive, glob, options), schema)
    names = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "column_name string, declared string")
    status = F.when(F.col("filled").isNull(), "missing").when(F.col("declared").isNull(), "extra") \
        .when(F.col("misfits") > 0, "misfits").otherwise("fits")
    return found.join(names, "column_name", "full").select("column_name", "declared", "inferred", "filled", "misfits", status.alias("status"))


CORRUPT = "corrupt_record"


def read_json(spark: SparkSession, path: str | list[str], schema: StructType, *, recursive: bool = False,
              glob: str | None = "*.json", on_bad: str = "raise", **options) -> DataFrame:
    """JSON lines from a path, a glob ("dir/*/*/*.json") or a whole directory tree.

    ``on_bad`` says what becomes of a line that is not JSON of the schema's types:
    "raise" ends the job with an error, "keep" returns it as a row of nulls with
    its text in a further column ``corrupt_record`` (null for good lines)."""
    if on_bad not in ("raise", "keep"):
        raise ValueError(f"unknown policy {on_bad!r}")
    r = spark.read.option("mode", "FAILFAST")
    if on_bad == "keep":
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
        r = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    r = r.schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
        if glob:
            r = r.option("pathGlobFilter", glob)
    for k, v in options.items():
        r = r.option(k, v)
    return r.json(path)


def json_paths(spark: SparkSession, mapping: str) -> list[str]:
    """The paths of a mapping file: {"jsonpaths": ["$.a", "$['b']['c']", ...]},
    one for each column of the schema, in order."""
    [text] = spark.read.text(mapping, wholetext=True).collect()  # one small file
    paths = json.loads(text["value"])["jsonpaths"]
    if not all(isinstance(p, str) and p.startswith("$") for p in paths):
        raise ValueError(f"{mapping}: not a list of JSON paths")
    return paths


def mapped_json(lines: DataFrame, schema: StructType, paths: list[str]) -> DataFrame:
    """Text lines (column ``value``) as the schema's columns, taken from the given
    JSON paths (column i is at path i), with ``corrupt_record`` and the frame's
    other columns.

    A line is parsed once, as a variant; a path that it lacks is a null.  A line
    that is not JSON, or has a value of another type at a path, is kept as a row
    of nulls with its text in ``corrupt_record``."""
    if len(paths) != len(schema.fields):
        raise ValueError(f"{len(paths)} paths for {len(schema.fields)} columns")
    other = [c for c in lines.columns if c != "value"]
    names = [f"c{i}" for i in range(len(paths))]
    rows = lines.filter(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    rows = rows.select(*other, "value", "v", *[F.try_variant_get("v", p, f.dataType.simpleString()).alias(n)
                                               for p, f, n in zip(paths, schema, names)])
    # a value is there but is not of the column's type (a JSON null is a null of any type)
    wrong = F.lit(False)
    for p, n in zip(paths, names):
        there = F.try_variant_get("v", p, "variant")
        wrong = wrong | (F.col(n).isNull() & there.isNotNull() & ~F.coalesce(F.is_variant_null(there), F.lit(False)))
    bad = F.col("v").isNull() | wrong
    return rows.select(*[F.when(~bad, F.col(n)).alias(f.name) for n, f in zip(names, schema)],
                       F.when(bad, F.col("value")).alias(CORRUPT), *other)


def stage_json(spark: SparkSession, path_template: str, schema: StructType, target: str, *, mapping: str | None = None,
               quarantine: str | None = None, glob: str = "*.json", **params) -> int:
    """Bulk stage: truncate ``target`` and load every JSON file under the path
    rendered from ``path_template`` with ``params`` (e.g. the run's date).
    Columns are matched by name through the schema, or by the paths of a
    ``mapping`` file; epoch-ms times stay longs.  Returns the rows staged
    (observed during the write, one job).

    A malformed line raises, or with ``quarantine`` is left out and kept there:
    see ``stage_json_report``."""
    return stage_json_report(spark, path_template, schema, target, mapping=mapping, quarantine=quarantine, glob=glob,
                             **params)["loaded"]


def stage_json_report(spark: SparkSession, path_template: str, schema: StructType, target: str, *, mapping: str | None = None,
                      quarantine: str | None = None, glob: str = "*.json", **params) -> dict[str, int]:
    """``stage_json`` that returns the lines loaded and rejected.

    Both are counted by one Observation while the good lines are written.  The
    rejected ones go to the table ``quarantine`` (file, line, corrupt_record),
    which is overwritten; a second scan finds them, run only if there are any."""
    from .ordered import ordered_lines
    src = path_template.format(**params)
    paths = json_paths(spark, mapping) if mapping else None
    if paths:
        text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(src)
        rows = mapped_json(text, schema, paths)
        if not quarantine:
            stop = F.raise_error(F.concat(F.lit("malformed line: "), F.col(CORRUPT))).cast("string")
            rows = rows.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), stop))
    elif quarantine:
        rows = read_json(spark, src, schema, recursive=True, glob=glob, on_bad="keep")
    else:
        rows = read_json(spark, src, schema, recursive=True, glob=glob).withColumn(CORRUPT, F.lit(None).cast("string"))
    obs = Observation("stage")
    counted = rows.observe(obs, F.count(F.when(F.col(CORRUPT).isNull(), 1)).alias("loaded"), F.count(CORRUPT).alias("rejected"))
    counted.filter(F.col(CORRUPT).isNull()).select(*schema.fieldNames()).write.mode("overwrite").parquet(target)
    report = {k: int(obs.get[k]) for k in ("loaded", "rejected")}
    if quarantine:
        bad = spark.createDataFrame([], f"file string, line long, {CORRUPT} string")
        if report["rejected"]:
            lines = ordered_lines(spark, src, recursive=True, glob=glob)
            full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
            parsed = mapped_json(lines, schema, paths) if paths else lines.filter(F.trim("value") != "").select(
                "file", "line", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})[CORRUPT].alias(CORRUPT))
            bad = parsed.filter(F.col(CORRUPT).isNotNull()).select("file", "line", CORRUPT)
        bad.write.mode("overwrite").parquet(quarantine)
    return report


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows, ordered when an order is given (so it is reproducible)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
