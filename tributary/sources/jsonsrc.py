"""JSON sources.

A JSON file is one of three top-level shapes, detected per file from its
first non-blank character (sniffed in parallel, see ``files.sniff_files``):

* array ``[...]``  — the elements are records; nested objects are kept as
  structs (not flattened).  Read by Spark's multi-line JSON reader, which
  streams the document.
* object ``{...}`` — by default (``object_orient="index"``) its *values*
  are the records; nested objects are flattened to dotted names.  With
  ``object_orient="columns"`` it is a column-oriented table
  ``{"col": {"row": value}}`` (the layout dataframe libraries write by
  default), pivoted back to rows.
* scalar — one row with the value in column ``value``.
* JSON Lines (a whole object on the first line and more lines after, or one
  object on one line of which some value is not an object) — one record per
  line, read by Spark's line-mode JSON reader (splittable).

Values land as text so shapes and files union without type clashes
(fact F2).  A document up to ``SPLIT_BYTES`` is parsed by one task; a larger
array, or object of records, is cut into its elements by byte ranges
(``byteranges.json_elements``), so no task and no value holds it whole.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.jsonfn import flatten
from tributary.operators.columns import clean_headers
from tributary.operators.metadata import stamp_landed, stamp_metadata
from tributary.operators.union import union_by_name
from tributary.session import scratch_path
from tributary.sources.byteranges import json_elements
from tributary.sources.files import list_objects, same_path as _same_path, sniff_heads
from tributary.schemas import SOURCE_SYSTEMS

log = logging.getLogger(__name__)

SPLIT_BYTES = 8 << 20      # documents above this are cut into their elements


def _documents(spark: SparkSession, files: list[str]) -> DataFrame:
    """One row per file: ``_file``, ``doc`` (variant)."""
    return (
        spark.read.text(files, wholetext=True)  # text()'s own argument, not an option
        .select(F.col("_metadata.file_path").alias("_file"), F.parse_json("value").alias("doc"))
    )


def _explode(docs: DataFrame, col: str) -> DataFrame:
    """``variant_explode`` as a lateral table function: ``pos, key, value``."""
    return docs.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col(col).outer()))


def _text_struct(dtype: T.DataType) -> T.DataType:
    """Same nesting of objects, every leaf (and every array) as text."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _text_struct(f.dataType), True) for f in dtype.fields])
    return T.StringType()


def _variant_schema(df: DataFrame, col: str) -> T.DataType | None:
    """Merged schema of a variant column (one small aggregate job)."""
    s = df.agg(F.schema_of_variant_agg(F.col(col))).first()[0]
    if s is None or s == "VOID":
        return None
    ddl = s.replace("OBJECT<", "STRUCT<")
    return T.DataType.fromDDL(ddl) if ddl.upper().startswith("STRUCT<") else T.StringType()


def _elements(spark: SparkSession, files: list[str], range_bytes: int | None) -> DataFrame:
    """Elements or entries of large documents as text (``_file, at, key, value``), cut once and kept."""
    sizes = spark.read.format("binaryFile").load(files).select(F.col("_metadata.file_path").alias("path"), "length")
    path = scratch_path(spark, "json-elements")
    json_elements(sizes, range_bytes).write.parquet(path)
    return spark.read.parquet(path)


def _text_leaves(dtype: T.DataType) -> T.DataType:
    """Same nesting of objects and arrays, every leaf as text (as Spark's reader infers with ``primitivesAsString``)."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _text_leaves(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_text_leaves(dtype.elementType), True)
    return T.StringType()


def _records_from_large_arrays(spark: SparkSession, files: list[str], range_bytes: int | None) -> DataFrame:
    """Elements of large arrays as records, typed as the reader of small ones types them."""
    elements = _elements(spark, files, range_bytes)
    schema = _variant_schema(elements.select(F.parse_json("value").alias("v")), "v")
    if not isinstance(schema, T.StructType):
        return elements.select("_file", "value")
    return elements.select("_file", F.from_json("value", _text_leaves(schema)).alias("r")).select("_file", "r.*")


def _records_from_objects(spark: SparkSession, files: list[str], flatten_nested: bool,
                          schema: T.StructType | None = None, large: bool = False, range_bytes: int | None = None) -> DataFrame:
    """Object files whose values are records.  Without ``schema`` the
    records' merged schema is inferred first (one extra pass, as Spark's own
    JSON inference does).  ``large``: the documents are cut into their entries."""
    if large:
        recs = _elements(spark, files, range_bytes).select("_file", F.parse_json("value").alias("rec"))
    else:
        recs = _explode(_documents(spark, files), "doc").select("_file", F.col("value").alias("rec"))
    schema = schema or _variant_schema(recs, "rec")
    if not isinstance(schema, T.StructType):
        return recs.select("_file", F.col("rec").cast("string").alias("value"))
    typed = recs.select("_file", F.col("rec").cast(_text_struct(schema)).alias("r")).select("_file", "r.*")
    return flatten(typed) if flatten_nested else typed


def _records_from_columns(spark: SparkSession, files: list[str]) -> DataFrame:
    """Column-oriented object files ``{"col": {"row": value}}``.

    Cells are exploded to ``(file, row, col, value)`` and regrouped per
    ``(file, row)``: each group holds one row's cells, so no group grows
    with the data.
    """
    outer = _explode(_documents(spark, files), "doc").select(
        "_file", F.col("key").alias("col"), F.col("value").alias("cells"))
    cells = _explode(outer, "cells").select(
        "_file", "col", F.col("key").alias("row"), F.col("value").cast("string").alias("v"))
    names = [r["col"] for r in cells.select("col").distinct().orderBy("col").collect()]  # column names only
    rows = cells.groupBy("_file", "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "v"))).alias("m"))
    return rows.select("_file", *[F.col("m").getItem(n).alias(n) for n in names])


def _larger_than(spark: SparkSession, files: list[str], size: int) -> set[str]:
    """Those of the files with more bytes; only they come back."""
    if not files:
        return set()
    found = {_same_path(r["path"]) for r in spark.read.format("binaryFile").load(files).where(F.col("length") > size).select("path").collect()}
    return {p for p in files if _same_path(p) in found}


def read_json_files(
    spark: SparkSession, paths: list[str], object_orient: str = "index", flatten_nested: bool = True,
    with_file: bool = False, record_schema: T.StructType | None = None, split_bytes: int = SPLIT_BYTES, range_bytes: int | None = None,
) -> DataFrame:
    """Many JSON files of any of the three shapes, appended by name.

    Empty files are skipped; if every file is empty a ``ValueError`` is
    raised.  Text that is not JSON fails the read.  Arrays and index-oriented objects larger than ``split_bytes`` are
    read by byte ranges of ``range_bytes``, many tasks a file; a column-oriented
    document stays one value, so it must be below Spark's limit of a VARIANT.
    """
    if not paths:
        raise FileNotFoundError("no JSON files given")
    sniffed = sniff_heads(spark, paths)  # one small row per file
    arrays = sorted(r["path"] for r in sniffed if r["first_char"] == "[")
    lines = sorted(r["path"] for r in sniffed if r["first_char"] == "{" and r.get("json_lines"))
    objects = sorted(r["path"] for r in sniffed if r["first_char"] == "{" and not r.get("json_lines"))
    scalars = sorted(r["path"] for r in sniffed if r["first_char"] not in (None, "[", "{"))
    empties = [r["path"] for r in sniffed if r["first_char"] is None]
    for p in empties:
        log.warning("skipping empty JSON file %s", p)
    frames: list[DataFrame] = []
    large = _larger_than(spark, arrays + (objects if object_orient == "index" else []), split_bytes)
    if any(p in large for p in arrays):
        frames.append(_records_from_large_arrays(spark, [p for p in arrays if p in large], range_bytes))
    if object_orient == "index" and any(p in large for p in objects):
        frames.append(_records_from_objects(spark, [p for p in objects if p in large], flatten_nested, record_schema, True, range_bytes))
        objects = [p for p in objects if p not in large]
    arrays = [p for p in arrays if p not in large]
    if arrays:
        frames.append(
            spark.read.option("multiLine", "true").option("primitivesAsString", "true").option("mode", "FAILFAST").json(arrays)
            .withColumn("_file", F.col("_metadata.file_path"))
        )
    if lines:  # JSON Lines: one record per line, read splittably
        frames.append(
            spark.read.option("primitivesAsString", "true").option("mode", "FAILFAST").json(lines)
            .withColumn("_file", F.col("_metadata.file_path"))
        )
    if objects:
        if object_orient == "index":
            frames.append(_records_from_objects(spark, objects, flatten_nested, record_schema))
        elif object_orient == "columns":
            frames.append(_records_from_columns(spark, objects))
        else:
            raise ValueError(f"unknown object_orient {object_orient!r}")
    if scalars:
        frames.append(_documents(spark, scalars).select("_file", F.col("doc").cast("string").alias("value")))
    if not frames:
        raise ValueError("No data read from JSON files")
    out = union_by_name(frames, as_text=False)
    return out if with_file else out.drop("_file")


def read_json(spark: SparkSession, path: str | list[str], **kw) -> DataFrame:
    """S3: one JSON object path; a list delegates to ``read_json_files``."""
    return read_json_files(spark, [path] if isinstance(path, str) else list(path), **kw)


def extract_social_media(spark: SparkSession, root: str, prefix: str = "", as_of=None, landing: str | None = None, **kw) -> DataFrame:
    """Every ``.json`` under the prefix whose path contains ``social``;
    union; light header clean; stamp ``s3_social_media``.  ``landing``: a folder the rows go
    to as Parquet at once; every file is then parsed one time, and the row count comes from the footers there."""
    listing = list_objects(spark, root, prefix=prefix, suffix=".json", ignore_case=False)  # suffix match is case-sensitive (S5)
    files = [r["path"] for r in listing.where(F.lower("path").contains("social")).select("path")
             .orderBy("path").collect()]
    if not files:
        raise FileNotFoundError("no social media JSON files found")
    df = clean_headers(read_json_files(spark, files, **kw), "light")
    location = f"{root.rstrip('/')}/{prefix}" if prefix else f"{root.rstrip('/')}/"
    if landing:
        return stamp_landed(df, landing, SOURCE_SYSTEMS["social_media"], location, as_of=as_of)
    return stamp_metadata(df, SOURCE_SYSTEMS["social_media"], location, as_of=as_of)
