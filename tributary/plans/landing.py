"""Daily file landing.

Files of one dataset (CSV and JSON, any header order) are read as text,
headers light-cleaned, unioned by name and written as Snappy Parquet:

* static (K4): the whole dataset replaced at ``<root>/<dataset>``;
* incremental (K5/K6): each row goes to the ``year/month/day`` of the date
  in its file's name (else of its folder's name, else ``as_of``); only the
  days present are replaced (dynamic overwrite), all days in ONE job.

With an explicit ``execution_date`` (K5) only files dated that day, or not
dated at all, are landed there (decision Z2); ``all_files=True`` lands every
file on that day as the reference does.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.dates import as_date_literal, date_from_file_name, date_parts
from tributary.operators.columns import cleaned_names, dispatch_by_extension
from tributary.operators.union import union_by_name
from tributary.sinks.lake import PARTITION_COLS, layer_path, write_parquet
from tributary.sources.csvsrc import read_csv_files
from tributary.sources.jsonsrc import read_json_files

log = logging.getLogger(__name__)


def read_landing_files(spark: SparkSession, files: list[str], object_orient: str = "columns",
                       multi_line: bool = False) -> DataFrame | None:
    """CSV + JSON files -> one text DataFrame with ``_file``; unsupported
    extensions are skipped with a warning (P12).  ``None`` if nothing is
    readable.  JSON objects default to the column-oriented layout, which is
    how the landing path reads dict-shaped files; ``multi_line`` allows line
    breaks in quoted CSV cells."""
    parts = dispatch_by_extension(files)
    for p in parts["skipped"]:
        log.warning("Skipping unsupported file: %s", p)
    frames = []
    if parts["csv"]:
        frames.append(read_csv_files(spark, parts["csv"], with_file=True, multi_line=multi_line))
    if parts["json"]:
        frames.append(read_json_files(spark, parts["json"], object_orient=object_orient, with_file=True))
    if not frames:
        return None
    df = union_by_name(frames, as_text=True) if len(frames) > 1 else frames[0]
    keep = [c for c in df.columns if c != "_file"]
    renamed = cleaned_names(keep, "light")  # P1, collisions rejected up front
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(keep, renamed)], "_file")


def file_date(path_col) -> F.Column:
    """Date in the file stem, else in the enclosing folder's name (K6)."""
    parts = F.split(path_col, "/")
    stem = F.element_at(parts, -1)
    folder = F.element_at(parts, -2)
    return F.coalesce(date_from_file_name(stem), date_from_file_name(folder))


def of_day(spark: SparkSession, files: list[str], execution_date) -> list[str]:
    """The files whose name (or folder) gives that day or none."""
    import pandas as pd

    named = spark.createDataFrame(pd.DataFrame({"path": list(files)}), "path string").select("path", file_date(F.col("path")).alias("d"))
    return [r["path"] for r in named.where(F.col("d").isNull() | (F.col("d") == as_date_literal(execution_date))).orderBy("path").collect()]


def ingest(
    spark: SparkSession, files: list[str], root: str, dataset: str, incremental: bool = False,
    execution_date=None, as_of=None, all_files: bool = False, padded: bool = False, multi_line: bool = False,
) -> dict:
    """K4/K5/K6: land ``files`` under ``<root>/<dataset>``.

    With an ``execution_date`` (and not ``all_files``) the files named after
    another day are left out before any is opened: one day costs one day."""
    if incremental and execution_date is not None and not all_files:
        files = of_day(spark, files, execution_date)
        if not files:
            log.warning("No files of %s for %s", execution_date, dataset)
            return {"status": "empty", "path": None, "rows": 0}
    df = read_landing_files(spark, files, multi_line=multi_line)
    if df is None:
        log.warning("No valid files found for %s", dataset)
        return {"status": "empty", "path": None, "rows": 0}
    path = layer_path(root, dataset, None)
    if not incremental:
        return write_parquet(df.drop("_file"), path, None, mode="overwrite")
    fallback = as_date_literal(as_of or _dt.datetime.now(_dt.timezone.utc).date())
    day = F.coalesce(file_date(F.col("_file")), fallback)
    if execution_date is not None:
        day = as_date_literal(execution_date)
    out = df.select("*", *date_parts(day, padded=padded)).drop("_file")
    return write_parquet(out, path, PARTITION_COLS, mode="overwrite_partitions")
