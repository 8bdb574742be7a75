"""CSV sources.

Spark's CSV reader, given several files, takes one header and binds every
file *by position* (fact F1): files with reordered or extra columns are
silently corrupted.  ``read_csv_files`` therefore sniffs every file's header
line in parallel, reads each header shape as one relation with that shape's
names, and unions the shapes by name.  Values land as text (fact F2); the
typed load casts later.  Files stay splittable: a large file is read by
many tasks (``spark.sql.files.maxPartitionBytes``), which takes the place of
chunked reading of big files (S11).  Files in which a line holds an odd number
of quotes may have line breaks inside cells; one scan finds them, and they are
read by byte ranges that each start at a true record (``byteranges``).
"""

from __future__ import annotations

import csv
import io
import logging
from collections import defaultdict

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.columns import add_pandas_index_names, clean_headers
from tributary.operators.metadata import stamp_landed, stamp_metadata
from tributary.operators.union import union_by_name
from tributary.sources.byteranges import csv_records
from tributary.sources.files import expand_paths, first_match, list_objects, same_path as _same_path, sniff_heads, unreadable
from tributary.schemas import SOURCE_SYSTEMS

log = logging.getLogger(__name__)

# RFC-4180 style quoting (a doubled quote escapes a quote).
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def read_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """One CSV (or a same-shaped set) with a header; options pass through."""
    opts = dict(CSV_OPTIONS)
    opts.update({k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()})
    return spark.read.options(**opts).csv(path)


def _q(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def parse_header(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line)))


def header_groups(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their exact header (empty files are skipped)."""
    sniffed = sniff_heads(spark, paths)  # one small row per file
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for r in sorted(sniffed, key=lambda r: r["path"]):
        if not r["first_line"]:
            log.warning("skipping empty file %s", r["path"])
            continue
        groups[tuple(parse_header(r["first_line"]))].append(r["path"])
    return groups


# The words a CSV cell may hold for "missing".
NULL_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
               "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_EXTRA = "__cells_beyond_the_header"
COMPRESSED = (".gz", ".bz2", ".xz", ".zst", ".lz4", ".snappy", ".deflate")


def files_with_broken_quotes(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those files (as URIs) of which some line holds an odd number of quotes:
    a cell may go on on the next line.  One native pass; only such files come back."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    return [r["f"] for r in spark.read.text(paths).where(quotes % 2 == 1)
            .groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).orderBy("f").collect()]


def checked_cells(df: DataFrame, names: list[str], too_many, null_values: tuple[str, ...], with_file: bool) -> DataFrame:
    """One treatment of every record: missing words are NULL, cells beyond the header fail the job with the file's name."""
    told = F.raise_error(F.concat(F.lit("a row has more cells than the header: "), F.col("_file")))
    df = df.where(F.when(too_many, told.cast("boolean")).otherwise(F.lit(True)))
    cells = [F.when(~_q(n).isin(*null_values), _q(n)).alias(n) if null_values else _q(n) for n in names]
    return df.select(*cells, *([F.col("_file")] if with_file else []))


def read_csv_files(spark: SparkSession, paths: list[str], with_file: bool = False, multi_line: bool | None = None,
                   null_values: tuple[str, ...] = NULL_VALUES, range_bytes: int | None = None) -> DataFrame:
    """Many CSV files, appended by column name.

    Each header shape is read once with an all-text schema named after that
    header (blank header -> ``Unnamed: <pos>``), so positions map to the
    right names; shapes are unioned by name, missing columns NULL.
    Quoted cells may hold line breaks: files with a line of an odd number of
    quotes are read by byte ranges of ``range_bytes``, many tasks a file (by one task
    each where the tasks' Python cannot open the store, or the file is compressed).  ``multi_line=False`` says that
    no cell holds a line break and saves the scan for them; ``True`` reads every file in one task.  Blank lines
    before the header are passed over.  A cell that holds one of
    ``null_values`` is NULL (give ``()`` to keep such words).  A row with fewer
    cells than the header is filled with NULL; one with more cells fails the
    job with the file's name, since its values cannot be placed.
    """
    if not paths:
        raise FileNotFoundError("no CSV files given")
    groups = header_groups(spark, paths)
    if not groups:
        raise ValueError("every CSV file given is empty")
    every = [p for files in groups.values() for p in files]
    broken = {_same_path(p): p for p in files_with_broken_quotes(spark, every)} if multi_line is None else {}
    frames = []
    for header, files in groups.items():
        names = add_pandas_index_names(list(header))
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, _EXTRA]])

        def by_lines(files, whole):
            df = (spark.read.options(**CSV_OPTIONS).option("enforceSchema", "true")
                  .option("multiLine", "true" if whole else "false").schema(schema).csv(files).withColumn("_file", F.col("_metadata.file_path")))
            return checked_cells(df, names, F.col(_EXTRA).isNotNull(), null_values, with_file)

        def by_ranges(files):
            sizes = spark.read.format("binaryFile").load(files).select(F.col("_metadata.file_path").alias("path"), "length")
            return checked_cells(csv_records(sizes, names, range_bytes), names, F.col("_cells") > len(names), null_values, with_file)

        cut = [broken[_same_path(p)] for p in files if _same_path(p) in broken]
        packed = [p for p in cut if p.lower().endswith(COMPRESSED)]
        cut = [p for p in cut if p not in packed]
        plain = [p for p in files if _same_path(p) not in broken]
        if plain:
            frames.append(by_lines(plain, bool(multi_line)))
        if packed:
            frames.append(by_lines(packed, True))
        if cut:
            try:
                frames.append(by_ranges(cut))
            except PythonException as exc:
                if not unreadable(exc):
                    raise
                frames.append(by_lines(cut, True))
    return union_by_name(frames, as_text=True)


def extract_customers(spark: SparkSession, root: str, key: str | None = None, as_of=None, **read) -> DataFrame:
    """A given object, else the first ``.csv`` whose path contains
    ``customers`` (any case); light header clean; metadata stamp.  ``read``:
    options of :func:`read_csv_files`."""
    if key:
        path = f"{root.rstrip('/')}/{key}"  # a file, or a folder of part files
        df = clean_headers(read_csv_files(spark, expand_paths(spark, [path], (".csv",)), **read), "light")
        return stamp_metadata(df, SOURCE_SYSTEMS["customers"], path, as_of=as_of)
    else:
        # suffix match is case-sensitive (S5); the name match is not
        listing = list_objects(spark, root, suffix=".csv", ignore_case=False)
        hit = first_match(listing, ["customers"]).collect()
        if not hit:
            raise FileNotFoundError("no customer CSV files found")
        path = hit[0]["path"]
    df = clean_headers(read_csv_files(spark, [path], **read), "light")
    return stamp_metadata(df, SOURCE_SYSTEMS["customers"], path, as_of=as_of)


def extract_call_logs(spark: SparkSession, root: str, prefix: str = "", as_of=None, landing: str | None = None, **read) -> DataFrame:
    """Every ``.csv`` under the prefix whose path contains ``call`` or
    ``logs``; union by name; light clean; stamp.  ``read``: options of
    :func:`read_csv_files`.  ``landing``: a folder the rows go to as Parquet at once;
    every CSV is then parsed one time, and the row count comes from the footers there."""
    listing = list_objects(spark, root, prefix=prefix, suffix=".csv", ignore_case=False)  # suffix match is case-sensitive (S5)
    from tributary.functions.text import path_predicate
    files = [r["path"] for r in listing.where(path_predicate(F.col("path"), contains_any=["call", "logs"]))
             .select("path").orderBy("path").collect()]
    if not files:
        raise FileNotFoundError("no call log CSV files found")
    df = clean_headers(read_csv_files(spark, files, **read), "light")
    location = f"{root.rstrip('/')}/{prefix}" if prefix else f"{root.rstrip('/')}/"
    if landing:
        return stamp_landed(df, landing, SOURCE_SYSTEMS["call_logs"], location, as_of=as_of)
    return stamp_metadata(df, SOURCE_SYSTEMS["call_logs"], location, as_of=as_of)


def convert_csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str | None = None, **read) -> str:
    """K8: CSV -> light header clean -> Snappy Parquet (beside the input by
    default: ``x.csv`` -> ``x.parquet`` folder).  ``csv_path`` may be a file
    or a folder of CSV part files."""
    if parquet_path is None:
        base = csv_path.rstrip("/")
        base = base[:-4] if base.lower().endswith(".csv") else base
        parquet_path = base + ".parquet"
    files = expand_paths(spark, [csv_path], (".csv",))
    df = clean_headers(read_csv_files(spark, files, **read), "light")
    df.write.mode("overwrite").option("compression", "snappy").parquet(parquet_path)
    return parquet_path
