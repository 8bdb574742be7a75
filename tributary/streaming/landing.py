"""New-file landing as Structured Streaming.

A file source stream with an explicit all-text schema reads each new file
exactly once; the checkpoint records which files were taken, so a re-run
with the same checkpoint adds nothing.  Rows go to the ``year/month/day`` of
their file's date through the partitioned Parquet file sink in **append**
mode: a late file for a day already landed adds its rows and keeps the
earlier ones (a dynamic overwrite per micro-batch would erase them).

One header shape per stream (fact F1): the schema names come from the first
file's header (or are passed in), and every file of the stream must have
them in that order — checked before each start by sniffing the headers in
parallel (``check_one_header_shape``); a folder mixing shapes is refused.  Run with ``trigger(availableNow=True)`` for scheduled
catch-up, or a processing-time trigger for continuous landing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.dates import as_date_literal, date_parts
from tributary.operators.columns import add_pandas_index_names, cleaned_names
from tributary.plans.landing import file_date
from tributary.session import scratch_path
from tributary.sinks.lake import PARTITION_COLS
from tributary.sources.csvsrc import CSV_OPTIONS, NULL_VALUES, checked_cells, parse_header
from tributary.sources.files import list_objects, sniff_files, sniff_heads


def header_schema(spark: SparkSession, landing_dir: str, glob: str = "*.csv") -> T.StructType:
    """All-text schema named after the first CSV file's header (by path)."""
    first = list_objects(spark, landing_dir).where(F.col("name").like(glob.replace("*", "%"))).orderBy("path").limit(1).collect()
    if not first:
        raise FileNotFoundError(f"no CSV files in {landing_dir}")
    line = sniff_heads(spark, [first[0]["path"]])[0]["first_line"]
    names = add_pandas_index_names(parse_header(line))
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


class JsonShapeError(ValueError):
    """A landing folder holds JSON files that one stream cannot read alike."""


def json_shape(spark: SparkSession, landing_dir: str, glob: str = "*.json") -> str:
    """``array`` or ``lines``: the shape of all JSON files in the folder, empty ones aside.
    Object documents and mixed shapes are refused (the batch reader takes them)."""
    listing = list_objects(spark, landing_dir).where(F.col("name").like(glob.replace("*", "%")))
    if listing.limit(1).count() == 0:
        raise FileNotFoundError(f"no JSON files in {landing_dir}")
    shape = (F.when(F.col("first_char") == "[", "array").when(F.col("json_lines"), "lines")
             .when(F.col("first_char") == "{", "object").otherwise("scalar"))
    found = (sniff_files(spark, listing).where(F.col("first_char").isNotNull())
             .groupBy(shape.alias("shape")).agg(F.min("path").alias("example"), F.count("*").alias("n")).collect())
    if [r["shape"] for r in found] not in (["array"], ["lines"], []):
        detail = ", ".join(f"{r['n']} {r['shape']} (e.g. {r['example']})" for r in found)
        raise JsonShapeError(f"a JSON stream reads arrays of records or JSON Lines, one of them; found {detail}")
    return found[0]["shape"] if found else "array"


def json_schema(spark: SparkSession, landing_dir: str, glob: str = "*.json", shape: str | None = None) -> T.StructType:
    """All-text schema of all JSON files in the folder, merged (columns of any file)."""
    shape = shape or json_shape(spark, landing_dir, glob)
    return (spark.read.option("multiLine", "true" if shape == "array" else "false").option("primitivesAsString", "true")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", glob).json(landing_dir).schema)


CORRUPT = "_corrupt_record"


def land_json_stream(
    spark: SparkSession, landing_dir: str, target_path: str, checkpoint_path: str | None = None,
    schema: T.StructType | None = None, as_of=None, available_now: bool = True, glob: str = "*.json",
    dead_letter_path: str | None = None,
):
    """T1 for JSON drops that are arrays of records or JSON Lines (nested
    objects kept as structs); a folder with other or mixed shapes is refused.
    Without ``schema`` the columns are those of all files present at the
    start, so a column that first comes with a later file is landed from the
    next start on; name it in ``schema`` to have it at once.  Text that is not
    JSON fails the stream with the file's name, or goes to ``dead_letter_path``
    (see :func:`land_csv_stream`).  Same exactly-once and append semantics as ``land_csv_stream``."""
    shape = json_shape(spark, landing_dir, glob)
    schema = schema or json_schema(spark, landing_dir, glob, shape)
    names = [f.name for f in schema.fields if f.name != CORRUPT]
    schema = T.StructType([f for f in schema.fields if f.name != CORRUPT] + [T.StructField(CORRUPT, T.StringType(), True)])

    def stream():
        return (spark.readStream.format("json").option("multiLine", "true" if shape == "array" else "false").option("recursiveFileLookup", "true")
                .option("pathGlobFilter", glob).option("columnNameOfCorruptRecord", CORRUPT).schema(schema).load(landing_dir))

    return _land(stream, names, F.col(CORRUPT).isNotNull(), "a record is not JSON", [F.col(f"`{n}`") for n in names],
                 target_path, checkpoint_path or scratch_path(spark, "landing-ckpt"), as_of, available_now, dead_letter_path)


def _land(stream, names, bad, reason, cells, target_path, checkpoint_path, as_of, available_now, dead_letter_path):
    """Start the landing of the rows that fit and, with ``dead_letter_path``, a second stream of those that don't."""
    fallback = as_date_literal(as_of or _dt.datetime.now(_dt.timezone.utc).date())
    file = F.col("_metadata.file_path")
    day = F.coalesce(file_date(file), fallback)
    told = F.raise_error(F.concat(F.lit(reason + ": "), file)).cast("boolean")
    rows = stream()
    fits = rows.where(~bad) if dead_letter_path else rows.where(F.when(bad, told).otherwise(F.lit(True)))
    out = fits.select(*[c.alias(n) for c, n in zip(cells, cleaned_names(names, "light"))], *date_parts(day))
    writer = out.writeStream.format("parquet").outputMode("append").partitionBy(*PARTITION_COLS).option("checkpointLocation", checkpoint_path)
    writers = [(writer, target_path)]
    if dead_letter_path:
        dead = stream().where(bad).select(file.alias("file"), F.lit(reason).alias("reason"), F.col(CORRUPT).alias("record"),
                                          F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])).alias("parsed"))
        writers.append((dead.writeStream.format("parquet").outputMode("append")
                        .option("checkpointLocation", checkpoint_path.rstrip("/") + "-dead-letter"), dead_letter_path))
    queries = []
    for w, path in writers:
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        queries.append(w.start(path))
    if available_now:
        for q in queries:
            q.awaitTermination()
    return queries[0]


class HeaderShapeError(ValueError):
    """A landing folder holds CSV files with different headers (fact F1)."""


def check_one_header_shape(spark: SparkSession, landing_dir: str, modified_after=None, glob: str = "*.csv") -> str:
    """Sniff the CSV headers in the folder (in parallel, a few KB per file)
    and fail when they differ: a stream binds columns by position, so one
    odd file would be silently misread.  ``modified_after`` limits the check
    to recent files in a long-lived landing folder."""
    listing = list_objects(spark, landing_dir).where(F.col("name").like(glob.replace("*", "%")))
    if modified_after is not None:
        listing = listing.where(F.col("modified") > F.lit(modified_after).cast("timestamp"))
    # one row per distinct header comes back, however many files there are
    heads = (sniff_files(spark, listing).where(F.length("first_line") > 0).groupBy("first_line")
             .agg(F.count("*").alias("n"), F.min("path").alias("example")).limit(20).collect())
    if len(heads) > 1:
        detail = "; ".join(f"{r['first_line']!r}: {r['n']} file(s), e.g. {r['example']}" for r in heads)
        raise HeaderShapeError(f"one header shape per stream; found {len(heads)}: {detail}")
    return heads[0]["first_line"] if heads else ""


def land_csv_stream(
    spark: SparkSession, landing_dir: str, target_path: str, checkpoint_path: str | None = None,
    schema: T.StructType | None = None, as_of=None, available_now: bool = True,
    max_files_per_trigger: int | None = None, check_headers: bool = True, check_modified_after=None,
    null_values: tuple[str, ...] = NULL_VALUES, dead_letter_path: str | None = None, glob: str = "*.csv",
):
    """Start (and with ``available_now`` finish) the landing stream.

    Returns the ``StreamingQuery``; with ``available_now`` it has already
    processed every file present at start.  ``check_headers`` refuses to
    start when the folder's CSV files do not share one header; a file that
    comes later with another header fails the stream (its names are held
    against the schema's) unless the header has blank names.

    Rows are treated as ``read_csv_files`` treats them: quoted cells may hold
    line breaks (a file is one task), missing words are NULL, a short row is
    filled with NULL.  A row with more cells than the header fails the stream
    with the file's name; with ``dead_letter_path`` it is appended there
    instead (``file``, ``reason``, ``record``: the row's text, ``parsed``: what was read of it) by a second
    stream with its own checkpoint beside the first, so no cell is lost and a
    re-run adds nothing.  :func:`replay_dead_letters` reads them with more columns.
    """
    if check_headers:
        check_one_header_shape(spark, landing_dir, check_modified_after, glob)
    schema = schema or header_schema(spark, landing_dir, glob)
    names = schema.names
    wide = T.StructType([*(T.StructField(n, T.StringType(), True) for n in names), T.StructField("__more", T.StringType(), True)])

    def stream():
        reader = (
            spark.readStream.format("csv").options(**CSV_OPTIONS).option("multiLine", "true")
            .option("enforceSchema", "true" if any(n.startswith("Unnamed: ") for n in names) else "false")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)]))
        )
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(landing_dir)

    # a record of another length is kept as text too: only one with cells beyond the header does not fit
    bad = F.coalesce(F.from_csv(F.col(CORRUPT), _ddl(wide), CSV_PARSE).getField("__more").isNotNull(), F.lit(False))
    cells = [F.when(~F.col(f"`{n}`").isin(*null_values), F.col(f"`{n}`")) if null_values and isinstance(schema[n].dataType, T.StringType) else F.col(f"`{n}`") for n in names]
    return _land(stream, names, bad, "a row has more cells than the header", cells, target_path,
                 checkpoint_path or scratch_path(spark, "landing-ckpt"), as_of, available_now, dead_letter_path)


CSV_PARSE = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def replay_dead_letters(spark: SparkSession, dead_letter_path: str, names: list[str], null_values: tuple[str, ...] = NULL_VALUES):
    """Dead CSV rows read again with the widened header ``names``: ``_file`` and the
    columns.  A row that is still longer fails with its file's name."""
    wide = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, "__more"]])
    rows = spark.read.parquet(dead_letter_path).select(F.col("file").alias("_file"), F.from_csv("record", _ddl(wide), CSV_PARSE).alias("r")).select("_file", "r.*")
    return checked_cells(rows, names, F.col("__more").isNotNull(), null_values, True)
