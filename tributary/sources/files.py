"""Object listing and file discovery.

Listing uses the ``binaryFile`` source with only ``path, length,
modificationTime`` selected: the content column is pruned, so no file is
opened, and Spark lists large folders in parallel.  Paths come back as URIs.

``sniff_files`` reads the first line / first character of many files in
parallel tasks (as a rule a few KB each; on, where a file starts with blanks
or a long record) so the CSV reader can group files by header and the JSON
reader by top-level shape.
"""

from __future__ import annotations

import re

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.text import path_predicate

def _norm(c):
    return F.regexp_replace(c, r"^file:(//)?", "")


def _norm_root(root: str) -> str:
    for p in ("file://", "file:"):
        if root.startswith(p):
            root = root[len(p):]
    return root.rstrip("/")


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", suffix: str = "", recursive: bool = True,
    ignore_case: bool = False,
) -> DataFrame:
    """Every file under ``root`` whose path (relative to ``root``)
    starts with ``prefix`` and ends with ``suffix``.

    Output: ``path`` (URI), ``rel_path``, ``name``, ``extension`` (lower
    case, with dot), ``length`` (bytes), ``modified``.
    A missing ``root`` raises ``FileNotFoundError``.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        raw = reader.load(root)
    except Exception as exc:  # AnalysisException PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise FileNotFoundError(f"{root} does not exist") from exc
        raise
    base = _norm_root(root)
    rel = F.regexp_replace(_norm(F.col("path")), "^" + re.escape(base) + "/?", "")
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    out = raw.select(
        "path",
        rel.alias("rel_path"),
        name.alias("name"),
        F.when(name.contains("."), F.lower(F.concat(F.lit("."), F.element_at(F.split(name, r"\."), -1))))
        .otherwise(F.lit("")).alias("extension"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )
    if prefix:
        out = out.where(F.col("rel_path").startswith(prefix))
    if suffix:
        out = out.where(path_predicate(F.col("rel_path"), suffix=suffix, ignore_case=ignore_case))
    return out


def expand_paths(spark: SparkSession, paths: list[str], extensions: tuple[str, ...] | None = None) -> list[str]:
    """Files behind a list of file and/or folder paths (folders are listed
    recursively), optionally only those with one of ``extensions`` (case
    ignored).  One listing job; content is never read."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
               .select("path"))
    out = sorted(r["path"] for r in listing.collect())  # one row per file
    if extensions:
        exts = tuple(e.lower() for e in extensions)
        out = [p for p in out if p.lower().endswith(exts)]
    return out


def find_files(
    spark: SparkSession, directory: str, extensions: tuple[str, ...] = (".csv",),
    name_contains: str | list[str] | None = None, recursive: bool = False, ignore_case: bool = True,
) -> list[str]:
    """Files in ``directory`` with one of ``extensions`` (case ignored
    unless ``ignore_case=False``), optionally whose name contains any of
    ``name_contains`` (case always ignored).  Raises ``FileNotFoundError``
    when the folder is missing or nothing matches.  Returns sorted paths: a
    file list is metadata, the same list Spark's own file index keeps on the
    driver.
    """
    listing = list_objects(spark, directory, recursive=recursive)
    if ignore_case:
        listing = listing.where(F.col("extension").isin([e.lower() for e in extensions]))
    else:
        listing = listing.where(F.element_at(F.split(F.col("name"), r"\."), -1).isin([e.lstrip(".") for e in extensions])
                                & F.col("name").contains("."))
    if name_contains:
        subs = [name_contains] if isinstance(name_contains, str) else list(name_contains)
        listing = listing.where(path_predicate(F.col("name"), contains_any=subs))
    paths = sorted(r["path"] for r in listing.select("path").collect())
    if not paths:
        raise FileNotFoundError(f"no {'/'.join(extensions)} files found in {directory}")
    return paths


def extract_csv_files(spark: SparkSession, directory: str, name_contains: str | None = None) -> list[str]:
    """``*.csv`` files of a folder (suffix case-sensitive), optionally
    whose name contains a substring (any case)."""
    return find_files(spark, directory, (".csv",), name_contains, ignore_case=False)


def fetch_files(spark: SparkSession, directory: str) -> list[str]:
    """CSV and JSON files in a folder, extension case ignored."""
    return find_files(spark, directory, extensions=(".csv", ".json"))


def first_match(listing: DataFrame, contains_any: list[str]) -> DataFrame:
    """The first file (by path) whose path contains any substring,
    ignoring case.  The order is defined here, not left to the store."""
    return listing.where(path_predicate(F.col("path"), contains_any=contains_any)).orderBy("path").limit(1)


def objects_by_prefix(listing: DataFrame, prefixes: list[str]) -> DataFrame:
    """Object count and total bytes per top-level prefix; one pass,
    with ``bool`` ``empty`` for prefixes with no object."""
    tagged = listing.select(
        F.element_at(F.split(F.col("rel_path"), "/"), 1).alias("prefix"), "length",
    ).where(F.col("prefix").isin(prefixes))
    counts = tagged.groupBy("prefix").agg(
        F.count(F.lit(1)).cast("long").alias("objects"), F.sum("length").cast("long").alias("bytes"),
    )
    wanted = listing.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    return (
        wanted.join(counts, "prefix", "left")
        .select("prefix", F.coalesce("objects", F.lit(0)).alias("objects"),
                F.coalesce("bytes", F.lit(0)).alias("bytes"))
        .withColumn("empty", F.col("objects") == 0)
    )


def first_objects(listing: DataFrame, prefix: str, n: int = 5) -> DataFrame:
    """The first ``n`` objects under a prefix, by path."""
    return listing.where(F.col("rel_path").startswith(prefix)).orderBy("rel_path").limit(n)


# The prefixes checked before a warehouse load, and the one
# whose first objects are listed.
LANDING_PREFIXES = ("agents", "call_logs")
SAMPLED_PREFIX = "call_logs"


def verify_landing(spark: SparkSession, root: str, prefixes=LANDING_PREFIXES, sample_prefix: str = SAMPLED_PREFIX,
                   n: int = 5) -> dict:
    """Before loading, count objects and bytes per prefix (A8), warn on
    empty prefixes, and list the first ``n`` objects of one prefix (L5)
    with their size in MB (X20).  One listing, two small aggregates."""
    import logging

    from tributary.functions.text import bytes_to_mb

    log = logging.getLogger(__name__)
    listing = list_objects(spark, root)
    summary = objects_by_prefix(listing, list(prefixes))
    rows = summary.collect()  # one row per prefix
    for r in rows:
        if r["empty"]:
            log.warning("No objects found in %s/", r["prefix"])
        else:
            log.info("Found %d objects in %s/", r["objects"], r["prefix"])
    sample = first_objects(listing, sample_prefix, n).select(
        "rel_path", "length", bytes_to_mb("length").alias("size_mb"))
    return {"summary": summary, "sample": sample, "all_present": all(not r["empty"] for r in rows)}


# ---------------------------------------------------------------------------
# distributed sniffing of file heads
# ---------------------------------------------------------------------------

# What the error says when Arrow cannot open a path's store at all.
UNREADABLE = ("Unrecognized filesystem", "libhdfs", "libjvm")
SNIFF_SCHEMA = "path string, size long, first_line string, first_char string, json_lines boolean"


def _make_sniffer():
    """Build the per-partition sniffing function.

    Defined as a closure so it is shipped to Python workers by value: the
    workers need pandas and pyarrow, not this package.
    """

    def chunks(path: str):
        from urllib.parse import unquote

        import pyarrow.fs as pafs

        if path.startswith("file:"):
            local = path[len("file:"):]
            while local.startswith("//"):
                local = local[1:]
            fs, inner = pafs.LocalFileSystem(), unquote(local) if "%" in local else local
        elif "://" not in path:
            fs, inner = pafs.LocalFileSystem(), path
        else:
            # Hadoop scheme names -> Arrow's (s3a/s3n -> s3, abfss -> abfs)
            for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://"), ("abfss://", "abfs://")):
                if path.startswith(hadoop):
                    path = arrow + path[len(hadoop):]
            fs, inner = pafs.FileSystem.from_uri(path)
        step = 4096  # a header is a few hundred bytes: start small, grow
        with fs.open_input_stream(inner) as fh:
            while chunk := fh.read(step):
                yield chunk
                step = min(step * 2, 1 << 20)

    def first_record(source) -> tuple[str | None, int]:
        """The first line that isn't blank (a quoted cell may hold line
        breaks), however far into the file it starts or ends."""
        import re

        data, read = b"", 0
        for chunk in source:
            read += len(chunk)
            data = (data + chunk).lstrip(b"\xef\xbb\xbf" if read == len(chunk) else b"").lstrip(b" \t\r\n")
            quoted = False
            for m in re.finditer(rb'"|\r\n|[\r\n]', data):
                if m[0] == b'"':
                    quoted = not quoted
                elif not quoted:
                    return data[:m.start()].decode("utf-8", errors="replace"), read
        return (data.decode("utf-8", errors="replace").rstrip("\r\n") or None), read

    def json_shape(source) -> tuple[str | None, bool]:
        """First character that isn't blank, and whether the file is JSON Lines:
        objects that each stand on one line.  A lone object on one line is a
        record if any of its values is not an object (else the values are the
        records).  Reads on until that is settled; memory is one chunk."""
        import re

        first, depth, quoted, escaped, expects, plain, closed = None, 0, False, False, False, False, False
        bom = True
        for chunk in source:
            if bom:
                chunk, bom = chunk[3:] if chunk.startswith(b"\xef\xbb\xbf") else chunk, False
            if first is None:
                body = chunk.lstrip(b" \t\r\n")
                if not body:
                    continue
                first = chr(body[0]) if body[0] < 128 else "?"
                if first != "{":
                    return first, False
                chunk = body
            for m in re.finditer(rb"[^ \t]", chunk):
                c = m[0]
                if closed:
                    if c in b"\r\n":
                        continue
                    return first, True          # something follows the first object
                if quoted:
                    if escaped:
                        escaped = False
                    elif c == b"\\":
                        escaped = True
                    elif c == b'"':
                        quoted = False
                    continue
                if c in b"\r\n":
                    return first, False         # the object goes on on the next line
                if expects:
                    expects = False
                    plain = plain or c != b"{"
                if c == b'"':
                    quoted = True
                elif c in b"{[":
                    depth += 1
                elif c in b"}]":
                    depth -= 1
                    closed = depth == 0
                elif c == b":" and depth == 1:
                    expects = True
        return first, closed and plain

    def sniff(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                line, read = first_record(chunks(p))
                first, lines = json_shape(chunks(p)) if line and line.lstrip()[:1] in "{[" else (line.lstrip()[:1] or None if line else None, False)
                rows.append((p, read, line, first, lines))
            yield pd.DataFrame(rows, columns=["path", "size", "first_line", "first_char", "json_lines"])

    return sniff


def same_path(path: str) -> str:
    """One spelling of a path: listings and file metadata write local URIs differently."""
    from urllib.parse import unquote

    return re.sub("^file:/*", "/", unquote(path))


def unreadable(exc: Exception) -> bool:
    """Whether a task's Python failed because Arrow has no reader for the path's store."""
    return any(w in str(exc) for w in UNREADABLE)


def sniff_heads(spark: SparkSession, paths: list[str]) -> list[dict]:
    """``sniff_files`` collected (one small row per file).

    Where Arrow has no reader for the paths' store (``UNREADABLE``), Spark's
    own text source finds the same in one job over all files; any other error
    is raised."""
    try:
        return [r.asDict() for r in sniff_files(spark, paths).collect()]
    except PythonException as exc:
        if not unreadable(exc):
            raise
        return [r.asDict() for r in sniff_through_spark(spark, paths).collect()]


def sniff_through_spark(spark: SparkSession, paths: list[str]) -> DataFrame:
    """What :func:`sniff_files` tells, from Spark's text source (a header must
    stand on one line): the first lines by position in the file, aggregated
    with map-side partials."""
    lines = (spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                                           F.monotonically_increasing_id().alias("n"), "value")
             .where(F.regexp_replace("value", "[ \\t\ufeff]", "") != ""))
    first = lines.groupBy("path").agg(F.min_by("value", F.struct("at", "n")).alias("first_line"), F.count("*").alias("n"))
    text = F.regexp_replace("first_line", "^[ \\t\ufeff]+", "")
    record = F.try_parse_json(text)
    kind = F.schema_of_variant(record)
    entries = F.map_values(F.from_json(text, "map<string,string>"))
    plain = F.exists(entries, lambda v: v.isNull() | ~v.startswith("{"))
    is_lines = kind.startswith("OBJECT") & ((F.col("n") > 1) | F.coalesce(plain, F.lit(False)))
    found = first.select("path", F.lit(None).cast("long").alias("size"), text.alias("first_line"), F.substring(text, 1, 1).alias("first_char"),
                         F.coalesce(is_lines, F.lit(False)).alias("json_lines"))
    every = spark.read.format("binaryFile").load(paths).select("path")
    norm = lambda c: F.regexp_replace(c, "^([a-z0-9]+:)/+", "$1/")  # noqa: E731  file:/x and file:///x
    return (every.join(found.withColumnRenamed("path", "p"), norm(F.col("path")) == norm(F.col("p")), "left")
            .select("path", "size", "first_line", "first_char", F.coalesce("json_lines", F.lit(False)).alias("json_lines")))


def sniff_files(spark: SparkSession, paths: list[str] | DataFrame) -> DataFrame:
    """First line that isn't blank, first character that isn't blank and
    whether a file is JSON Lines, read in parallel tasks.  Each file is read
    as far as that takes, a few KB for all but odd ones."""
    if isinstance(paths, DataFrame):
        df = paths.select("path")
    else:
        import pandas as pd

        df = spark.createDataFrame(pd.DataFrame({"path": list(paths)}), "path string")
    try:
        n = spark.sparkContext.defaultParallelism
    except Exception:  # no SparkContext handle (e.g. a remote session)
        n = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    df = df.repartition(max(1, n), "path")
    return df.mapInPandas(_make_sniffer(), SNIFF_SCHEMA)
