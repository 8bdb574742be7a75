"""A manifest of landed files.

The manifest is a Parquet table with one row per file version seen: path,
size, time of change, header and shape.  An update lists the landing folder
level by level in tasks, keeps what the manifest does not hold yet, opens only
those files, and adds them as a batch.  Neither the listing nor the files of a
batch pass through the driver: CSV files are read by byte ranges straight from
the manifest's rows, one read per header shape.

A batch stays pending until ``mark_landed`` names it, so a run that dies
between update and landing finds its files again.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.operators.columns import add_pandas_index_names
from tributary.operators.union import union_by_name
from tributary.session import scratch_path
from tributary.sources.byteranges import csv_records, dealt
from tributary.sources.csvsrc import NULL_VALUES, checked_cells, parse_header
from tributary.sources.files import list_objects, sniff_files, sniff_through_spark, unreadable

SCHEMA = "path string, length long, modified timestamp, first_line string, first_char string, json_lines boolean, batch string"
SHAPES = 1000              # header shapes read in one plan; more are read in groups of as many


def _lister():
    def ls(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs

        names = ["path", "length", "modified", "folder"]
        types = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]
        for b in batches:
            for base in b.column(0).to_pylist():
                base = base.rstrip("/")
                if base.startswith("file:"):
                    inner = "/" + base[len("file:"):].lstrip("/")
                    fs, base = pafs.LocalFileSystem(), "file://" + inner
                elif "://" not in base:
                    fs, inner, base = pafs.LocalFileSystem(), base, "file://" + base
                else:
                    uri = base
                    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://"), ("abfss://", "abfs://")):
                        uri = arrow + base[len(hadoop):] if base.startswith(hadoop) else uri
                    fs, inner = pafs.FileSystem.from_uri(uri)
                found = fs.get_file_info(pafs.FileSelector(inner, recursive=False))
                rows = [(f"{base}/{f.base_name}", f.size or 0, f.mtime, f.type == pafs.FileType.Directory)
                        for f in found if not f.base_name.startswith(("_", "."))]
                for at in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[at:at + 10_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return ls


def list_in_tasks(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """``path``, ``length``, ``modified`` of every file under ``root`` whose name ends
    with ``suffix``: a folder is listed by a task, one job per level of folders.
    Names that begin with ``_`` or ``.`` are passed over, as Spark does.  Where
    the tasks' Python has no reader for the store, Spark's own listing is used."""
    schema = "path string, length long, modified timestamp, folder boolean"
    level, levels = spark.createDataFrame([(root,)], "path string"), []
    try:
        while True:
            path = scratch_path(spark, "listing")
            dealt(level).mapInArrow(_lister(), schema).write.parquet(path)
            found = spark.read.schema(schema).parquet(path)
            levels.append(found.where("not folder").drop("folder"))
            level = found.where("folder").select("path")
            if level.isEmpty():
                break
    except PythonException as exc:
        if not unreadable(exc):
            raise
        levels = [list_objects(spark, root).select("path", "length", "modified")]
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.where(F.col("path").endswith(suffix)) if suffix else out


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Every file version seen; no rows before the first update."""
    return _table(spark, f"{manifest}/files", SCHEMA)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def current_files(spark: SparkSession, manifest: str) -> DataFrame:
    """The last version of each path."""
    return read_manifest(spark, manifest).groupBy("path").agg(
        F.max_by(F.struct("length", "modified", "first_line", "first_char", "json_lines", "batch"), F.struct("modified", "length", "batch")).alias("f")).select("path", "f.*")


def update_manifest(spark: SparkSession, root: str, manifest: str, suffix: str = "") -> str | None:
    """Add the files under ``root`` that are new or changed since; only they are
    opened.  Returns the new batch's name, or None when there is nothing new."""
    seen = read_manifest(spark, manifest).select("path", "length", "modified")
    unseen = list_in_tasks(spark, root, suffix).join(seen, ["path", "length", "modified"], "left_anti")
    path = scratch_path(spark, "unseen")
    unseen.write.parquet(path)
    unseen = spark.read.schema("path string, length long, modified timestamp").parquet(path)
    if unseen.isEmpty():
        return None
    batch = uuid.uuid4().hex[:16]

    def add(heads: DataFrame) -> None:
        (unseen.join(heads.select("path", "first_line", "first_char", "json_lines"), "path", "left")
         .withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{manifest}/files/{batch}"))

    try:
        add(sniff_files(spark, unseen))
    except PythonException as exc:
        if not unreadable(exc):
            raise
        add(sniff_through_spark(spark, [r["path"] for r in unseen.select("path").collect()]))
    return batch


def mark_landed(spark: SparkSession, manifest: str, batch: str) -> None:
    spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{manifest}/landed/{batch}")


def pending_files(spark: SparkSession, manifest: str) -> DataFrame:
    """The files of batches that no ``mark_landed`` names; of several versions of a path the last."""
    landed = _table(spark, f"{manifest}/landed", "batch string")
    waiting = read_manifest(spark, manifest).join(landed, "batch", "left_anti")
    last = F.max_by(F.struct("length", "modified", "first_line", "first_char", "json_lines", "batch"), F.struct("modified", "length", "batch"))
    return waiting.groupBy("path").agg(last.alias("f")).select("path", "f.*")


def read_csv_manifest(files: DataFrame, with_file: bool = False, null_values: tuple[str, ...] = NULL_VALUES,
                      range_bytes: int | None = None) -> DataFrame:
    """The CSV files of a manifest's rows (``path``, ``length``, ``first_line``),
    appended by column name: what ``read_csv_files`` gives, without a list of
    paths.  Only the distinct headers come to the driver; empty files are passed over."""
    heads = [r["first_line"] for r in files.where("first_line is not null").select("first_line").distinct().orderBy("first_line").collect()]
    if not heads:
        raise ValueError("every CSV file given is empty")
    frames = []
    for line in heads:
        names = add_pandas_index_names(parse_header(line))
        records = csv_records(files.where(F.col("first_line") == line).select("path", "length"), names, range_bytes)
        frames.append(checked_cells(records, names, F.col("_cells") > len(names), null_values, with_file))
    while len(frames) > SHAPES:
        frames = [union_by_name(frames[i:i + SHAPES], as_text=True) for i in range(0, len(frames), SHAPES)]
    return union_by_name(frames, as_text=True)
