"""Atomic replacement.

A versioned table writes every change into a folder of its own and then adds a
snapshot, a small file that names the folders which make up the table.
Readers take the newest snapshot, so they see the table before or after a
change, never between; a write that dies leaves folders no snapshot names.

    <path>/data/__version=<id>[/<partition folders>]/part-....parquet
    <path>/_snapshots/<number>.json

A snapshot appears by a rename that fails where the number is taken: of two
writers that began at one snapshot the second adds its change to the first's.
This needs a file system that renames atomically (HDFS, local); on an object
store without it, keep to one writer a table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tributary.sinks.lake import write_parquet

VERSION = "__version"
STAMP = "%Y%m%dT%H%M%S"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the table's snapshots, oldest first."""
    folder, fs = _path(spark, f"{path}/_snapshots")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def read_snapshot(spark: SparkSession, path: str, number: int) -> dict:
    file, fs = _path(spark, f"{path}/_snapshots/{number:012d}.json")
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _add_snapshot(spark: SparkSession, path: str, number: int, content: dict) -> bool:
    """Whether the snapshot now exists by this call; False where the number was taken."""
    tmp, fs = _path(spark, f"{path}/_snapshots/.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(json.dumps(content).encode("utf-8")))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    final = hadoop.Path(f"{path}/_snapshots/{number:012d}.json")
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(tmp, final, spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
    except Py4JJavaError as exc:
        if exc.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        fs.delete(tmp, False)
        return False
    return True


def _written(spark: SparkSession, path: str, version: str, depth: int) -> list[str]:
    """Partition folders of a version (``""`` for a table without partitions)."""
    base = f"{path}/data/{VERSION}={version}"
    if not depth:
        return [""]
    pattern, fs = _path(spark, base + "/*=*" * depth)
    return sorted("/".join(s.getPath().toString().rstrip("/").split("/")[-depth:]) for s in fs.globStatus(pattern) or [])


def _merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    kinds = {f.name: f.dataType for f in old}
    for f in new:
        if kinds.get(f.name, f.dataType) != f.dataType:
            raise TypeError(f"column {f.name}: {kinds[f.name].simpleString()} stored, {f.dataType.simpleString()} written")
    return T.StructType([*old, *(f for f in new if f.name not in kinds)])


def write_version(df: DataFrame, path: str, partition_cols: list[str] | tuple[str, ...] = (), mode: str = "replace") -> dict:
    """Write ``df`` as the table's next snapshot; returns ``status``, ``path``, ``rows``, ``snapshot``.

    ``mode``: ``replace`` (``df`` is the whole table), ``partitions`` (the partitions
    ``df`` holds are replaced, all of them at once; columns new to the table are
    added).  A snapshot lists one folder a partition, which is what passes
    through the driver."""
    if mode not in ("replace", "partitions") or (mode == "partitions" and not partition_cols):
        raise ValueError(f"mode {mode!r} with partition columns {list(partition_cols)}")
    spark, cols = df.sparkSession, list(partition_cols)
    version = f"{dt.datetime.now(dt.timezone.utc).strftime(STAMP)}-{uuid.uuid4().hex[:12]}"
    done = write_parquet(df, f"{path}/data/{VERSION}={version}", cols, mode="overwrite")
    parts = _written(spark, path, version, len(cols))
    while True:
        seen = snapshots(spark, path)
        old = read_snapshot(spark, path, seen[-1]) if seen else None
        folders, schema = {}, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        if mode == "partitions" and old is not None:
            if old["partition_cols"] != cols:
                raise ValueError(f"the table is partitioned by {old['partition_cols']}")
            folders = dict(old["folders"])
            schema = _merged_schema(T.StructType.fromJson(old["schema"]), schema)
        folders.update({p: version for p in parts})
        number = seen[-1] + 1 if seen else 1
        if _add_snapshot(spark, path, number, {"schema": schema.jsonValue(), "partition_cols": cols, "folders": folders}):
            return {"status": "success", "path": path, "rows": done["rows"], "snapshot": number}


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table at a snapshot, the newest if none is named.  Filters on partition
    columns prune folders.  A plan made before a later write goes on reading its own snapshot."""
    if number is None:
        seen = snapshots(spark, path)
        if not seen:
            raise FileNotFoundError(f"no snapshot of a table at {path}")
        number = seen[-1]
    told = read_snapshot(spark, path, number)
    schema = T.StructType.fromJson(told["schema"])
    if not told["folders"]:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/data/{VERSION}={v}" + (f"/{p}" if p else "") for p, v in told["folders"].items()]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*paths).select(*[f"`{f.name}`" for f in schema])


def vacuum(spark: SparkSession, path: str, keep: int = 2, older_than_hours: float = 24) -> list[str]:
    """Drop what the last ``keep`` snapshots don't name: older snapshots and the versions
    only they hold, and leftovers of dead writes.  A version younger than
    ``older_than_hours`` stays, since its write may not have ended.  Returns the versions dropped."""
    seen = snapshots(spark, path)
    used = {v for n in seen[-keep:] for v in read_snapshot(spark, path, n)["folders"].values()}
    for n in seen[:-keep]:
        file, fs = _path(spark, f"{path}/_snapshots/{n:012d}.json")
        fs.delete(file, False)
    before = (dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=older_than_hours)).strftime(STAMP)
    data, fs = _path(spark, f"{path}/data")
    dropped = []
    for s in fs.listStatus(data) if fs.exists(data) else []:
        version = s.getPath().getName().removeprefix(f"{VERSION}=")
        if version not in used and version.split("-")[0] <= before:
            fs.delete(s.getPath(), True)
            dropped.append(version)
    return sorted(dropped)
