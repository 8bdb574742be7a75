"""Line deduplication over range-partitioned line hashes.

Every long line of every document becomes a small row ``(hash, document,
positions)``.  The rows are range-partitioned by hash and document and sorted
within the partitions with the largest document first, so one stream over a
partition meets the occurrence to keep first and knows the rest of a line's
rows follow at once.  A line so frequent that its rows span partitions is
settled by one count per partition.  Back to the documents go compressed
bitmaps of the lines to keep, not text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_width, stage, tidy

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
LOWER = {c: c + 32 for c in range(65, 91)}


def line_key(line: str) -> str:
    return line.strip(BLANK).translate(LOWER)


def line_hashes(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """A row per document and distinct long line: 128-bit hash (two longs), document, positions, lines of the document."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            ids, h1, h2, tk, at, lines = [], [], [], [], [], []
            for key, text, t in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                own: dict[bytes, list[int]] = {}
                split = text.as_py().split("\n")
                for i, line in enumerate(split):
                    if len(line) >= min_chars and len(k := line_key(line)) >= min_chars:
                        own.setdefault(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass")), []).append(i)
                for h, where in own.items():
                    ids.append(key)
                    tk.append(t)
                    h1.append(int.from_bytes(h[:8], "big", signed=True))
                    h2.append(int.from_bytes(h[8:], "big", signed=True))
                    at.append(np.asarray(where, "<u4").tobytes())
                    lines.append(len(split))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(ids, b.schema.field(0).type), pa.array(tk, pa.int64()), pa.array(at, pa.binary()), pa.array(lines, pa.int32())],
                names=["h1", "h2", "id", "tk", "at", "n_lines"])

    return (df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col), F.col(text_col), F.xxhash64(text_col).alias("tk"))
            .mapInArrow(tidy(run), f"h1 long, h2 long, id {id_type}, tk long, at binary, n_lines int"))


def _stream(batches, min_docs: int):
    """Decisions over rows sorted by hash, then largest document first.

    kind 0: a row to drop.  A line found in ``min_docs`` documents of this
    partition loses all of them but the largest whatever other partitions
    hold.  Only the first and the last line of a partition can have rows
    elsewhere: of those, the rows not settled here (the largest document's;
    all, if fewer than ``min_docs`` are here) go out as kind 1 and the count
    as kind 2, so at most ``min_docs`` documents of a line a partition."""
    key = first = best = seen = None
    n, waiting = 0, []
    out: list[tuple] = []

    def close(is_last):
        if key is not None and (key == first or is_last):
            out.extend((1, *key, *row, None) for row in waiting)
            out.append((2, *key, best, None, None, None, n))

    def batch(t):
        types = [pa.int32(), pa.int64(), pa.int64(), t, pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        arrays = [pa.array(list(c), ty) for c, ty in zip(zip(*out), types)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "h1", "h2", "id", "tk", "at", "n_lines", "n"])

    kind = None
    for b in batches:
        kind = b.schema.field(2).type
        for h1, h2, *row in zip(*(c.to_pylist() for c in b.columns)):
            if (h1, h2) != key:
                close(False)
                key, best, seen, n, waiting = (h1, h2), row[0], None, 0, []
                first = first or key
            if row[:2] == seen:                    # the same document again
                continue
            if seen is None or row[0] != seen[0]:
                n += 1
                if n == min_docs:
                    out.extend((0, *key, *r, None) for r in waiting if r[0] != best)
                    waiting = [r for r in waiting if r[0] == best]
            seen = row[:2]
            if n < min_docs or row[0] == best:
                waiting.append(row)
            else:
                out.append((0, *key, *row, None))
            if len(out) >= 8192:
                yield batch(kind)
    close(True)
    if out:
        yield batch(kind)


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``id``, ``tk`` (text hash), ``n_lines``, ``n_dropped`` and ``keep`` (zlib-compressed
    bitmap, first line in the highest bit) of every document that loses lines; others keep all.

    A line goes where its key (stripped, A-Z lower-cased, at least ``min_chars``
    code points) is found in ``min_docs`` documents, but for its occurrences in
    the largest id.  Rows of one id count as one document however often they
    repeat; rows with a null id or text take no part and keep everything.
    Empty input gives no bitmaps; columns beside the two are not read."""
    spark = df.sparkSession
    hashes = stage(line_hashes(df, id_col, text_col, min_chars), "line-hashes")
    id_type = hashes.schema["id"].dataType.simpleString()
    dealt = (hashes.repartitionByRange(shuffle_width(spark), "h1", "h2", "id")
             .sortWithinPartitions("h1", "h2", F.desc("id"), "tk"))
    settled = stage(dealt.mapInArrow(tidy(lambda batches: _stream(batches, min_docs)),
                                     f"kind int, h1 long, h2 long, id {id_type}, tk long, at binary, n_lines int, n long"), "line-decisions")
    total = (settled.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("id").alias("best"))
             .where(F.col("docs") >= min_docs))
    edge = settled.where("kind = 1").drop("n").join(total, ["h1", "h2"]).where(F.col("id") != F.col("best"))
    cols = ["id", "tk", "n_lines", "at"]
    dropped = settled.where("kind = 0").select(*cols).unionByName(edge.select(*cols))

    def bitmap(batches):
        for b in batches:
            keep, lost = [], []
            for n, parts in zip(b.column("n_lines").to_pylist(), b.column("parts").to_pylist()):
                bits = np.ones(n, np.uint8)
                for p in parts:
                    bits[np.frombuffer(p, "<u4")] = 0
                lost.append(n - int(bits.sum()))
                keep.append(zlib.compress(np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("tk"), pa.array(b.column("n_lines"), pa.int32()), pa.array(lost, pa.int32()), pa.array(keep, pa.binary())],
                                             names=["id", "tk", "n_lines", "n_dropped", "keep"])

    return (dropped.groupBy("id", "tk").agg(F.max("n_lines").alias("n_lines"), F.collect_list("at").alias("parts"))
            .select("id", "tk", "n_lines", "parts")
            .mapInArrow(tidy(bitmap), f"id {id_type}, tk long, n_lines int, n_dropped int, keep binary"))


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with ``text_col`` cut down to the lines its bitmap keeps and two
    more columns, ``n_lines`` and ``n_dropped``; a null text stays null (one empty line)."""
    names = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    df = df.select(*names)
    b = bitmaps.select(F.col("id").alias("__tributary_id"), F.col("tk").alias("__tributary_tk"), F.col("keep").alias("__tributary_keep"))
    joined = (df.withColumn("__tributary_key", F.xxhash64(text_col))
              .join(b, (F.col(id_col) == F.col("__tributary_id")) & (F.col("__tributary_key") == F.col("__tributary_tk")), "left")
              .select(*names, "__tributary_keep"))
    at = names.index(text_col)

    def cut(batches):
        for rows in batches:
            texts, n_lines, lost = [], [], []
            for text, keep in zip(rows.column(at), rows.column(len(names))):
                lines = (text.as_py() or "").split("\n")
                n_lines.append(len(lines))
                bits = keep.as_py()
                if bits is None:
                    texts.append(text.as_py())
                    lost.append(0)
                    continue
                kept = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8))[:len(lines)].astype(bool).tolist()
                left = [line for line, k in zip(lines, kept) if k]
                texts.append("\n".join(left))
                lost.append(len(lines) - len(left))
            arrays = [rows.column(i) for i in range(len(names))]
            arrays[at] = pa.array(texts, rows.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(n_lines, pa.int64()), pa.array(lost, pa.int64())], names=[*names, "n_lines", "n_dropped"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", n_lines long, n_dropped long"
    return joined.mapInArrow(tidy(cut), schema)


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``df`` without the lines :func:`keep_bitmaps` marks, with ``n_lines`` (before) and ``n_dropped``."""
    return apply_bitmaps(df, keep_bitmaps(df, id_col, text_col, min_chars, min_docs), id_col, text_col)
