"""Large text documents read by many tasks.

A CSV file whose quoted cells hold line breaks, or a JSON document, cannot be
cut at any line.  Here a file is cut into byte ranges.  A first pass notes for
each range what it does to *every* state it could begin in (inside a quoted
cell or not; inside a string or not, and how deep); composing these from the
file's start gives each range its true first state; the second pass then starts
every range at its first true record or element.  A record belongs to the range
it starts in, however far it reaches.  Tasks hold a range and one record.

Files are opened in the tasks through Arrow's file systems.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.session import cut_lineage

RANGE = 32 << 20           # bytes of a range
TASKS = 50_000             # tasks the ranges are dealt to, at most
READ = 1 << 20             # bytes read at once beyond a range's end
RANGE_SCHEMA = "path string, start long, stop long, size long"


def byte_ranges(files: DataFrame, size: int | None = None) -> DataFrame:
    """``path``, ``start``, ``stop``, ``size`` for ``files`` (``path``, ``length``), evenly dealt; an empty file has none."""
    step = int(size or RANGE)
    starts = files.where("length > 0").select("path", F.col("length").cast("long").alias("size"),
                                              F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))).alias("start"))
    return dealt(starts.select("path", "start", F.least(F.col("start") + step, F.col("size")).alias("stop"), "size"), step)


def dealt(rows: DataFrame, step: int | None = None) -> DataFrame:
    """``rows`` round robin over tasks: with ``step`` about as many bytes (``stop - start``) to
    each, without it two rounds of the cluster's tasks; never fewer than the cluster runs
    at once.  (A stated number of partitions: AQE would merge rows as small as these.)"""
    at_once = rows.sparkSession.sparkContext.defaultParallelism
    if step is None:
        n, wanted = rows.count(), 2 * at_once
    else:
        n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("stop") - F.col("start")), F.lit(0))).first()
        wanted = max(at_once, -(-size // step))
    return rows.repartition(max(1, min(n, wanted, TASKS)))


def _tools():
    """The functions the tasks need, as closures: workers need pyarrow, not this package."""
    import re

    def opened(path: str):
        from urllib.parse import unquote

        import pyarrow.fs as pafs

        if path.startswith("file:"):
            local = path[len("file:"):]
            while local.startswith("//"):
                local = local[1:]
            return pafs.LocalFileSystem().open_input_file(unquote(local) if "%" in local else local)
        if "://" not in path:
            return pafs.LocalFileSystem().open_input_file(path)
        for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://"), ("abfss://", "abfs://")):
            if path.startswith(hadoop):
                path = arrow + path[len(hadoop):]
        fs, inner = pafs.FileSystem.from_uri(path)
        return fs.open_input_file(inner)

    # --- CSV: R record start, F field start, U in a bare field, Q in a quoted one,
    # --- E after a quote in a quoted one, C after a bare carriage return
    R, FIELD, U, Q, E, C = range(6)
    opening, bare_end = re.compile(rb'[,\n\r]"'), re.compile(rb"[,\n\r]")
    after = {44: FIELD, 10: R, 13: C}

    def csv_end(state: int, data: bytes) -> int:
        """The state after ``data``."""
        i, n = 0, len(data)
        while i < n:
            if state == Q:
                j = data.find(b'"', i)
                if j < 0:
                    return Q
                i, state = j + 1, E
            elif data[i] == 34 and state != U:
                i, state = i + 1, Q          # opens a field, or is the second of a doubled quote
            else:
                m = opening.search(data, i)
                if not m:
                    return after.get(data[-1], U)
                i, state = m.end(), Q
        return state

    def csv_next(state: int, chunks, at: int) -> int:
        """Where the first record at or after ``at`` starts (the file's end if none does)."""
        if state == R:
            return at
        for data in chunks:
            i, n = 0, len(data)
            while i < n:
                if state == C:
                    return at + i + 1 if data[i] == 10 else at + i
                if state == Q:
                    j = data.find(b'"', i)
                    if j < 0:
                        break
                    i, state = j + 1, E
                elif data[i] == 34 and state != U:
                    i, state = i + 1, Q
                else:
                    m = bare_end.search(data, i)
                    if not m:
                        state = U
                        break
                    i, state = m.end(), after[m[0][0]]
                    if state == R:
                        return at + i
            at += n
        return at

    def csv_body(fh) -> int:
        """Where the first record after the header starts; blanks before the header are passed over."""
        at, mark = 0, b"\xef\xbb\xbf"
        fh.seek(0)
        if fh.read(3) == mark:
            at = 3
        fh.seek(at)
        while data := fh.read(4096):
            body = data.lstrip(b" \t\r\n")
            at += len(data) - len(body)
            if body:
                break

        def onward():
            fh.seek(at)
            while more := fh.read(READ):
                yield more

        return csv_next(FIELD, onward(), at)

    # --- JSON: N outside strings, S in a string, X after a backslash in one
    N, S, X = range(3)
    string_end = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*', re.S)
    token = re.compile(rb'["{}\[\],]')

    def json_scan(state: int, depth: int, data: bytes, want: int | None = None):
        """State and depth after ``data``; with ``want``, the offsets just after an
        opening bracket or a comma that lead to depth ``want``, too."""
        i, n, marks = 0, len(data), []
        while i < n:
            if state == X:
                i, state = i + 1, S
            elif state == S:
                i = string_end.match(data, i).end()
                if i >= n:
                    break
                if data[i] == 92:            # a backslash at the very end
                    i, state = i + 1, X
                else:
                    i, state = i + 1, N
            else:
                m = token.search(data, i)
                if not m:
                    break
                c, i = data[m.start()], m.end()
                if c == 34:
                    state = S
                elif c in b"{[":
                    depth += 1
                    if want == depth:
                        marks.append(i)
                elif c in b"}]":
                    depth -= 1
                    if want == depth + 1:
                        marks.append(-i)     # the container closes
                elif want == depth:
                    marks.append(i)
        return state, depth, marks

    return opened, csv_end, csv_next, csv_body, json_scan


def _composed(effects: DataFrame, step: int) -> DataFrame:
    """``path``, ``start``, ``stop``, ``size``, ``state``, ``depth`` and those at ``stop``, from every range's effect
    (``to``: the state after, ``rise``: the depth gained, for each first state; ``body``: where a CSV
    file's records begin after the header).  One row a range, so a group is a file's size over ``RANGE``; kept, so that the files are scanned for it once."""
    def run(pdf):
        import pandas as pd

        state, depth, rows, body = 0, 0, [], int(pdf["body"].max())
        for r in pdf.sort_values("start").itertuples(index=False):
            then, deeper = int(r.to[state]), depth + int(r.rise[state])
            rows.append((r.path, r.start, r.stop, r.size, state, depth, then, deeper, body))
            state, depth = then, deeper
        return pd.DataFrame(rows, columns=["path", "start", "stop", "size", "state", "depth", "state_after", "depth_after", "body"])

    placed = effects.groupBy("path").applyInPandas(run, RANGE_SCHEMA + ", state int, depth long, state_after int, depth_after long, body long")
    return dealt(cut_lineage(placed), step)


def _effects(ranges: DataFrame, kind: str) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        opened, csv_end, _, csv_body, json_scan = _tools()
        for b in batches:
            for row in b.to_pylist():
                with opened(row["path"]) as fh:
                    fh.seek(row["start"])
                    data = fh.read(row["stop"] - row["start"])
                    body = csv_body(fh) if kind == "csv" and row["start"] == 0 else 0
                if kind == "csv":
                    ends = [(csv_end(s, data), 0) for s in range(6)]
                else:
                    ends = [json_scan(s, 0, data)[:2] for s in range(3)]
                yield pa.RecordBatch.from_pylist([{**row, "to": [e[0] for e in ends], "rise": [e[1] for e in ends], "body": body}], schema=pa.schema(
                    [("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("size", pa.int64()), ("to", pa.list_(pa.int32())), ("rise", pa.list_(pa.int64())), ("body", pa.int64())]))

    return ranges.mapInArrow(run, RANGE_SCHEMA + ", to array<int>, rise array<long>, body long")


def csv_records(files: DataFrame, names: list[str], range_bytes: int | None = None) -> DataFrame:
    """The records of CSV files of one header as text columns ``names`` and ``_file``, ``_cells``.

    ``files``: ``path``, ``length``.  Quoted cells may hold line breaks and
    doubled quotes, as ``csv.reader`` reads them; line ends are ``\\n``,
    ``\\r\\n`` or ``\\r``.  Each file's first record that isn't blank is its
    header and blank records are left out.  ``_cells`` counts a record's cells:
    fewer than ``names`` leaves the rest NULL, the caller judges more.  An
    empty cell is NULL.  A file that ends inside quotes ends its last record there.
    """
    placed = _composed(_effects(byte_ranges(files, range_bytes), "csv"), int(range_bytes or RANGE))
    width = len(names)

    def run(batches):
        import csv
        import io
        import sys

        import pyarrow as pa

        opened, _, csv_next, _, _ = _tools()
        csv.field_size_limit(sys.maxsize)
        out = [*names, "_file", "_cells"]

        def batch(rows, path):
            columns = [pa.array([r[i] or None if i < len(r) else None for r in rows], pa.string()) for i in range(width)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([path] * len(rows), pa.string()), pa.array([len(r) for r in rows], pa.int32())], names=out)

        for b in batches:
            for r in b.to_pylist():
                with opened(r["path"]) as fh:
                    def onward(at, fh=fh):
                        fh.seek(at)
                        while data := fh.read(READ):
                            yield data

                    first = max(r["body"], csv_next(r["state"], onward(r["start"]), r["start"]))
                    last = csv_next(r["state_after"], onward(r["stop"]), r["stop"]) if r["stop"] < r["size"] else r["size"]
                    if first >= last:
                        continue
                    fh.seek(first)
                    raw = fh.read(last - first)
                rows = []
                for cells in csv.reader(io.StringIO(raw.decode("utf-8", errors="replace"), newline="")):
                    if not cells:
                        continue
                    rows.append(cells)
                    if len(rows) == 5000:
                        yield batch(rows, r["path"])
                        rows = []
                if rows:
                    yield batch(rows, r["path"])

    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names) + ", _file string, _cells int"
    return placed.mapInArrow(run, schema)


def json_elements(files: DataFrame, range_bytes: int | None = None) -> DataFrame:
    """``_file``, ``at``, ``key``, ``value``: the elements of top-level arrays (``key``
    NULL) or the entries of top-level objects, as JSON text; ``at`` is the element's
    byte offset, so it orders them.  ``files``: ``path``, ``length``; each holds one document.
    Text that is not JSON fails where it is parsed, or here if its brackets do not close."""
    placed = _composed(_effects(byte_ranges(files, range_bytes), "json"), int(range_bytes or RANGE))

    def run(batches):
        import json
        import re

        import pyarrow as pa

        opened, _, _, _, json_scan = _tools()
        entry = re.compile(rb'\s*("(?:[^"\\]|\\.)*")\s*:', re.S)
        names = ["_file", "at", "key", "value"]

        def batch(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], names=names)

        for b in batches:
            for r in b.to_pylist():
                path = r["path"]
                if r["stop"] == r["size"] and (r["depth_after"] != 0 or r["state_after"] != 0):
                    raise ValueError(f"a JSON document does not end: {path}")
                with opened(path) as fh:
                    fh.seek(r["start"])
                    data = fh.read(r["stop"] - r["start"])
                    state, depth, marks = json_scan(r["state"], r["depth"], data, 1)
                    starts = [m for m in marks if m > 0]
                    if not starts:
                        continue
                    pieces, size = [data], len(data)
                    while marks[-1] > 0 and (more := fh.read(READ)):   # on to the last element's end
                        state, depth, further = json_scan(state, depth, more, 1)
                        pieces.append(more)
                        if further:
                            marks.append(-(size + abs(further[0])))
                        size += len(more)
                data = b"".join(pieces)
                rows, held = [], 0
                for begin, end in zip(marks, marks[1:]):
                    if begin < 0:
                        continue
                    raw = data[begin:abs(end) - 1]
                    m = entry.match(raw)
                    body = (raw[m.end():] if m else raw).strip()
                    if not body:
                        continue                                       # an empty array or object
                    key = json.loads(m[1]) if m else None
                    rows.append((path, r["start"] + begin, key, body.decode("utf-8", errors="replace")))
                    held += len(raw)
                    if len(rows) == 2000 or held > 16 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return placed.mapInArrow(run, "_file string, at long, key string, value string")
