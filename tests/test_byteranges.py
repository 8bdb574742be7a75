"""Large CSV and JSON files read by byte ranges, against the csv and json modules."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import write
from tributary.sources import byteranges
from tributary.sources.csvsrc import files_with_broken_quotes, read_csv_files
from tributary.sources.jsonsrc import read_json_files


@pytest.fixture
def few_tasks(monkeypatch):
    monkeypatch.setattr(byteranges, "TASKS", 8)


def sized(spark, path):
    return spark.read.format("binaryFile").load(path).select("path", "length")


def noise(rng, n):
    bits = ['"', '""', ",", "\n", "\r\n", "\r", "a", "é", " ", '"x"', ',"', '",', '\n"', "5\" pipe", "😀"]
    return "".join(rng.choice(bits) for _ in range(n))


@pytest.mark.parametrize("seed", range(12))
def test_every_state_agrees_with_a_scan_from_the_start(seed):
    """Record starts found from any range equal those of one pass over the whole text."""
    _, csv_end, csv_next, _, _ = byteranges._tools()
    rng = random.Random(seed)
    data = noise(rng, 400).encode()
    starts = sorted({csv_next(csv_end(0, data[:at]), iter([data[at:]]), at) for at in range(len(data) + 1)})
    rows = list(csv.reader(io.StringIO(data.decode(), newline="")))
    pieces = [data[a:b].decode() for a, b in zip(starts, starts[1:] + [len(data)])]
    again = [r for p in pieces for r in csv.reader(io.StringIO(p, newline=""))]
    assert again == rows


@pytest.mark.parametrize("size", [1, 3, 17, 100, 10_000])
def test_csv_records_equal_csv_reader(spark, tmp, size, few_tasks):
    rng = random.Random(size)
    files, want = [], []
    for k in range(6):
        body = noise(rng, 60 if size < 10 else 500)
        path = write(f"{tmp}/f{k}.csv", "")
        text = ("﻿" if k == 1 else "") + ("\r\n\n" if k == 2 else "") + "a,b,c\n" + body
        with open(path, "w", newline="", encoding="utf-8") as fh:
            fh.write(text)
        files.append(path)
        rows = [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if r][1:]
        want += [(k, tuple((r[i] or None) if i < len(r) else None for i in range(3)), len(r)) for r in rows]
    got = [(int(r._file[-5]), (r.a, r.b, r.c), r._cells) for r in byteranges.csv_records(sized(spark, files), ["a", "b", "c"], size).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_large_file_is_read_by_many_tasks(spark, tmp):
    path = f"{tmp}/big.csv"
    rows = [(str(i), f"line one of {i}\nline \"two\", {i}" * (1 + i % 3)) for i in range(20_000)]
    with open(path, "w", newline="") as fh:
        csv.writer(fh).writerows([("id", "note"), *rows])
    df = read_csv_files(spark, [path], range_bytes=100_000)
    assert sorted((r.id, r.note) for r in df.collect()) == sorted(rows)
    tasks = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) >= 8 and max(r["count"] for r in tasks) < 10_000


def test_quoted_breaks_need_no_switch(spark, tmp):
    """The default reads what line mode would break, and clean files of the same header by lines."""
    a = write(f"{tmp}/a.csv", 'id,note\n1,"line one\nline two"\n2,NA\n3,\n')
    b = write(f"{tmp}/b b.csv", 'id,note\n4,"plain, quoted"\n')
    c = write(f"{tmp}/c.csv", 'note,id\n5" pipe,5\n"a ""b""\n\nc",6\n')
    got = {r.id: r.note for r in read_csv_files(spark, [a, b, c]).collect()}
    assert got == {"1": "line one\nline two", "2": None, "3": None, "4": "plain, quoted", "5": '5" pipe', "6": 'a "b"\n\nc'}
    assert [p.rsplit("/", 1)[1] for p in files_with_broken_quotes(spark, [a, b, c])] == ["a.csv", "c.csv"]
    files = {r._file.rsplit("/", 1)[1] for r in read_csv_files(spark, [a, b, c], with_file=True).select("_file").collect()}
    assert files == {"a.csv", "b%20b.csv", "c.csv"}
    extra = write(f"{tmp}/x.csv", 'id,note\n1,"two\nlines",more\n')
    with pytest.raises(Exception, match="more cells than the header.*x.csv"):
        read_csv_files(spark, [extra]).collect()
    short = write(f"{tmp}/s.csv", 'id,note\n1\n2,"x\ny"\n')
    assert {r.id: r.note for r in read_csv_files(spark, [short]).collect()} == {"1": None, "2": "x\ny"}


def test_compressed_files_with_quoted_breaks(spark, tmp):
    import gzip

    path = f"{tmp}/a.csv.gz"
    with gzip.open(path, "wt") as fh:
        fh.write('id,note\n1,"line one\nline two"\n')
    import os
    plain = write(f"{tmp}/p/a.csv", 'id,note\n1,x\n')
    assert os.path.exists(path) and files_with_broken_quotes(spark, [path, plain])[0].endswith(".gz")


# --- JSON ---------------------------------------------------------------------------------------

def nested(rng, depth=0):
    kind = rng.choice(["s", "n", "o", "a", "b"] if depth < 3 else ["s", "n"])
    if kind == "s":
        return "".join(rng.choice(['"', "\\", "{", "]", ",", ":", "é", "\n", "x", " ", "😀"]) for _ in range(rng.randint(0, 12)))
    if kind == "n":
        return rng.choice([1, -2.5, 10 ** 20, None])
    if kind == "b":
        return rng.choice([True, False])
    if kind == "o":
        return {f'k{i}"': nested(rng, depth + 1) for i in range(rng.randint(0, 3))}
    return [nested(rng, depth + 1) for _ in range(rng.randint(0, 4))]


@pytest.mark.parametrize("size", [1, 2, 7, 64, 5000])
def test_json_elements_equal_the_json_module(spark, tmp, size, few_tasks):
    rng = random.Random(size)
    files, want = [], []
    for k in range(8):
        values = [nested(rng) for _ in range([0, 1, 5, 12][k % 4])]
        doc = values if k < 4 else {f'k"{i},\\': v for i, v in enumerate(values)}
        path = f"{tmp}/d{k}.json"
        with open(path, "w", encoding="utf-8") as fh:
            json.dump(doc, fh, ensure_ascii=bool(k % 2), indent=[None, 2][k % 2])
        files.append(path)
        want += [(k, None if k < 4 else f'k"{i},\\', json.dumps(v, sort_keys=True)) for i, v in enumerate(values)]
    rows = byteranges.json_elements(sized(spark, files), size).orderBy("_file", "at").collect()
    assert [(int(r._file[-6]), r.key, json.dumps(json.loads(r.value), sort_keys=True)) for r in rows] == want


def records(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True, default=str) for r in df.collect())


@pytest.mark.parametrize("shape", ["array", "object"])
def test_large_documents_land_like_small_ones(spark, tmp, shape, few_tasks):
    rng = random.Random(7)
    recs = [{"id": i, "text": f'he said "{{[,]}}" \\ {i}\n', "by": {"name": f"n{i % 7}", "tags": ["a", "b"][: i % 3]}, **({"late": i / 3} if i % 5 == 0 else {})} for i in range(3000)]
    rng.shuffle(recs)
    path = f"{tmp}/{shape}.json"
    with open(path, "w") as fh:
        json.dump(recs if shape == "array" else {f"r{i}": r for i, r in enumerate(recs)}, fh, indent=1)
    small = read_json_files(spark, [path], split_bytes=1 << 30)
    large = read_json_files(spark, [path], split_bytes=0, range_bytes=4096)
    assert sorted(small.dtypes) == sorted(large.dtypes)
    assert records(small) == records(large.select(*(f"`{c}`" for c in small.columns))) and len(records(large)) == 3000


def test_a_document_that_does_not_end_fails(spark, tmp):
    path = write(f"{tmp}/x.json", '[{"a": 1}, {"a": 2}')
    with pytest.raises(Exception, match="does not end"):
        read_json_files(spark, [path], split_bytes=0).collect()
