"""The manifest of landed files: incremental, restartable, without path lists."""

import os

from conftest import write
from tributary.sources.csvsrc import read_csv_files
from tributary.sources.manifest import current_files, list_in_tasks, mark_landed, pending_files, read_csv_manifest, read_manifest, update_manifest


def names(df):
    return sorted(r.path.rsplit("/in/", 1)[1] for r in df.select("path").collect())


def test_listing_in_tasks(spark, tmp):
    for n in ("a.csv", "x/b.csv", "x/y/z/c.csv", "x/y/d.CSV", "_SUCCESS", ".h.csv", "_tmp/e.csv", "x/with blank é.csv"):
        write(f"{tmp}/in/{n}", "id\n1\n")
    assert names(list_in_tasks(spark, f"{tmp}/in", ".csv")) == ["a.csv", "x/b.csv", "x/with blank é.csv", "x/y/z/c.csv"]
    rows = list_in_tasks(spark, f"file://{tmp}/in").collect()
    assert len(rows) == 5 and all(r.length == 5 and r.modified is not None for r in rows)


def test_second_update_opens_new_files_only(spark, tmp):
    write(f"{tmp}/in/a.csv", 'id,note\n1,"x\ny"\n')
    write(f"{tmp}/in/d/b.csv", "note,id,more\nNA,2,z\n")
    write(f"{tmp}/in/empty.csv", "")
    first = update_manifest(spark, f"{tmp}/in", f"{tmp}/m", ".csv")
    assert names(pending_files(spark, f"{tmp}/m")) == ["a.csv", "d/b.csv", "empty.csv"]
    got = {(r.id, r.note, r.more) for r in read_csv_manifest(pending_files(spark, f"{tmp}/m"), range_bytes=4).collect()}
    assert got == {("1", "x\ny", None), ("2", None, "z")}
    assert got == {(r.id, r.note, r.more) for r in read_csv_files(spark, [f"{tmp}/in/a.csv", f"{tmp}/in/d/b.csv"]).collect()}
    mark_landed(spark, f"{tmp}/m", first)
    assert update_manifest(spark, f"{tmp}/in", f"{tmp}/m", ".csv") is None
    # an old file that changes unseen would be opened again if the update read old files at all
    stamp = os.stat(f"{tmp}/in/a.csv")
    write(f"{tmp}/in/a.csv", 'XX,note\n1,"x\ny"\n')
    os.utime(f"{tmp}/in/a.csv", ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    write(f"{tmp}/in/c.csv", "id\n3\n")
    second = update_manifest(spark, f"{tmp}/in", f"{tmp}/m", ".csv")
    assert names(pending_files(spark, f"{tmp}/m")) == ["c.csv"]
    heads = {r.path.rsplit("/", 1)[1]: (r.first_line, r.batch) for r in read_manifest(spark, f"{tmp}/m").collect()}
    assert heads == {"a.csv": ("id,note", first), "b.csv": ("note,id,more", first), "empty.csv": (None, first), "c.csv": ("id", second)}


def test_a_run_that_dies_finds_its_files_again(spark, tmp):
    write(f"{tmp}/in/a.csv", "id\n1\n")
    update_manifest(spark, f"{tmp}/in", f"{tmp}/m")          # and never landed
    write(f"{tmp}/in/b.csv", "id\n2\n")
    second = update_manifest(spark, f"{tmp}/in", f"{tmp}/m")
    assert names(pending_files(spark, f"{tmp}/m")) == ["a.csv", "b.csv"]
    mark_landed(spark, f"{tmp}/m", second)
    assert names(pending_files(spark, f"{tmp}/m")) == ["a.csv"]


def test_a_changed_file_is_a_new_version(spark, tmp):
    write(f"{tmp}/in/a.csv", "id\n1\n")
    update_manifest(spark, f"{tmp}/in", f"{tmp}/m")
    write(f"{tmp}/in/a.csv", "id,b\n1,22\n")
    os.utime(f"{tmp}/in/a.csv", (2_000_000_000, 2_000_000_000))
    update_manifest(spark, f"{tmp}/in", f"{tmp}/m")
    assert [r.first_line for r in current_files(spark, f"{tmp}/m").collect()] == ["id,b"]
    assert read_manifest(spark, f"{tmp}/m").count() == 2
