"""The corpus pipeline against a plain version of its stages, over whole small tables."""

import sys
import os

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from conftest import SF001, SF01  # noqa: E402
from test_llm_operators import brute_components, brute_lines  # noqa: E402
from tributary.llm import langid, simhash, suffix_dedup  # noqa: E402
from tributary.llm.common import ship_package  # noqa: E402
from tributary.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES  # noqa: E402


def brute_cut(rows, depth=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw, gone = t.encode(), set()
        for s in range(len(raw) - depth + 1):
            w = raw[s:s + depth]
            if w in seen:
                gone.update(range(s, s + depth))
            else:
                seen.add(w)
        kept, at = [], 0
        for c in t:                                   # a character goes when all its bytes go
            n = len(c.encode())
            if not all(j in gone for j in range(at, at + n)):
                kept.append(c)
            at += n
        out[i] = "".join(kept)
    return out


def test_pipeline_stages(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    by_name = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5

    kept = by_name["language_id"](spark, docs, SF001)
    assert kept.columns == columns
    told = langid.identify(docs, langid.learn_dictionaries(docs.where(~langid.held_out("doc_id")))).collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in told if not r.rejected)

    cut = by_name["line_dedup"](spark, kept, SF001)
    assert cut.columns == columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    got = cut.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, t) for i, _, _, t in brute_lines(rows)), key=str)
    assert all(r.n_chars == len(r.text) for r in got)

    single = by_name["simhash_near_dedup"](spark, cut, SF001)
    assert single.columns == columns
    fps = {r.doc_id: simhash.simhash(r.text) for r in got}
    roots = brute_components(set(fps.values()), 4)
    first = {}
    for i, f in fps.items():
        first[roots[f]] = min(i, first.get(roots[f], i))
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    whole = by_name["suffix_dedup"](spark, single, SF001)
    assert whole.columns == columns
    assert {r.doc_id: r.text for r in whole.collect()} == brute_cut([(r.doc_id, r.text) for r in single.collect()])

    packed = by_name["best_fit_packing"](spark, whole, SF001).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in whole.collect()}
    for seq in {r.sequence_id for r in packed}:
        at = 0
        for off, n in sorted((r.offset, r.length) for r in packed if r.sequence_id == seq):
            assert off == at
            at += n
        assert at <= 1024


def test_pipeline_odd_rows(spark):
    rows = [(1, None, None, "s", 0, "x"), (2, "", "en", None, None, "x"), (None, "the and of that with this", "en", "s", 1, "x"), (4, "the and of that with this and more", "en", "s", 1, "x"),
            (4, "the and of that with this and more", "en", "s", 1, "x"), (5, "der die und das nicht mit", "de", "s", 1, "x")]
    rows += [(100 + i, text + f" {i}", lang, "s", 1, "x") for i in range(12) for text, lang in (("the and of that with this and more", "en"), ("der die und das nicht mit", "de"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, piece string")
    for source in (docs, docs.limit(0)):
        now = source
        for _, f in corpus_pipeline.STAGES[:-1]:
            now = f(spark, now, SF001)
            assert now.columns == docs.columns
        placed = corpus_pipeline.STAGES[-1][1](spark, now, SF001).collect()
        assert bool(placed) == (source is docs)


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_registered_queries_run(spark, name):
    df = LLM_QUERIES[name](spark, SF01)
    rows = df.collect()
    assert rows
    if sql := LLM_ORACLE_SQL.get(name):
        con = duckdb.connect()
        for t in ("documents", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
        cols = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted((tuple(r[c] for c in cols) for r in rows), key=str) == sorted(want, key=str)


def test_suffix_windows_bound():
    assert suffix_dedup.DEPTH - suffix_dedup.GRAM + 1 < 256      # a run's length is kept in a byte


def test_tasks_give_their_memory_back(monkeypatch):
    import ctypes
    from types import SimpleNamespace

    from tributary.llm.common import tidy

    trims = []
    monkeypatch.setattr(ctypes, "CDLL", lambda name: SimpleNamespace(malloc_trim=trims.append))
    assert list(tidy(lambda batches: (2 * b for b in batches))(iter([1, 2, 3]))) == [2, 4, 6] and trims == [0]
    stopped = tidy(iter)([1, 2])
    assert next(stopped) == 1
    stopped.close()                                   # a task that a limit ends early
    assert trims == [0, 0]

    def fails(batches):
        yield from batches
        raise ValueError("told")

    with pytest.raises(ValueError, match="told"):
        list(tidy(fails)([1]))
    assert trims == [0, 0, 0]
    monkeypatch.setattr(ctypes, "CDLL", lambda name: SimpleNamespace())      # another C library
    assert list(tidy(iter)([1])) == [1]


def test_pipeline_operators_tidy_their_tasks(spark, monkeypatch):
    ship_package(spark)
    docs = spark.createDataFrame([(1, "a b c d e f " * 30, "en")], "doc_id long, text string, lang string")
    seen = []
    was = suffix_dedup.tidy
    monkeypatch.setattr(suffix_dedup, "tidy", lambda run: seen.append(run) or was(run))
    suffix_dedup.remove_repeats(docs).collect()
    assert len(seen) == 5
