"""The operators of the training-data package against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tributary.llm import ann_onebit, bpe, chat_prefix, iblt, langid, line_dedup, pack_bestfit, simhash, suffix_dedup, url_rules
from tributary.llm.common import ship_package
from tributary.llm.components import components
from tributary.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, ids string, id string, n_lines string").repartition(3)


def plain(rows):
    """Rows with columns whose names clash with those the operators make."""
    return [(i, t, "en", "x", "y", "z") for i, t in rows]


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "same text of a line that is long enough to count here\nshort"),
       (5, "same text of a line that is long enough to count here\nshort"), (5, "same text of a line that is long enough to count here\nshort"),
       (None, "same text of a line that is long enough to count here"), (7, "Ünïcödé 😀 \r\n x" * 30), (8, "a" * 30_000)]


# --- op1 ----------------------------------------------------------------------------------------

def brute_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        s = sorted(((-float(np.dot(np.array(v), np.array(w))), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
        out[q] = [(i, -x) for x, i in s]
    return out


def test_nearest_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((6, 48))
    rows = [(int(i), (centres[i % 6] + rng.standard_normal(48)).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in ann_onebit.nearest(df, df.where("vec_id % 20 = 0"), k=10).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], 10)
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.98 * 10 * len(want)
    by_id = dict(rows)
    for q, found in got.items():
        assert sorted(found) == list(range(1, 11))
        order = [found[i] for i in range(1, 11)]
        assert order == sorted(order, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - float(np.dot(by_id[q], by_id[v]))) < 1e-9 for v, s in order)


def test_nearest_with_huge_components(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.standard_normal(48).tolist()) for i in range(300)]
    for i, (at, size) in {17: (5, 1e200), 20: (6, -1e200), 51: (7, 1.5e308)}.items():
        rows[i][1][at] = size
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in ann_onebit.nearest(df, df.where("vec_id % 20 = 0"), k=20).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert all([found[i] for i in range(1, 21)] == [v for v, _ in want[q]] for q, found in got.items()) and got.keys() == want.keys()


def test_registered_neighbours_against_brute_force(spark):
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    hits = 0
    for r in LLM_QUERIES["op1_one_bit_neighbours"](spark, SF001).collect():
        hits += r["vec_id"] in {v for v, _ in want[r["query_id"]]}
    assert hits >= 0.9 * sum(len(v) for v in want.values())


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [1.0, 0.0]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double")
    got = [tuple(r) for r in ann_onebit.nearest(df, df.where("vec_id = 0"), k=5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 8, 1.0)]        # ties to the smaller id, all there are
    assert ann_onebit.nearest(df.limit(0), df, k=5).collect() == []
    assert ann_onebit.nearest(df, df.limit(0), k=5).collect() == []


# --- op2 ----------------------------------------------------------------------------------------

def brute_chat(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        turns = [(r or "", t or "") for _, r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark):
    rnd = random.Random(2)
    bits = ["### ", "</turn>", "\\", "#", "\n", ": ", "user", "<\\/turn>", "\\n", "é😀", " ", "</turn>\n### assistant: ", "a"]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "a: b", "x\ny", None]), None if rnd.random() < .05 else "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))))
            for c in range(40) for t in range(rnd.randint(1, 9))]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (99, None, "assistant", "n"), (99, 0, "assistant", "n"), (99, 0, "assistant", "n")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    examples = chat_prefix.prefix_target_examples(df)
    got = {r[0]: tuple(r)[1:] for r in chat_prefix.read_back(examples).collect()}
    want = brute_chat(rows)
    assert {k: v[:4] for k, v in got.items()} == want
    made = examples.collect()
    assert sum(v[4] for v in got.values()) == sum(len(e.formatted) for e in made)
    # one trained example a reply, all turns before it as context
    trained = [e for e in made if e.loss_end > 0]
    assert len(trained) == sum(1 for r in rows if r[2] == "assistant")
    assert chat_prefix.read_back(chat_prefix.prefix_target_examples(df.limit(0))).collect() == []


def test_long_conversation_in_many_tasks_read_back_from_any_layout(spark, tmp_path):
    # one conversation holds most rows; ranges of few turns; the examples staged and dealt anew
    rows = [(1.0, t, "assistant" if t % 3 else "user", f"turn {t} </turn> #") for t in range(400)]
    rows += [(float("nan"), t, "assistant", "n") for t in range(3)] + [(2.0, 0, "user", ""), (2.0, 1, "assistant", "x" * 300_000), (None, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id double, turn long, role string, text string")
    made = chat_prefix.prefix_target_examples(df, turns=7)
    tasks = made.where("conv = 1").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 2 and max(r["count"] for r in tasks) < 200
    whole = sorted((e.example, e.formatted) for e in chat_prefix.prefix_target_examples(df, turns=1000).where("conv = 1").collect())
    assert sorted((e.example, e.formatted) for e in made.where("conv = 1").collect()) == whole
    made.write.parquet(f"{tmp_path}/examples")
    got = {str(r[0]): tuple(r)[1:] for r in chat_prefix.read_back(spark.read.parquet(f"{tmp_path}/examples").repartition(5)).collect()}
    want = brute_chat([(str(c), *r) for c, *r in rows])
    assert {k: v[:4] for k, v in got.items()} == want and got["None"][2] == 0


def test_registered_chat_query_against_brute_force(spark, sf_dir=SF01):
    tricky = r"\### Assistant: </turn> ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute_chat(rows + [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)])
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in LLM_QUERIES["op2_prefix_target_chat"](spark, sf_dir).collect()}
    assert got == want


# --- op3 ----------------------------------------------------------------------------------------

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "a.b/"), ("allow", "a.b/"), ("block", "odd.net/en/x")]


def brute_verdict(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    best = None
    for verdict, rule in RULES:
        h, p = rule.split("/", 1)
        p = "/" + p
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(rule), len(h), rule, verdict))
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_url_rules(spark):
    hosts = ["net", "example.net", "www.Example.NET", "xexample.net", "example.com", "a..net", ".net", "org", "x.org", "a.b", "q.a.b", "odd.net", "", "é.net"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/?q", "/en/x", "/en/xyz#f", "?q", "#f", "//", "/DE/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "net/en/", "x://", "a\nb://net/\n", "http://net/://"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls * 2)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df, url_rules.rule_table(spark, RULES)).collect()}
    assert got == {i: brute_verdict(u) for i, u in enumerate(urls * 2)}
    none = url_rules.judge_urls(df, url_rules.rule_table(spark, RULES).limit(0)).collect()
    assert {r.verdict for r in none} == {"allow"} and len(none) == len(urls) * 2
    assert url_rules.judge_urls(df.limit(0), url_rules.rule_table(spark, RULES)).collect() == []


# --- op4, op5 -----------------------------------------------------------------------------------

def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_equals_the_library(spark):
    t, rnd = library(), random.Random(1)
    bits = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "é", "ß", "\xa0", "\u3000", "1", "!", "<|endoftext|>", "\x1c", "\x85", "😀", "\U00010400", "the", " the", "\r\n", "\u200b", "x" * 50, "=", "-----", "<|", "jx"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(1500)] + ["x" * 5000, "ab" * 3000, " " * 3000, "=-" * 2000, None]
    df = spark.createDataFrame([(i, x, b"") for i, x in enumerate(texts)], "doc_id long, text string, ids binary")
    got = {r.doc_id: r for r in bpe.decode_ids(bpe.encode_texts(df)).collect()}
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_text == ",".join(map(str, ids)), repr(x)
        assert got[i].decoded == t.decode(ids, skip_special_tokens=False)


def test_bpe_of_whole_documents_by_forced_cuts(spark):
    """Equal to the library on every document, and the table's cuts are what parts the words."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.public_vocabulary())
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in bpe.encode_texts(docs).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    assert got == {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in bpe.encode_texts(docs, cut_words=False).collect()}
    own = bpe.byte_bpe(bpe.public_vocabulary())
    assert own.cut_at_blanks
    blanks = sum(len(bpe.CERTAIN.findall(t)) for t in texts.values())
    words = {w for t in texts.values() for w in t.split()}
    pieces = {p for w in words for p in bpe.PIECES.findall(w)}
    cuts = sum(len(list(own.forced_fragments(p.encode()))) - 1 for p in pieces)
    assert blanks > 300_000 and cuts > 0
    for p in pieces:
        raw = p.encode()
        parts = list(own.forced_fragments(raw))
        assert b"".join(parts) == raw and all(pair in own.inside for x in parts for pair in zip(x, x[1:]))
        assert all((x[-1], y[0]) not in own.inside for x, y in zip(parts, parts[1:]))


def test_bpe_vocabulary_with_blanks_inside_tokens():
    """Where a token may hold a blank after a letter nothing is cut at blanks."""
    own = bpe.ByteBpe(bpe.public_vocabulary())
    own.inside = own.inside | {(ord("a"), 32)}
    assert not own.cut_at_blanks
    text = "a b  c\n\nd it's \u00a0 1,234 " * 50
    assert own.encode(text) == bpe.byte_bpe(bpe.public_vocabulary()).encode(text)


def test_bpe_limits_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "PART", 11)
    b, t = bpe.ByteBpe(bpe.public_vocabulary()), library()
    text = "Some words come again, some words don't; all words count."
    assert np.frombuffer(b.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_packing_plan_is_gapless_and_best_fit():
    import bisect

    rnd = random.Random(5)
    for _ in range(120):
        cap = rnd.choice([10, 50, 1024])
        counts = {rnd.randint(1, cap): rnd.randint(1, rnd.choice([1, 5, 400])) for _ in range(rnd.randint(0, 60))}
        bins, seen = {}, {}
        for length, first, n, seq, per, off in pack_bestfit.plan_packing(counts, cap):
            assert first == seen.get(length, 0)
            seen[length] = first + n
            for j in range(n):
                bins.setdefault(seq + j // per, []).append((off + j % per * length, length))
        assert seen == counts
        for items in bins.values():
            at = 0
            for off, length in sorted(items):
                assert off == at
                at += length
            assert at <= cap
            assert sum(3 * n > cap for _, n in items) <= 2
        gaps = []                                   # best fit over the items one by one, the largest first
        for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            i = bisect.bisect_left(gaps, n)
            bisect.insort(gaps, (gaps.pop(i) if i < len(gaps) else cap) - n)
        assert len(bins) <= len(gaps)


def test_pack_documents(spark):
    rnd, t = random.Random(3), library()
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "xyzzy"]) for _ in range(rnd.choice([0, 3, 50, 400, 2500])))) for i in range(120)] + [(500, None), (500, None), (None, "x")]
    df = docs_of(spark, plain(rows))
    pieces = bpe.token_pieces(df, capacity=1024, end_id=2, with_ids=True)
    placed = pack_bestfit.pack(pieces, 1024)
    got = placed.collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want, start = [], 0
        for p in range(-(-len(ids) // 1024)):
            n = (len(ids) % 1024 or 1024) if p == 0 else 1024
            want.append((p, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())))
            start += n
        assert sorted(by_doc[i]) == sorted(want * (2 if i == 500 else 1))
    for items in by_seq.values():
        at = 0
        for off, n in sorted(items):
            assert off == at
            at += n
        assert at <= 1024
    sequences = pack_bestfit.packed_sequences(placed).collect()
    assert sum(len(s.ids) for s in sequences) == 4 * sum(r.length for r in got) and len(sequences) == len(by_seq)
    assert pack_bestfit.pack(pieces.limit(0), 1024).collect() == []


def test_pack_rows_without_a_length(spark):
    df = spark.createDataFrame([(1, 0, None, 9), (2, 0, 0, 9), (3, 0, 2000, 9), (4, 0, 1024, 9), (5, 0, 1, 9)], "doc_id long, piece int, length long, _bucket int")
    got = {r.doc_id: (r.sequence_id, r.offset, r._bucket) for r in pack_bestfit.pack(df).collect()}
    assert [got[i][:2] for i in (1, 2, 3)] == [(None, None)] * 3 and {v[2] for v in got.values()} == {9}
    assert got[4][1] == got[5][1] == 0 and got[4][0] != got[5][0]


def test_own_columns_survive_clashing_names(spark):
    df = spark.createDataFrame([(1, "x" * 150, "a", 1), (2, "x" * 150, "b", 2)], "doc_id long, text string, _key string, _found int")
    assert sorted((r._key, r._found) for r in line_dedup.drop_repeated_lines(df).collect()) == [("a", 1), ("b", 2)]
    assert sorted((r._key, r._found) for r in suffix_dedup.remove_repeats(df).collect()) == [("a", 1), ("b", 2)]


# --- op6 ----------------------------------------------------------------------------------------

def brute_repeats(rows, depth):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = t.encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - depth + 1):
            w = raw[s:s + depth]
            if w in seen:
                gone[s:s + depth] = b"\1" * depth
            else:
                seen.add(w)
        out[i] = (len(raw), sum(gone), sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1])), bytes(c for c, g in zip(raw, gone) if not g))
    return out


@pytest.mark.parametrize("options", [{}, {"group": 2}, {"depth": 41, "gram": 16, "group": 3}])
def test_suffix_dedup_equals_brute_force(spark, options):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.randint(1, 5))) for _ in range(30)]
    passages = [" ".join(rnd.choice(words) for _ in range(40)) for _ in range(6)]
    rows = [(i * 3 - 20, "".join(rnd.choice([rnd.choice(passages)[rnd.randint(0, 40):], " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))), "aaaa" * rnd.randint(0, 60)])
                                 for _ in range(rnd.randint(0, 4)))) for i in range(120)]
    rows += [(1000, rows[5][1]), (1001, ""), (1002, rows[9][1][:99])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs_of(spark, plain(rows)), **options).collect()}
    assert got == brute_repeats(rows, options.get("depth", 100))


def test_suffix_dedup_odd_rows(spark):
    long = "é" * 60 + "".join(chr(97 + i * 7 % 26) for i in range(300))
    rows = [*ODD, (20, "xy" + long), (21, "z" + long + "w"), (22, long), (22, long), (23, "é" * 90)]
    got = suffix_dedup.remove_repeats(docs_of(spark, plain(rows))).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_bytes, r.kept_text) for r in by[1]] == [(0, None)] and by[2][0].n_spans == 0
    assert by[None][0].n_removed == 0
    assert by[21][0].kept_text == "zw" and [r.n_removed for r in by[22]] == [420, 420]
    assert by[8][0].n_removed == 30_000 - 1                  # all but the very first string's first byte overlap a later one
    assert suffix_dedup.remove_repeats(docs_of(spark, plain(rows)).limit(0)).collect() == []


@pytest.mark.parametrize("options", [{}, {"group": 1}, {"group": 4}])
def test_suffix_dedup_rows_repeated_in_full(spark, options):
    rnd = random.Random(8)
    letters = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = letters(150)
    once = [(1, letters(400)), (2, letters(70) + passage + letters(90)), (3, passage + letters(60)), (4, letters(80) + passage[:120]), (5, letters(99))]
    rows = once + once[:2] * 40 + once * 2
    got = suffix_dedup.remove_repeats(docs_of(spark, plain(rows)), **options).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)))
    assert by == {i: {v} for i, v in brute_repeats(once, 100).items()}       # copies are cut alike, as the row alone is
    assert [by[i] for i, t in once[:2]] == [{(len(t), 0, 0, t.encode())} for _, t in once[:2]]


def test_suffix_dedup_repetitive_texts(spark):
    rnd = random.Random(8)
    rows = [(i, "".join(rnd.choice("abc") for _ in range(p)) * (700 // p + i)) for i, p in enumerate([1, 1, 2, 3, 7, 40, 99, 100, 101, 250] * 2)]
    rows += [(50, "x" * 900 + "y" + "x" * 900), (51, "x" * 254), (52, "x" * 255), (53, "z" * 100), (54, "z" * 101)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs_of(spark, plain(rows))).collect()}
    assert got == brute_repeats(rows, 100)


def test_suffix_runs_of_one_letter_are_bounded(spark):
    n = 8_000_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a" * n]), pa.array([0])], names=["id", "text", "tag"])
    tracemalloc.start()
    rows = settled = 0
    for b in suffix_dedup._runs_of([batch], 100, 24):
        rows += b.num_rows
        start, length, _ = suffix_dedup._unpack(b.column(5).to_numpy())
        settled += int(length[b.column(0).to_numpy(zero_copy_only=False)].sum())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    slabs = -(-n // suffix_dedup.SLAB)
    assert settled == n - 99 - slabs and rows < n / 200      # one start a slab is left to the shuffle
    assert peak < 150e6
    cut = suffix_dedup.remove_repeats(docs_of(spark, plain([(1, "a" * n), (2, "b")]))).select("doc_id", "n_removed", "n_spans", "kept_text").collect()
    assert sorted(map(tuple, cut)) == [(1, n - 1, 1, "a"), (2, 0, 0, "b")]


def test_suffix_dedup_many_texts_of_one_id(spark):
    import xxhash

    text = lambda i: "".join(hashlib.sha256(f"{i} {j}".encode()).hexdigest() for j in range(3))
    seen = {}
    for i in range(400_000):                  # two texts whose hashes share 31 bits
        if (j := seen.setdefault(xxhash.xxh64_intdigest(text(i), 42) >> 33, i)) != i:
            break
    assert j != i
    a, b = text(j), text(i)
    rows = [(6, a), (6, b), (6, b), (7, "x" + a[20:180] + "y")]
    got = suffix_dedup.remove_repeats(docs_of(spark, plain(rows))).collect()
    assert sorted((r.doc_id, r.kept_text) for r in got) == sorted([(6, a), (6, b), (6, b), (7, "xy")])


def test_suffix_dedup_long_text(spark):
    rng = np.random.default_rng(9)
    text = rng.integers(97, 123, 2_500_000, dtype=np.uint8).tobytes().decode()      # in several parts
    rows = [(1, text), (2, "xyz" + text + "w"), (3, text[1_000_000:1_100_000])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs_of(spark, plain(rows))).collect()}
    assert got == {1: (0, 0), 2: (len(text), 1), 3: (100_000, 1)}


def test_removed_spans():
    pack = lambda s, n: suffix_dedup._pack(np.array(s), np.array(n), 0)
    at, what = pack([0, 100, 300, 500, 501], [1, 1, 5, 3, 1]), np.array([0, 0, 0, 2, 3])
    assert suffix_dedup.removed_spans(at, what) == [(0, 200), (300, 404), (500, 602)]
    assert suffix_dedup.removed_spans(at[:0], what[:0]) == []


# --- op7 ----------------------------------------------------------------------------------------

def test_iblt_versions(spark):
    rnd = random.Random(4)
    lines = ["".join(rnd.choice("abcde é") for _ in range(rnd.randint(0, 400))) for _ in range(60)]
    rows = [(i * 2, "\n".join(rnd.choice(lines) for _ in range(rnd.choice([0, 1, 3, 12, 150])))) for i in range(150)]
    got = {r.id: r for r in iblt.versions(docs_of(spark, plain(rows))).collect()}
    order = sorted(rows, reverse=True)
    for j, (i, t) in enumerate(order):
        nxt = order[(j + 1) % len(order)][1]
        k = len(t) // 3
        edited = t[:len(t) - k] + nxt[:k]
        own, edit, follow = (set(re.findall(r"[^\n]{1,%d}" % iblt.HEAD_PIECE, x[:iblt.HEAD]) + re.findall(r"[^\n]{1,%d}" % iblt.PIECE, x[iblt.HEAD:])) for x in (t, edited, nxt))
        like = [1 - len(own ^ x) / (len(own) + len(x)) if own or x else 1.0 for x in (edit, follow)]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like[0]) and r.near_next == pytest.approx(like[1])
    same = {}
    for i, t in rows:
        same.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(f) == 1 for f in same.values())


def test_iblt_odd_rows(spark):
    got = iblt.versions(docs_of(spark, plain(ODD))).collect()
    assert len(got) == len(ODD) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = iblt.versions(docs_of(spark, plain([(5, "abcdef")]))).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one[0].near_next == 1.0
    assert iblt.versions(docs_of(spark, plain([(5, "x")])).limit(0)).collect() == []


def test_iblt_peel_fails_then_recovers(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda x: F.xxhash64(x)).alias("a"), F.array().cast("array<long>").alias("b"))
    small, large = (iblt.peel(iblt.subtract(iblt.sketch(F.col("a"), m), iblt.sketch(F.col("b"), m)), m) for m in (8, 64))
    assert tuple(df.select(small, large).first()) == (None, 60)


def test_iblt_next_of_a_hot_id(spark):
    """An id that holds most rows lies in several ranges, and every row still meets the next one."""
    rows = [(5, f"text {i}") for i in range(400)] + [(i, f"own {i}") for i in range(60)] + [(None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = [t for _, t in sorted(rows, key=lambda r: (-(-2 ** 63 if r[0] is None else r[0]), hashes[r[1]]))]
    out = iblt.with_next(df)
    got = {r.text: r.next for r in out.collect()}
    assert got == {t: order[(i + 1) % len(order)] for i, t in enumerate(order)}
    ranges = out.where("id = 5").select(F.shiftright("key", 40).alias("r")).distinct().count()
    assert ranges > 8


def test_iblt_plan_is_native(spark):
    from conftest import plan_text

    plan = plan_text(iblt.with_next(spark.read.parquet(f"{SF001}/documents.parquet")))
    assert not re.search("Python|Pandas|Arrow", plan)


# --- op8 ----------------------------------------------------------------------------------------

def brute_lines(rows, min_chars=40, min_docs=5):
    lower = {c: c + 32 for c in range(65, 91)}
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(lower)
            if len(k) >= min_chars and i is not None and t is not None:
                holders.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(h := holders.get(x.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(lower), ())) < min_docs or max(h) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [300, 20])
def test_line_dedup_equals_brute_force(spark, n):
    rnd = random.Random(n)
    lines = ["".join(rnd.choice("abcdefgh É") for _ in range(rnd.choice([5, 39, 45, 60]))) for _ in range(12)] + ["HOT LINE THAT ALL THE DOCUMENTS HOLD, AND OFTEN MORE THAN ONCE"]
    rows = [(i, "\n".join(rnd.choice([rnd.choice(lines), " " + rnd.choice(lines).lower() + "\t\r", lines[-1]]) for _ in range(rnd.randint(0, 8)))) for i in range(n)] + ODD
    got = line_dedup.drop_repeated_lines(docs_of(spark, plain(rows))).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got), key=str) == brute_lines(rows)
    assert line_dedup.drop_repeated_lines(docs_of(spark, plain(rows)).limit(0)).collect() == []


# --- op9 ----------------------------------------------------------------------------------------

def brute_components(fps, distance):
    left, out = set(fps), {}
    while left:
        todo, seen = [left.pop()], []
        while todo:
            x = todo.pop()
            seen.append(x)
            near = {y for y in left if (x ^ y).bit_count() <= distance}
            left -= near
            todo += near
        for x in seen:
            out[x] = min(seen)
    return out


@pytest.mark.parametrize("distance", [0, 1, 4])
def test_near_links_connect_what_brute_force_connects(spark, distance):
    rnd = random.Random(distance)
    seeds = [rnd.getrandbits(64) for _ in range(60)]
    fps = set(seeds)
    for s in seeds[:30]:
        for _ in range(12):
            for b in rnd.sample(range(64), rnd.randint(1, 6)):
                s ^= 1 << b
            fps.add(s)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash.near_links(df, distance, block=16).collect()
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= distance for a, b in links)
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()} if links else {}
    want = brute_components(fps, distance)
    mine = {}
    for x, s in zip(fps, signed):
        mine.setdefault(roots.get(s, s), set()).add(x)
    theirs = {}
    for x, r in want.items():
        theirs.setdefault(r, set()).add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


@pytest.mark.parametrize("thresholds", [[2, 1, -1], [-1, 1, 2], [0, 0, 2], [1, 2], [3, 0]])
def test_near_links_with_unequal_thresholds(spark, monkeypatch, thresholds):
    """Parts probed at unequal distances, one not at all, find what brute force finds."""
    monkeypatch.setattr(simhash, "choose_partition", lambda n, both, distance: (simhash.group_bits(n, both, len(thresholds)), thresholds))
    assert sum(thresholds) == 4 - len(thresholds) + 1
    test_near_links_connect_what_brute_force_connects(spark, 4)


@pytest.mark.parametrize("distance", [0, 3, 4, 7])
def test_thresholds_are_enough(distance):
    rng = np.random.default_rng(distance)
    bits = rng.integers(0, 2, (500, 64)).astype(float)
    groups, thresholds = simhash.choose_partition(500, bits.T @ bits, distance)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert sum(thresholds) == distance - len(groups) + 1


def test_simhash_of_a_long_text_in_parts(monkeypatch):
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 9))) for _ in range(3000)) + "\n\n  tail of it "
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "PART", 100)
    assert simhash.simhash(text) == whole


def test_simhash_values_and_odd_rows(spark):
    import xxhash

    words = "A b c d e f".lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(3)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 3)
    assert simhash.simhash("A  b\tc\nd e f") == want and simhash.simhash(None) == simhash.simhash(" \n") == 0
    got = simhash.near_duplicates(docs_of(spark, plain(ODD))).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r.component for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[5] == 4
    kept = simhash.first_of_each(docs_of(spark, plain(ODD))).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None)[:2] == [1, 4]
    assert simhash.near_duplicates(docs_of(spark, plain(ODD)).limit(0)).collect() == []


def test_first_of_each_judges_every_text_of_an_id(spark):
    rnd = random.Random(12)
    a, b, c, d = (" ".join("".join(rnd.choice("abcdefg") for _ in range(6)) for _ in range(300)) for _ in range(4))
    near = next(v for w in c.split() if 0 < (simhash.simhash(v := c.replace(w, "other")) ^ simhash.simhash(c)).bit_count() <= 4)
    rows = [(1, b), (5, a), (5, b), (5, d), (9, a), (9, d), (3, c), (3, near), (3, near), (4, near), (None, a), (None, d), (6, None), (6, "")]
    rows += [(5, b)] * 3 + [(5, d)] * 2
    kept = sorted(((r.doc_id, r.text) for r in simhash.first_of_each(docs_of(spark, plain(rows))).collect()), key=str)
    # 5 loses b to 1, and stays the first of a and of d; of 3's two near texts one stays, with its repeats
    signed = lambda t: (v := simhash.simhash(t)) - (v >> 63 << 64)
    want = [(1, b), (5, a), *[(5, d)] * 3, *([(3, c)] if signed(c) < signed(near) else [(3, near)] * 2), (None, a), (None, d), (6, None), (6, "")]
    assert kept == sorted(want, key=str)


# --- op10 ---------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    told = LLM_QUERIES["op10_compression_language_id"](spark, SF01).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in told) >= 0.97 * len(told)
    assert all(0 <= r.score <= 1 for r in told)


def test_language_sample_of_repeated_and_letterless_rows(spark):
    rows = [(i, f"erstes wort {i}", "de") for i in range(12)] + [(0, "erstes wort 0", "de")] * 4000
    rows += [(100 + i, f"first word {i}", "en") for i in range(12)] + [(1000 + i, f"{i} 17 ...", "en") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.learn_dictionaries(df, sample_rows=10)
    assert {lang: len(set(d.split(b"\n"))) for lang, d in learned.items()} == {"de": 10, "en": 10}


def test_language_margins(spark):
    """Random letters are rejected at every length, clean texts hardly ever."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    dictionaries = langid.learn_dictionaries(docs.where(~langid.held_out("doc_id")))
    rnd = random.Random(1)
    for words in (30, 100, 400, 3000):
        rows = [(i, " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(words))) for i in range(100)]
        assert langid.identify(docs_of(spark, plain(rows)), dictionaries).where("rejected").count() >= 95, words
    clean = docs.where(langid.held_out("doc_id") & (F.length("text") >= 32))
    told = langid.identify(clean, dictionaries)
    assert told.where("rejected").count() <= 0.01 * clean.count()
    kept = langid.accepted(clean, dictionaries)
    assert kept.count() == told.where("not rejected").count() and kept.columns == clean.columns


def test_language_rows_as_they_come(spark):
    """Repeated rows, null ids, very long texts, clashing names, ties; a first letter far into a text."""
    german, english = "der die das und ist nicht mit ein von zu ", "the of and to in is that it was for "
    train = [(i, " " * 600 * (i % 2) + t * 5 + str(i), lang) for i in range(20) for t, lang in ((german, "de"), (english, "en"))]
    dictionaries = langid.learn_dictionaries(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert all(d.count(b"\n") == 19 for d in dictionaries.values())
    rows = [(1, german), (1, german), (None, english), (None, english), (2, (german + english[:9]) * 40_000)]
    df = spark.createDataFrame([(i, t, "x", 0.5, True) for i, t in rows], "doc_id long, text string, lang_pred string, score double, rejected boolean")
    got = sorted(((r.doc_id, r.lang_pred) for r in langid.identify(df, dictionaries).collect()), key=str)
    assert got == sorted([(1, "de"), (1, "de"), (None, "en"), (None, "en"), (2, "de")], key=str)
    assert langid.accepted(df, dictionaries).columns == df.columns
    same = {"b": dictionaries["de"], "a": dictionaries["de"]}
    tied = langid.identify(df, same).select("lang_pred", "rejected").distinct().collect()
    assert [tuple(r) for r in tied] == [("a", True)]
    assert langid.margin_bars(spark, same) == langid.margin_bars(spark, dict(reversed(same.items())))


def test_language_odd_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    dictionaries = langid.learn_dictionaries(docs)
    assert set(dictionaries) == {r.lang for r in docs.select("lang").distinct().collect()}
    assert all(len(d) <= langid.DICTIONARY_BYTES for d in dictionaries.values())
    got = {r.doc_id: r for r in langid.identify(docs_of(spark, plain([(1, None), (2, ""), (3, "12 !?"), (4, "the and of")])), dictionaries).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred in dictionaries
    assert langid.learn_dictionaries(docs.limit(0)) == {}
    none = langid.identify(docs, {}).select("lang_pred", "rejected").distinct().collect()
    assert [tuple(r) for r in none] == [("und", True)]
    assert langid.accepted(docs.limit(0), dictionaries).collect() == []
