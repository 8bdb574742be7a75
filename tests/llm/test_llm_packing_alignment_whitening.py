"""Vector bin packing, token alignment and whitening against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tributary.llm import bpe, token_alignment, vector_packing, whitening
from tributary.llm.bpe import encode_texts, public_vocabulary
from tributary.llm.common import ship_package
from tributary.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


CLASH = "doc_id long, text string, start string, ids string, sequence_id string, pairs string, chunk string, n_a string, i string"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "same text"), (4, "same text"), (None, "same text"), (7, "Ünïcödé 😀 \r\n x  y" * 30), (8, "a" * 30_000),
       (9, "an <|endoftext|> inside"), (10, "x▁y"), (11, "\x00nul"), (12, " lead and trail ")]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *"vwxyzqr") for i, t in rows], CLASH).repartition(3)


# --- vector bin packing -------------------------------------------------------------------------

def check_sequences(sequences, examples, capacity, max_segments, max_loss, cut):
    held = defaultdict(list)
    for s in sequences:
        assert 1 <= len(s) <= max_segments
        tokens, loss = sum(x[2] for x in s), sum(x[3] for x in s)
        assert tokens <= capacity and loss <= max_loss
        if cut:
            assert tokens == capacity or tokens & (tokens - 1) == 0
        for which, start, n, bearing in s:
            held[which].append((start, n, bearing))
    for i, (tokens, loss) in enumerate(examples):
        at = 0
        for start, n, bearing in sorted(held[i]):
            assert start == at and n > 0
            at += n
            # the example's last ``loss`` tokens bear loss
            assert bearing == max(0, min(n, at - (tokens - loss)))
        assert at == tokens
    return sum(capacity - sum(x[2] for x in s) for s in sequences)


@pytest.mark.parametrize("limits", [(1024, 64, 1024), (1024, 4, 1024), (256, 8, 60), (64, 3, 1), (1, 1, 1), (100, 7, 30)])
def test_blocks_keep_all_limits(limits):
    rng = random.Random(str(limits))
    for size in (0, 1, 40, 700):
        examples = [(n, rng.randint(0, n)) for n in (int(rng.paretovariate(0.7)) % (4 * limits[0]) for _ in range(size))]
        check_sequences(vector_packing.pack_block(examples, *limits, True), examples, *limits, True)
        whole = [(min(n, limits[0]), min(loss, limits[2])) for n, loss in examples if n]
        whole = [(n, min(n, loss)) for n, loss in whole]
        check_sequences(vector_packing.pack_block(whole, *limits, False), whole, *limits, False)


def test_dot_product_mixes_scarce_dimensions():
    """Prompts without loss and short replies that are all loss: alone, either leaves the other limit unused."""
    examples = [(60, 0)] * 100 + [(40, 40)] * 100
    sequences = vector_packing.pack_block(examples, 100, 8, 40, False)
    assert len(sequences) == 100
    assert all(sorted(x[3] for x in s) == [0, 40] for s in sequences)


def test_weights_follow_the_scarcer_limit():
    rng = random.Random(3)
    examples = [(rng.randint(20, 200), 0) for _ in range(400)]
    examples = [(n, rng.randint(0, n)) for n, _ in examples]
    limits = (1024, 12, 500)
    sequences = vector_packing.pack_block(examples, *limits, False)
    check_sequences(sequences, examples, *limits, False)
    least = max(sum(n for n, _ in examples) / 1024, sum(loss for _, loss in examples) / 500, len(examples) / 12)
    assert len(sequences) <= 1.15 * least


def test_pack_examples_of_whole_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").repartition(3)
    encoded = encode_texts(docs)
    ids = {r.doc_id: bytes(r.ids) + b"\0\0\0\0" for r in encoded.collect()}
    rows = vector_packing.pack_examples(encoded).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id]) // 4
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start:4 * (r.start + r.length)])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for group, total in [(pieces[d], len(x) // 4) for d, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, n in sorted(group):
            assert start == at
            at += n
        assert at == total if total is not None else at == 1024 or at & (at - 1) == 0
    assert all(len(s) <= 64 for s in sequences.values())
    # few are shorter than 1024: what the tasks' last sequences leave, by powers of two
    short = [s for s in sequences.values() if sum(n for _, n in s) < 1024]
    assert len(short) <= 10 * 3
    assert sum(len(x) // 4 for x in ids.values()) > 1024 * 300


def test_pack_examples_odd_rows(spark):
    docs = docs_of(spark, ODD)
    rows = vector_packing.pack_examples(encode_texts(docs), capacity=64, max_segments=3).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 1 == sum(r.length for r in rows if r.doc_id == 2)
    assert sum(r.length for r in rows if r.doc_id == 4) == 2 * sum(r.length for r in rows if r.doc_id is None) == 2 * 3
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    empty = vector_packing.pack_examples(encode_texts(docs.where("false")))
    assert empty.collect() == [] and empty.columns[:3] == ["doc_id", "start", "length"]
    none = vector_packing.pack_examples(encode_texts(docs.where("doc_id < 3")), end_id=None)
    assert none.collect() == []


def test_pack_examples_whole_with_loss(spark):
    rows = [(1, b"\1\0\0\0" * 10, 4), (2, b"\2\0\0\0" * 10, 9), (3, b"\3\0\0\0" * 90, 0), (4, None, None), (5, b"\5\0\0\0" * 5, 99)]
    df = spark.createDataFrame(rows, "id long, ids binary, loss int").coalesce(1)
    got = {r.id: r for r in vector_packing.pack_examples(df, "id", "ids", "loss", capacity=32, max_segments=2, max_loss=10, end_id=None, cut=False, with_ids=True).collect()}
    assert got[3].sequence_id is None and got[3].offset is None and 4 not in got
    assert got[5].loss_tokens == 5 and bytes(got[2].piece_ids) == rows[1][1]
    assert len({got[i].sequence_id for i in (1, 2, 5)}) == 2
    with pytest.raises(ValueError):
        vector_packing.pack_examples(df, "id", max_segments=0)


# --- token alignment ----------------------------------------------------------------------------

def brute_align(texts):
    """Groups by comparing byte offsets, with the two libraries; counts by documents in Python."""
    import sentencepiece
    from tokenizers import Tokenizer

    from tributary.llm.bpe import byte_alphabet

    a = Tokenizer.from_file(public_vocabulary())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_vocabulary("piece_bpe_32k.model"))
    alphabet = byte_alphabet()
    groups = []
    for t in texts:
        full = (" " + (t or "")).encode()
        ia = a.encode(" " + (t or ""), add_special_tokens=False).ids
        ib = b.encode(t or "")
        wa = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ia]
        wb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not t or b"".join(wa) != full or b"".join(wb) != full:
            groups.append((ia[:0], ib[:0], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in wa]).tolist(), np.cumsum([len(x) for x in wb]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        out, i, j = [], 0, 0
        for e in common:
            ni, nj = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            out.append((ia[i:ni], ib[j:nj]))
            i, j = ni, nj
        groups.append((ia, ib, out))
    links = [Counter(p for x, y in g for p in product(x, y)) for _, _, g in groups]
    count = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    rows = []
    for (ia, ib, g), c in zip(groups, links):
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        rows.append((len(ia), len(ib), len(g), sum(c.values()), sum(n for p, n in c.items() if count[p] == top[p[0]]),
                     sum(n * count[p] for p, n in c.items()), hashlib.sha256(written.encode()).hexdigest() if g else ""))
    return rows


def aligned_rows(df):
    return df.select("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def noisy(rng):
    words = ["the", "Straße", "naïve", "日本語", "😀👍", "123456", "aaaa" * 9, "x" * 70, "can't", "​", "́", "<0x41>", "ﬁ", "\x7f", "﻿"]
    return "".join(rng.choice([rng.choice(words), rng.choice([" ", "  ", "\n", "\t", "", " "])]) for _ in range(rng.randint(0, 60)))


def test_texts_encoded_together_equal_the_library(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(9)
    texts = [t or "" for _, t in ODD] + [noisy(rng) for _ in range(200)] + [" ".join(rng.choice(["one", "Straße", "can't", "x" * 70, "a\nb", "<|endoftext|>"]) for _ in range(30)) for _ in range(50)]
    coder = bpe.ByteBpe(public_vocabulary(), False)
    want = [np.asarray(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(public_vocabulary()).encode_batch(texts, add_special_tokens=False)]
    assert coder.encode_many(texts) == want and coder.encode_many([]) == []
    again = []
    monkeypatch.setattr(coder.words, "encode_all", lambda words: again.extend(words) or coder.encode_led(words))
    assert coder.encode_many(texts) == want and all(len(w) >= bpe.CACHED_LENGTH for w in again)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    forgetful = bpe.ByteBpe(public_vocabulary(), False)
    assert [i for t in texts for i in forgetful.encode_many([t])] == want


def test_alignment_equals_brute_force(spark):
    rng = random.Random(5)
    texts = [t for _, t in ODD] + [noisy(rng) for _ in range(150)] + [" ".join(["word"] * 50)] * 3
    df = docs_of(spark, [(i, t) for i, t in enumerate(texts)])
    got = token_alignment.align_and_count(df).orderBy("doc_id").collect()
    want = brute_align(texts)
    for r, w in zip(got, want):
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == w, texts[r.doc_id]
    assert len(got) == len(want)


def test_alignment_of_the_query(spark):
    got = LLM_QUERIES["op12_token_alignment"](spark, SF001).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    want = brute_align([d.text for d in docs])
    assert [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got] == [(d.doc_id, *w) for d, w in zip(docs, want)]


def test_alignment_encodes_a_slabs_new_words_at_once(monkeypatch):
    class Counted:
        def __init__(self, model):
            self.model, self.calls = model, 0

        def encode(self, *args, **options):
            self.calls += 1
            return self.model.encode(*args, **options)

    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "naïve", "日本語", "😀", "can't", "x" * 70, "line\nbreak"]) + str(rng.randrange(900)) for _ in range(60)) for _ in range(40)]
    texts += ["ﬁ ligature", "a  b", None, "", "an <|endoftext|> inside", "tail ", "\nhead", "x▁y z"] + [noisy(rng) for _ in range(40)]
    al = token_alignment.Aligner(public_vocabulary(), public_vocabulary("piece_bpe_32k.model"))
    want = [al.tokens(t) for t in texts]
    counted = Counted(al.b.model)
    monkeypatch.setattr(al.b, "model", counted)
    token_alignment.align_slab(al, texts[:40])
    assert counted.calls == 1                        # one a distinct word before
    assert al.tokens_of(texts) == want
    monkeypatch.setattr(bpe.Words, "look_up", lambda self, words: [(b"", b"")] * len(words))
    assert al.tokens_of(texts) == want               # words that lose bytes: every text is judged whole


def test_alignment_limits_change_nothing(spark, monkeypatch):
    rng = random.Random(6)
    texts = [noisy(rng) for _ in range(40)] + ["word " * 400 + "end", "a" * 3000]
    al = token_alignment.aligner(public_vocabulary(), public_vocabulary("piece_bpe_32k.model"))
    want = token_alignment.align_slab(al, texts)
    for name, value in (("FEW", 1), ("LINKS", 7), ("PART", 50)):
        monkeypatch.setattr(token_alignment, name, value)
        assert token_alignment.align_slab(al, texts) == want
    one_by_one = [token_alignment.align_slab(al, [t])[0] for t in texts]
    assert one_by_one == want


@pytest.mark.parametrize("seed", range(5))
def test_pointer_jumping_labels_components(seed):
    rng = np.random.default_rng(seed)
    total = 2000
    inner = np.arange(1, total)
    end_a = np.concatenate([rng.choice(inner, 700, replace=False), [total]])
    end_b = np.concatenate([rng.choice(inner, 30 if seed % 2 else 900, replace=False), [total]])
    end_a.sort(), end_b.sort()
    a, b = token_alignment.label_groups(end_a, end_b)
    common = np.intersect1d(end_a, end_b)
    assert (a == np.searchsorted(common, end_a)).all() and (b == np.searchsorted(common, end_b)).all()


def test_alignment_odd_tables(spark):
    df = docs_of(spark, ODD)
    got = token_alignment.align_and_count(df).collect()
    assert len(got) == len(ODD)
    assert all(r.n_a == r.n_b == r.n_groups == r.n_links == r.n_best == r.count_sum == 0 and r.groups_sha256 == "" for r in got if r.doc_id in (1, 2, 10))
    assert token_alignment.align_and_count(df.where("false")).collect() == []
    assert token_alignment.align_and_count(df.where("doc_id = 1")).collect()[0].n_links == 0
    written = {r.doc_id: r.groups for r in token_alignment.align(df).collect()}
    assert written[4].count(";") == 1 and written[1] == ""


# --- whitening ----------------------------------------------------------------------------------

def brute_whiten(rows, k=8):
    x = np.floor(1024 * np.array([v for _, v in rows], float)).astype(np.int64) + 100000
    n = len(x)
    s = x.sum(axis=0)
    m = n * x - s
    y = m / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    return n, (m.astype(object) ** 2).sum(axis=1), e[::-1][:k], u[:, ::-1][:, :k], y, np.trace(cov)


def held_to_brute_force(got, rows, k=8):
    n, deviation, e, u, y, trace = brute_whiten(rows, k)
    table = np.full((len(rows), k), np.nan)
    at = {i: p for p, (i, _) in enumerate(rows)}
    for r in got:
        p = at[r.vec_id]
        assert r.n == n and int(r.deviation) == deviation[p]
        assert abs(r.explained * trace - e[r.component - 1]) <= 1e-9 * e[0]
        assert 0 <= r.identity_error < 1e-9
        table[p, r.component - 1] = r.whitened
    want = y @ u / np.sqrt(e)
    signs = np.sign((table * want).sum(axis=0))
    assert np.abs(table - want * signs).max() < 1e-7
    assert len({r.identity_error for r in got}) == 1


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    data = rng.standard_normal((700, 24)) * np.linspace(3, 0.2, 24) @ turn + 50
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    held_to_brute_force(whitening.whiten(df).collect(), rows)


def test_whitening_of_the_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    held_to_brute_force(LLM_QUERIES["op13_embedding_whitening"](spark, SF01).collect(), rows)


@pytest.mark.parametrize("kind", ["random", "close", "equal", "rank", "diagonal", "zero", "offset"])
@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
def test_leading_components(kind, n):
    rng = np.random.default_rng(n)
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = {"random": rng.uniform(0, 5, n), "close": 1 + 1e-9 * np.arange(n), "equal": np.ones(n), "rank": (np.arange(n) < 2) * 3.0,
              "diagonal": np.arange(n, 0, -1.0) // 2, "zero": np.zeros(n), "offset": np.r_[1e12, rng.uniform(0, 1, n - 1)]}[kind]
    a = np.diag(values) if kind == "diagonal" else (q * values) @ q.T
    a = (a + a.T) / 2
    k = min(8, n)
    e, u = whitening.leading_components(a, k)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(e - np.sort(np.linalg.eigvalsh(a))[::-1][:k]).max() <= 1e-13 * n * size
    assert np.abs(u.T @ u - np.eye(k)).max() < 1e-12
    assert np.abs(a @ u - u * e).max() <= 1e-12 * n * size


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.5, 0.25]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [1e300, 0.0])]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], "vec_id long, embedding array<double>, n string, w string, id string")
    got = whitening.whiten(df).collect()
    assert Counter(r.vec_id for r in got) == {1: 4, None: 2, 2: 2}
    assert all(r.n == 4 and r.identity_error < 1e-9 for r in got)
    assert whitening.whiten(df.where("false")).collect() == []
    one = whitening.whiten(df.where("vec_id = 2")).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]


def test_whitening_large_whole_numbers(spark):
    rows = [(i, [float(v), 1.0]) for i, v in enumerate((1e12, -1e12, 3e11))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(df, components=1).collect()}
    x = [int(1024 * v) + 100000 for _, (v, _) in rows]
    assert got == {i: (3 * v - sum(x)) ** 2 for i, v in enumerate(x)}
