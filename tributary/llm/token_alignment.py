"""Alignment of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes; the tokens between two offsets where both
cut belong together.  Every token points to the farthest-right token that
overlaps it - the one of the other tokenizer that covers its last byte - and a
token that ends where that one ends closes its group.  Doubling all pointers
at once (``to = to[to]``) brings each token to its group's last token in about
log2 of the longest chain steps, for all texts of a slab in the same arrays.

Linked id pairs are counted per document over the whole corpus: distinct pairs
are packed per document, pre-aggregated in the tasks that made them, summed by
Spark, and come back to the documents as one dictionary for each bounded chunk
of documents, so a pair that almost every document holds is one row a chunk.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .bpe import PART, Fragments, Words, byte_bpe, joined, public_vocabulary, words_of
from .common import ship_package, stage

BLANK = "▁"
SLAB = 1 << 19             # characters aligned at once (a longer text is a slab of its own)
CHUNK = 1 << 20            # distinct pairs of a chunk of documents (a document with more is a chunk of its own)
FEW = 1 << 10              # links of a group that are written out one by one; larger groups by distinct ids
LINKS = 1 << 21            # links written out at once
HELD = 1 << 20             # distinct pairs a task sums before it lets them go


class PieceBpe:
    """A sentencepiece model that cuts texts at blanks where that is certain:
    no piece of its vocabulary holds a blank after another character."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        probe = ["a  b", " a ", "a b", "\n a"]
        kept = all(b"".join(self.bytes_of[i] for i in self.model.encode(t)) == (" " + t).encode() for t in probe)
        self.certain = kept and not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.words = Fragments(self._encode)

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.model.encode(text), "<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.model.encode(words, num_threads=1)]

    def _encode_part(self, text: str) -> bytes:
        if "  " in text or text[:1] == " " or text[-1:] == " " or not text:
            return self._encode(text)
        return b"".join(map(self.words.__getitem__, text.split(" ")))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit words; every part's own leading blank is the one it was cut at."""
        if not self.certain:
            return self._encode(text)
        out, at = [], 0
        while True:
            end = at + PART
            # a single blank between two other characters
            while 0 < end < len(text) - 1 and not (text[end] == " " and text[end - 1] != " " and text[end + 1] != " "):
                end = text.find(" ", end + 1)
            if not 0 < end < len(text) - 1:
                return b"".join([*out, self._encode_part(text[at:])])
            out.append(self._encode_part(text[at:end]))
            at = end + 1


class Aligner:
    """Two vocabularies with the tables that alignment needs."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_bpe(path_a, False), PieceBpe(path_b)      # only the ids count here
        self.words = Words(self._encode_words)
        self.n_a, self.n_b = len(self.a.bytes_of), len(self.b.bytes_of)
        self.width_a = np.array([len(x) for x in self.a.bytes_of], np.int64)
        self.width_b = np.array([len(x) for x in self.b.bytes_of], np.int64)
        self.pair_type = np.dtype("<u4") if self.n_a * self.n_b < 1 << 32 else np.dtype("<u8")

        def digits(n, last):
            return np.array([f"{i}," for i in range(n)] + [f"{i}{last}" for i in range(n)], object)

        self.text_a, self.text_b = digits(self.n_a, "|"), digits(self.n_b, ";")

    def tokens(self, text: str | None) -> tuple[bytes, bytes]:
        """Packed ids of both, or nothing where either loses bytes of the text."""
        if not text:
            return b"", b""
        full = " " + text
        ids_a = self.a.encode_plain(full)
        ids_b = self.b.encode(text)
        raw = full.encode()
        for ids, table in ((ids_a, self.a.bytes_of), (ids_b, self.b.bytes_of)):
            if b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())) != raw:
                return b"", b""
        return ids_a, ids_b

    def _encode_words(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids of both for words with the blank before them; nothing for one whose bytes either loses."""
        raw = [(" " + w).encode() for w in words]
        sides = self.a.encode_led(words), self.b.encode_words(words)
        if all(map(self._gives_back, sides, (self.a.bytes_of, self.b.bytes_of), (self.width_a, self.width_b), (raw, raw))):
            return list(zip(*sides))
        return [both if all(map(self._gives_back, [[x] for x in both], (self.a.bytes_of, self.b.bytes_of), (self.width_a, self.width_b), ([r], [r])))
                else (b"", b"") for r, *both in zip(raw, *sides)]

    @staticmethod
    def _gives_back(ids: list[bytes], table: list[bytes], width: np.ndarray, raw: list[bytes]) -> bool:
        """Whether every word's tokens are its bytes."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        reach = np.concatenate([[0], np.cumsum(width[flat])])[np.cumsum([len(x) // 4 for x in ids])]
        return (np.array_equal(reach, np.cumsum([len(r) for r in raw]))
                and b"".join(map(table.__getitem__, flat.tolist())) == b"".join(raw))

    def tokens_of(self, texts: list) -> list[tuple[bytes, bytes]]:
        """:meth:`tokens` of each text.  Where single blanks part both tokenizers' words, each distinct
        word is encoded once; a text with a word that does not give its bytes back is judged whole."""
        out: list = [None] * len(texts)
        if self.b.certain and self.a.cut_at_blanks:
            simple = [i for i, t in enumerate(texts) if t and len(t) <= PART and t[-1] != " " and self.a.lone_white(" " + t)]
            words, which, bounds = words_of([texts[i] for i in simple])
            ids = self.words.look_up(words)
            lost = np.array([not a for a, _ in ids], bool)[which]
            kept = ~np.logical_or.reduceat(lost, bounds[:-1]) if len(simple) else []
            sides = [joined([x[k] for x in ids], which, bounds) for k in (0, 1)]
            for i, whole, *both in zip(simple, kept, *sides):
                if whole:
                    out[i] = tuple(both)
        return [self.tokens(t) if both is None else both for t, both in zip(texts, out)]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def label_groups(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group (numbered from 0, left to right) of every token, given the two
    tokenizations' ascending end offsets of the same bytes."""
    n = len(end_a)
    cover_b = np.searchsorted(end_b, end_a)               # the B token over an A token's last byte
    cover_a = np.searchsorted(end_a, end_b)
    # a token of A that ends with its partner closes the group; else the partner reaches farther
    to = np.concatenate([np.where(end_b[cover_b] > end_a, n + cover_b, np.arange(n)), cover_a])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    closing = np.zeros(n, bool)
    closing[to] = True
    number = np.cumsum(closing) - 1
    return number[to[:n]], number[to[n:]]


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, in one array."""
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(len(starts)) - starts


def distinct_pairs(ids_a, ids_b, start_a, start_b, count_a, count_b, doc, n_b):
    """Distinct ``(doc, pair)`` of all links with their numbers: three arrays, sorted by doc and pair.

    The four ``start``/``count`` arrays and ``doc`` describe groups.  Small
    groups give their links; of a large one the distinct ids are multiplied."""
    docs, pairs, times = [], [], []

    def add(d, p, t):
        order = np.lexsort((p, d))
        d, p, t = d[order], p[order], t[order]
        first = np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1])]) if len(d) else np.zeros(0, bool)
        at = np.nonzero(first)[0]
        docs.append(d[at])
        pairs.append(p[at])
        times.append(np.add.reduceat(t, at) if len(at) else t)

    links = count_a * count_b
    small = np.nonzero(links <= FEW)[0]
    reach = np.cumsum(links[small])
    at = 0
    while at < len(small):
        to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + LINKS, "right")))
        g = small[at:to]
        each = np.repeat(g, links[g])
        k = _ranges(links[g])
        i, j = start_a[each] + k // count_b[each], start_b[each] + k % count_b[each]
        add(doc[each], ids_a[i] * n_b + ids_b[j], np.ones(len(i), np.int64))
        at = to
    for g in np.nonzero(links > FEW)[0]:
        a, times_a = np.unique(ids_a[start_a[g]:start_a[g] + count_a[g]], return_counts=True)
        b, times_b = np.unique(ids_b[start_b[g]:start_b[g] + count_b[g]], return_counts=True)
        rows = max(1, LINKS // len(b))
        for at in range(0, len(a), rows):
            p = (a[at:at + rows, None] * n_b + b[None, :]).ravel()
            add(np.full(len(p), doc[g]), p, (times_a[at:at + rows, None] * times_b[None, :]).ravel())
    if len(docs) > 1:
        d, p, t = np.concatenate(docs), np.concatenate(pairs), np.concatenate(times)
        docs, pairs, times = [], [], []
        add(d, p, t)
    return (docs[0], pairs[0], times[0]) if docs else (np.zeros(0, np.int64),) * 3


def align_slab(al: Aligner, texts: list) -> list[tuple]:
    """Per text ``(n_a, n_b, n_groups, n_links, groups, pairs, times)``: the groups
    written as text, the distinct pairs and how often each is linked, packed."""
    tokens = al.tokens_of(texts)
    len_a, len_b = (np.array([len(t[k]) // 4 for t in tokens], np.int64) for k in (0, 1))
    ids_a, ids_b = (np.frombuffer(b"".join(t[k] for t in tokens), "<u4").astype(np.int64) for k in (0, 1))
    if not len(ids_a):
        return [(0, 0, 0, 0, "", b"", b"")] * len(texts)
    group_a, group_b = label_groups(np.cumsum(al.width_a[ids_a]), np.cumsum(al.width_b[ids_b]))
    count_a, count_b = np.bincount(group_a), np.bincount(group_b)
    stop_a, stop_b = np.cumsum(count_a), np.cumsum(count_b)
    doc = np.repeat(np.arange(len(texts)), len_a)[stop_a - 1]
    n_groups = np.bincount(doc, minlength=len(texts))
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, doc, count_a * count_b)
    d, p, t = distinct_pairs(ids_a, ids_b, stop_a - count_a, stop_b - count_b, count_a, count_b, doc, al.n_b)
    edges = np.searchsorted(d, np.arange(len(texts) + 1))
    # the groups as text: A ids, a bar, B ids, a semicolon
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[stop_a - 1], last_b[stop_b - 1] = True, True
    words = np.empty(len(ids_a) + len(ids_b), object)
    words[np.arange(len(ids_a)) + (stop_b - count_b)[group_a]] = al.text_a[ids_a + al.n_a * last_a]
    words[np.arange(len(ids_b)) + stop_a[group_b]] = al.text_b[ids_b + al.n_b * last_b]
    ends = np.cumsum(len_a + len_b)
    out = []
    for i in range(len(texts)):
        s = slice(edges[i], edges[i + 1])
        times = t[s]
        kind = "<u4" if not len(times) or times.max() < 1 << 32 else "<u8"
        out.append((int(len_a[i]), int(len_b[i]), int(n_groups[i]), int(n_links[i]), "".join(words[ends[i] - len_a[i] - len_b[i]:ends[i]].tolist())[:-1],
                    p[s].astype(al.pair_type).tobytes(), times.astype(kind).tobytes()))
    return out


def _unpack_times(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u8" if n and len(raw) == 8 * n else "<u4").astype(np.int64)


def align(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str | None = None,
          vocabulary_b: str | None = None, with_groups: bool = True) -> DataFrame:
    """Per row: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``
    and, with ``with_groups``, ``groups``; packed ``pairs`` (ascending ``a * |B| + b``) and
    ``times``; ``chunk``, a label of bounded runs of rows.

    A (``tokenizers`` JSON, byte level) encodes a blank and the text, its
    special tokens being plain text; B (sentencepiece) the text, adding the
    blank itself.  A null or empty text, or one whose bytes either does not give
    back, has no tokens: zeros, no groups, an empty digest.  Repeated rows and
    null ids are rows of their own; no rows, no result; other columns are not carried.
    """
    ship_package(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()

    def slabs(batches):
        keys, texts, size = [], [], 0
        for b in batches:
            for k, t in zip(b.column(0), b.column(1)):
                text = t.as_py()
                keys.append(k.as_py())
                texts.append(text)
                size += len(text or "")
                if size >= SLAB:
                    yield keys, texts
                    keys, texts, size = [], [], 0
        if keys:
            yield keys, texts

    def run(batches):
        al = aligner(vocabulary_a or public_vocabulary(), vocabulary_b or public_vocabulary("piece_bpe_32k.model"))
        chunk, filled = TaskContext.get().partitionId() << 32, 0
        for keys, texts in slabs(batches):
            rows = align_slab(al, texts)
            chunks = []
            for r in rows:
                n = len(r[5]) // al.pair_type.itemsize
                if filled and filled + n > CHUNK:
                    chunk, filled = chunk + 1, 0
                filled += n
                chunks.append(chunk)
            digest = [hashlib.sha256(r[4].encode()).hexdigest() if r[4] else "" for r in rows]
            arrays = ([pa.array(keys, key_type(id_type))] + [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)] + [pa.array(digest)]
                      + [pa.array([r[4] for r in rows], pa.string())] * with_groups + [pa.array([r[i] for r in rows], pa.binary()) for i in (5, 6)] + [pa.array(chunks, pa.int64())])
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
                                             + ["groups"] * with_groups + ["pairs", "times", "chunk"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(df.schema[id_col].dataType)

    def key_type(_):
        return arrow_id

    schema = (f"`{id_col}` {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
              + ", groups string" * with_groups + ", pairs binary, times binary, chunk long")
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, pair_bytes: int = 4) -> DataFrame:
    """``pair``, ``n``: how many rows hold each pair.  Tasks sum what they hold before the shuffle."""
    def run(batches):
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting, size = [], 0

        def merged():
            k, at = np.unique(np.concatenate([keys, *waiting]), return_inverse=True)
            return k, np.bincount(at, np.concatenate([n, *(np.ones(len(w), np.int64) for w in waiting)]), len(k)).astype(np.int64)

        for b in batches:
            for raw in b.column(0):
                waiting.append(np.frombuffer(raw.as_py(), f"<u{pair_bytes}").astype(np.int64))
                size += len(waiting[-1])
                if size >= HELD:
                    keys, n = merged()
                    waiting, size = [], 0
                    if len(keys) >= HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])
                        keys, n = keys[:0], n[:0]
        keys, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _chunk_pairs(aligned: DataFrame, pair_bytes: int) -> DataFrame:
    """``chunk``, ``pair``: the distinct pairs of each chunk (twice where a file's split divides a chunk)."""
    def run(batches):
        now, waiting, size = None, [], 0

        def out():
            k = np.unique(np.concatenate(waiting))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), now, np.int64)), pa.array(k)], names=["chunk", "pair"])

        for b in batches:
            for c, raw in zip(b.column(0).to_pylist(), b.column(1)):
                if waiting and (c != now or size >= 2 * CHUNK):
                    yield out()
                    waiting, size = [], 0
                now = c
                waiting.append(np.frombuffer(raw.as_py(), f"<u{pair_bytes}").astype(np.int64))
                size += len(waiting[-1])
        if waiting:
            yield out()

    return aligned.select("chunk", "pairs").mapInArrow(run, "chunk long, pair long")


def align_and_count(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str | None = None, vocabulary_b: str | None = None) -> DataFrame:
    """:func:`align` without the groups' text, plus ``n_best`` (links whose pair's
    count is the highest of its A id, ties included) and ``count_sum`` (the counts
    summed over all links).  A pair's count is the number of rows that hold it linked."""
    ship_package(df.sparkSession)
    al = aligner(vocabulary_a or public_vocabulary(), vocabulary_b or public_vocabulary("piece_bpe_32k.model"))
    size, n_b = al.pair_type.itemsize, al.n_b
    aligned = stage(align(df, id_col, text_col, vocabulary_a, vocabulary_b, with_groups=False), "aligned")
    counts = stage(pair_counts(aligned, size), "pair-counts")
    a = F.expr(f"pair div {n_b}")
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))       # an A id has at most |B| pairs
    rated = counts.withColumn("a", a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    dictionary = _chunk_pairs(aligned, size).join(rated, "pair").select("chunk", "pair", "n", "best")
    keep = [id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def look_up(docs: pa.Table, known: pa.Table) -> pa.Table:
        pair, n, best = (known.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pair, kind="stable")
        pair, n, best = pair[order], n[order], best[order].astype(np.int64)
        n_best, count_sum = [], []
        for raw, times in zip(docs.column("pairs"), docs.column("times")):
            own = np.frombuffer(raw.as_py(), f"<u{size}").astype(np.int64)
            t = _unpack_times(times.as_py(), len(own))
            at = np.searchsorted(pair, own)
            n_best.append(int(t @ best[at]) if len(own) else 0)
            count_sum.append(int(t @ n[at]) if len(own) else 0)
        return pa.table([*(docs.column(c) for c in keep), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], names=[*keep, "n_best", "count_sum"])

    schema = ", ".join(f"`{c}` {t}" for c, t in aligned.select(*keep).dtypes) + ", n_best long, count_sum long"
    return aligned.select(*keep, "pairs", "times", "chunk").groupBy("chunk").cogroup(dictionary.groupBy("chunk")).applyInArrow(look_up, schema)
