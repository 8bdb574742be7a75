"""Repeated substrings by a depth-limited radix sort of suffixes.

A byte goes when it lies in a ``depth``-byte string that also starts earlier.
The suffixes of all texts are ordered only through their first ``depth``
bytes, most significant digit first, and a suffix that is alone in its group
leaves the sort; the groups left at full depth are exactly the repeated
strings.  Three digits do it:

1.  The *anchor*: the content-defined smallest ``GRAM``-byte gram of the
    string.  Equal strings have equal anchors at equal distances.
    Neighbouring suffixes share their anchor, so a run of them (some thirty)
    is one row of the shuffle instead of one row a byte.
2.  The run as a whole.  Equal runs are settled here: all but the first repeat
    in full.  A run that is alone under its anchor repeats nothing.
3.  What is left, runs that differ under one anchor, is sorted by the bytes
    themselves, eight at a time, inside the group.  An anchor with so many
    different runs that one task should not hold them has its strings grouped
    across the cluster by 128-bit digests instead.

All positions are judged on the input; only positions travel back to the
texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_width, stage, tidy

DEPTH = 100
GRAM = 24            # bytes of an anchor
GROUP = 1024         # different runs under one anchor that a task sorts together
SLAB = 1 << 18       # bytes of text whose anchors are found at once
ROWS = 1000          # texts whose runs are held at once,
RUNS = 200_000       # and about as many runs, whatever the texts
CUT_BYTES = 1 << 24  # of text whose result is held at once
WINDOWS = 250_000    # strings a task sorts at once
DUP, CONTESTED, HOT, FIRST = 0, 1, 2, 3

_rng = np.random.default_rng(6)
_TABLES = _rng.integers(0, 2 ** 64, (2, 256), dtype=np.uint64)
_BASES = [int(x) | 1 for x in _rng.integers(0, 2 ** 64, 2, dtype=np.uint64)]


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


class _Powers:
    """Powers of a base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2 ** 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, SLAB + 4096)         # no slab is longer
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        return self.up, self.down


_POWERS = [_Powers(b) for b in _BASES]


def anchored_runs(buf: np.ndarray, ends: np.ndarray, depth: int = DEPTH, gram: int = GRAM):
    """Runs of string starts that share their anchor: first start, number of
    starts, distance from the first start to the anchor, anchor hash, run hash.

    ``buf`` holds texts one after another, ``ends`` where each ends; no string crosses an end."""
    n = len(buf)
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if n < depth:
        return empty
    prefix = []
    for table, powers in zip(_TABLES, _POWERS):
        up, _ = powers.upto(n + 1)
        p = np.zeros(n + 1, np.uint64)
        np.cumsum(table[buf] * up[:n], out=p[1:])
        prefix.append(p)
    down = [powers.upto(n + 1)[1] for powers in _POWERS]
    grams = (prefix[0][gram:] - prefix[0][:-gram]) * down[0][:n - gram + 1]
    order = (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    least = (order << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)     # the leftmost of equals
    wide, span = depth - gram + 1, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[:len(least) - (wide - span)], least[wide - span:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(anchor))
    inside = starts + depth <= ends[np.searchsorted(ends, starts, "right")]
    change = anchor[1:] != anchor[:-1]
    opens, closes = np.ones(len(anchor), bool), np.ones(len(anchor), bool)
    opens[1:] = change | ~inside[:-1]
    closes[:-1] = change | ~inside[1:]
    first, last = np.nonzero(opens & inside)[0], np.nonzero(closes & inside)[0]
    run = (prefix[1][last + depth] - prefix[1][first]) * down[1][first]
    return first, last - first + 1, anchor[first] - first, grams[anchor[first]], run


def _slabs(texts: list[bytes], depth: int):
    """Texts in slabs of about ``SLAB`` bytes: of each part its text's index and its
    place there, the buffer, and where each part ends.  A long text comes in
    parts that overlap by ``depth - 1`` bytes, so that each string starts in
    one of them; a run that is cut so is only compared under its anchor."""
    parts, size = [], 0

    def slab():
        index, place = (np.array([p[i] for p in parts], np.int64) for i in (0, 1))
        return index, place, np.frombuffer(b"".join(p[2] for p in parts), np.uint8), np.cumsum([len(p[2]) for p in parts])

    for i, text in enumerate(texts):
        for place in range(0, max(len(text) - depth + 1, 0), SLAB):
            part = text[place:place + SLAB + depth - 1]
            if parts and size + len(part) > SLAB:
                yield slab()
                parts, size = [], 0
            parts.append((i, place, part))
            size += len(part)
    if parts:
        yield slab()


def _pack(start, n, ahead):
    return (start.astype(np.int64) << 16) | (n.astype(np.int64) << 8) | ahead


def _unpack(packed):
    return packed >> 16, (packed >> 8) & 0xFF, packed & 0xFF


def _raw(column) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in column]


_NAMES = ["settled", "b", "r", "id", "tag", "at"]


def _folded(i, t, at):
    """Runs of the same texts with runs that follow each other joined, 255 starts a row at most."""
    start, n, _ = _unpack(at)
    order = np.lexsort((start, t, i))
    i, t, start, n = (x[order] for x in (i, t, start, n))
    opens = np.ones(len(i), bool)
    opens[1:] = (i[1:] != i[:-1]) | (t[1:] != t[:-1]) | (start[1:] != start[:-1] + n[:-1])
    first = np.nonzero(opens)[0]
    length = np.add.reduceat(n, first) if len(first) else n
    rows = -(-length // 255)
    of = np.repeat(np.arange(len(first)), rows)
    skip = 255 * (np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows))
    first = first[of]
    return i[first], t[first], _pack(start[first] + skip, np.minimum(length[of] - skip, 255), 0)


def _runs_of(batches, depth, gram):
    """A row per run; those whose equal comes before them among the runs held together are settled on the
    spot, and joined where they follow each other.  Held are the runs of up to ``ROWS`` texts, ``RUNS`` or a slab more."""

    def rows_of(found):
        i, t, at, h, r = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((at, t, i, r, h))
        i, t, at, h, r = (x[order] for x in (i, t, at, h, r))
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
        done = _folded(i[again], t[again], at[again])
        dealt = done[0] * np.int64(-7046029254386353131) + done[2]     # settled rows go anywhere
        new = ~again
        for settled, columns in ((True, (dealt, np.zeros(len(dealt), np.int64), *done)), (False, (h[new], r[new], i[new], t[new], at[new]))):
            for lo in range(0, len(columns[0]), 50_000):
                part = [pa.array(c[lo:lo + 50_000]) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), settled)), *part], names=_NAMES)

    for b in (whole.slice(lo, ROWS) for whole in batches for lo in range(0, whole.num_rows, ROWS)):
        ids, tags, texts = b.column(0).to_numpy(), b.column(2).to_numpy(), _raw(b.column(1))
        found, held = [], 0
        for index, place, buf, ends in _slabs(texts, depth):
            first, n, ahead, h, r = anchored_runs(buf, ends, depth, gram)
            part = np.searchsorted(ends, first, "right")
            begin = np.concatenate([[0], ends[:-1]])[part]
            found.append((ids[index[part]], tags[index[part]], _pack(first - begin + place[part], n, ahead), h.view(np.int64), r.view(np.int64)))
            held += len(first)
            if held >= RUNS:
                yield from rows_of(found)
                found, held = [], 0
        if found:
            yield from rows_of(found)


def _settle(batches, group):
    """Rows sorted by anchor, run, document and position -> what is known of each run that may repeat.

    Holds at most ``group`` rows of one anchor."""
    def out(i, t, at, what):
        return pa.RecordBatch.from_arrays([pa.array(i), pa.array(t), pa.array(at), pa.array(np.full(len(i), what, np.int32))], names=["id", "tag", "at", "what"])

    key = run = None
    held: list[tuple] = []     # first rows of the runs under ``key`` so far
    n_held, hot = 0, False
    for b in batches:
        settled = b.column(0).to_numpy(zero_copy_only=False).astype(bool)
        h, r, i, t, at = (c.to_numpy() for c in b.columns[1:])
        if settled.any():
            yield out(i[settled], t[settled], at[settled], DUP)
            h, r, i, t, at = (x[~settled] for x in (h, r, i, t, at))
        if not len(h):
            continue
        same_h = np.concatenate([[key is not None and h[0] == key], h[1:] == h[:-1]])
        same = same_h & np.concatenate([[run is not None and r[0] == run], r[1:] == r[:-1]])
        key, run = h[-1], r[-1]
        if same.any():
            yield out(i[same], t[same], at[same], DUP)
        fresh = ~same
        if not fresh.any():
            continue
        goes_on = same_h[fresh]
        i, t, at = i[fresh], t[fresh], at[fresh]
        cuts = np.nonzero(~goes_on)[0]
        # the rows before the first cut belong to the anchor held from the batch before
        head = cuts[0] if len(cuts) else len(i)
        if head:
            held.append((i[:head], t[:head], at[:head]))
            n_held += head
        if n_held > group:
            hot = True
        if hot and held:
            yield out(*(np.concatenate(x) for x in zip(*held)), HOT)
            held = []
        if not len(cuts):
            continue
        if n_held > 1 and held:
            yield out(*(np.concatenate(x) for x in zip(*held)), CONTESTED)
        bounds = np.concatenate([cuts, [len(i)]])
        sizes = np.diff(bounds)
        each = np.repeat(sizes[:-1], sizes[:-1])
        body = slice(cuts[0], cuts[-1])
        for what, pick in ((CONTESTED, (each > 1) & (each <= group)), (HOT, each > group)):
            if pick.any():
                yield out(i[body][pick], t[body][pick], at[body][pick], what)
        held, n_held, hot = [(i[cuts[-1]:], t[cuts[-1]:], at[cuts[-1]:])], int(sizes[-1]), False
    if n_held > 1 and held:
        yield out(*(np.concatenate(x) for x in zip(*held)), HOT if hot or n_held > group else CONTESTED)


def _strings(batches, depth, gram):
    """The bytes of contested runs under their anchor; of runs of hot anchors, digests of every string."""
    names = ["what", "g", "g2", "id", "tag", "at", "bytes"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch():
        done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        rows.clear()
        return done

    rows: list[tuple] = []
    for b in batches:
        for i, text, tag, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3)):
            text = text.as_py().encode("utf-8", "surrogatepass")
            for at, what in ((x, y) for lo in range(0, len(runs), 10_000)
                             for x, y in zip(*(runs.values.field(c)[lo:lo + 10_000].to_pylist() for c in ("at", "what")))):
                start, n, ahead = _unpack(at)
                if what == CONTESTED:
                    g = xxhash.xxh64_intdigest(text[start + ahead:start + ahead + gram])
                    rows.append((CONTESTED, g - (1 << 63), 0, i, tag, at, text[start:start + n - 1 + depth]))
                else:
                    for s in range(start, start + n):
                        d = xxhash.xxh3_128_intdigest(text[s:s + depth])
                        rows.append((HOT, (d >> 64) - (1 << 63), (d & (2 ** 64 - 1)) - (1 << 63), i, tag, s << 16 | 1 << 8, None))
                if len(rows) >= 20_000:
                    yield batch()
    if rows:
        yield batch()


def radix_repeats(texts: list[bytes], group: np.ndarray, n: np.ndarray, ahead: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """``(run, start)`` of every string of the runs that an earlier run of its group also holds.

    Runs are given in order; a group's strings compare at equal distance to the
    anchor.  Most significant digit first, eight bytes a digit; strings alone
    in their group leave after every pass."""
    data = b"".join(texts) + b"\0" * 8
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]
    run = np.repeat(np.arange(len(texts)), n)
    start = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    where = base[run] + start
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    alive = np.arange(len(run))
    key = group[run].astype(np.int64) * 1024 + (ahead[run] - start)
    digits = [*range(0, depth - 7, 8)] + ([depth - 8] if depth % 8 else [])      # the last may overlap the one before
    digit = None
    for d in [None, *digits]:
        if d is not None:
            digit = words[where[alive] + d].astype(np.uint64)
            order = np.lexsort((digit, key))
        else:
            order = np.argsort(key, kind="stable")
        alive, key = alive[order], key[order]
        new = np.ones(len(alive), bool)
        new[1:] = key[1:] != key[:-1]
        if d is not None:
            digit = digit[order]
            new[1:] |= digit[1:] != digit[:-1]
        label = np.cumsum(new) - 1
        many = np.bincount(label, minlength=1)[label] > 1 if len(label) else np.zeros(0, bool)
        alive, key = alive[many], label[many]
        if not len(alive):
            break
    later = np.zeros(len(alive), bool)
    later[1:] = key[1:] == key[:-1]                    # stable: the first of a group is the earliest run
    again = np.sort(alive[later])
    return run[again], start[again]


def _sort_groups(batches, depth):
    """Contested runs sorted by anchor, document and position -> repeated strings as runs of them."""
    held: dict[str, list] = {"g": [], "id": [], "tag": [], "at": [], "bytes": []}

    def close():
        g, i, t, at = (np.concatenate(held[c]) for c in ("g", "id", "tag", "at"))
        texts = [x for part in held["bytes"] for x in part]
        start, n, ahead = _unpack(at)
        _, dense = np.unique(g, return_inverse=True)
        run, s = radix_repeats(texts, dense, n, ahead, depth)
        if not len(run):
            return None
        opens = np.ones(len(run), bool)
        opens[1:] = (run[1:] != run[:-1]) | (s[1:] != s[:-1] + 1)
        first = np.nonzero(opens)[0]
        length = np.diff(np.concatenate([first, [len(run)]]))
        run, s = run[first], s[first]
        return pa.RecordBatch.from_arrays([pa.array(i[run]), pa.array(t[run]), pa.array(_pack(start[run] + s, length, 0)), pa.array(np.full(len(run), DUP, np.int32))],
                                          names=["id", "tag", "at", "what"])

    waiting = 0
    for b in batches:
        g = b.column("g").to_numpy()
        at = b.column("at").to_numpy()
        if not len(g):
            continue
        cuts = np.nonzero(g[1:] != g[:-1])[0] + 1
        size = np.cumsum(_unpack(at)[1])
        lo = 0
        while True:
            # up to the last cut that keeps the slab small, or the first one after it
            ends = cuts[cuts > lo]
            last = held["g"][-1][-1] if held["g"] else None
            if last is not None and waiting >= WINDOWS and g[lo] != last:
                done = close()
                for v in held.values():
                    v.clear()
                waiting = 0
                if done is not None:
                    yield done
            spent = size[lo - 1] if lo else 0
            fits = ends[size[ends - 1] - spent + waiting <= WINDOWS]
            hi = int(fits[-1]) if len(fits) else int(ends[0]) if len(ends) else len(g)
            if len(fits) and hi == int(ends[-1]) and size[-1] - spent + waiting <= WINDOWS:
                hi = len(g)
            for c, col in (("g", g), ("id", b.column("id").to_numpy()), ("tag", b.column("tag").to_numpy()), ("at", at)):
                held[c].append(col[lo:hi])
            held["bytes"].append(b.column("bytes").slice(lo, hi - lo).to_pylist())
            waiting += int(size[hi - 1] - spent)
            if hi >= len(g):
                break
            # a cut follows: what is held is whole groups
            done = close()
            for v in held.values():
                v.clear()
            waiting = 0
            if done is not None:
                yield done
            lo = hi
    if held["g"]:
        done = close()
        if done is not None:
            yield done


def repeated_strings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, gram: int = GRAM, group: int = GROUP, repeated: bool | None = None) -> DataFrame:
    """``id``, ``tag``, ``found`` (array of ``at``, ``what``) of every text with repeats; see :func:`remove_repeats`."""
    if not 16 <= gram <= depth - 8 or depth > 200:
        raise ValueError("16 <= gram <= depth - 8, depth <= 200")
    spark = df.sparkSession
    width = shuffle_width(spark)
    if repeated is None:
        repeated = _ids_repeat(df, id_col, text_col)
    texts = (_taking_part(df, id_col, text_col)
             .select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), _tag(text_col, repeated).alias("tag")))
    if repeated:        # a row repeated in full must not count as a repeat of itself
        texts = texts.dropDuplicates(["id", "tag"])
    runs = texts.mapInArrow(tidy(lambda bs: _runs_of(bs, depth, gram)), "settled boolean, b long, r long, id long, tag long, at long")
    known = stage(runs.repartition(width, "b").sortWithinPartitions("settled", "b", "r", "id", "tag", "at")
                  .mapInArrow(tidy(lambda bs: _settle(bs, group)), "id long, tag long, at long, what int"), "suffix-runs")
    # back to the texts of contested runs for their bytes
    open_runs = known.where(F.col("what") != DUP).groupBy("id", "tag").agg(F.collect_list(F.struct("at", "what")).alias("runs"))
    strings = stage(texts.join(open_runs, ["id", "tag"]).select("id", "text", "tag", "runs")
                    .mapInArrow(tidy(lambda bs: _strings(bs, depth, gram)), "what int, g long, g2 long, id long, tag long, at long, bytes binary"), "suffix-strings")
    sorted_out = stage(strings.where(F.col("what") == CONTESTED).select("g", "id", "tag", "at", "bytes")
                       .repartition(width, "g").sortWithinPartitions("g", "id", "tag", "at")
                       .mapInArrow(tidy(lambda bs: _sort_groups(bs, depth)), "id long, tag long, at long, what int"), "suffix-sorted")
    firsts = (strings.where(F.col("what") == HOT).groupBy("g", "g2").agg(F.min(F.struct("id", "tag", "at")).alias("m"))
              .select("m.*", F.lit(FIRST).alias("what")))
    found = known.where(F.col("what") != CONTESTED).unionByName(sorted_out).unionByName(firsts)
    return found.groupBy("id", "tag").agg(F.collect_list(F.struct("at", "what")).alias("found"))


def _taking_part(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())


def _ids_repeat(df: DataFrame, id_col: str, text_col: str) -> bool:
    """Whether some id has several rows that take part."""
    ids = _taking_part(df, id_col, text_col).groupBy(F.col(id_col).cast("long").alias("id"))
    return bool(ids.agg(F.count("*").alias("n")).where("n > 1").limit(1).count())


def _tag(text_col: str, repeated: bool):
    """The column that tells texts of one id apart: 64 bits of the text's hash, 0 where no id has several rows."""
    return F.xxhash64(text_col) if repeated else F.lit(0).cast("long")


def removed_spans(at: np.ndarray, what: np.ndarray, depth: int = DEPTH) -> list[tuple[int, int]]:
    """Maximal removed runs ``[from, to)`` of a text from what was found of its strings."""
    start, n, _ = _unpack(at)
    hot = what == HOT
    single = np.repeat(start[hot], n[hot]) + np.arange(n[hot].sum()) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
    single = np.setdiff1d(single, start[what == FIRST])
    start = np.concatenate([start[what == DUP], single])
    if not len(start):
        return []
    end = np.concatenate([start[:(what == DUP).sum()] + n[what == DUP], single + 1]) + depth - 1
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    opens = np.concatenate([[0], np.nonzero(start[1:] > reach[:-1])[0] + 1])
    closes = np.concatenate([opens[1:] - 1, [len(start) - 1]])
    return [(int(a), int(b)) for a, b in zip(start[opens], reach[closes])]


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` shrunk so that no UTF-8 character is cut."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes) and ``kept_text``.

    Every byte of the UTF-8 text goes that lies in a ``depth``-byte string
    which also starts earlier: in a smaller id, or earlier in the same text.
    Strings never cross texts and are judged on the input.  ``kept_text`` keeps
    a character that would only be lost in part.  Rows repeated in full are one
    text, judged once (each is cut alike); rows with one id and different texts come in the
    order of a hash of the text.  A null text counts as empty (``kept_text``
    stays null); rows with a null id keep everything and take nothing from
    others.  No rows: no rows.  Columns named like the new ones are replaced.
    """
    new = ["n_bytes", "n_removed", "n_spans", "kept", "kept_text"]
    names = [c for c in df.columns if c not in new]
    repeated = _ids_repeat(df, id_col, text_col)
    found = repeated_strings(df, id_col, text_col, depth, gram, group, repeated)
    joined = (df.select(*names).withColumn("__tributary_own", F.when(F.col(text_col).isNotNull(), _tag(text_col, repeated)))
              .join(found.toDF("__tributary_id", "__tributary_tag", "__tributary_found"), (F.col(id_col).cast("long") == F.col("__tributary_id")) & (F.col("__tributary_own") == F.col("__tributary_tag")), "left")
              .select(*names, "__tributary_found"))
    at = names.index(text_col)

    def cut(batches):
        def rows(lo, hi, out):
            return pa.RecordBatch.from_arrays([*(b.column(i).slice(lo, hi - lo) for i in range(len(names))),
                                               *(pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())))],
                                              names=[*names, *new])

        for b in batches:
            out: list[list] = [[], [], [], [], []]
            lo = size = 0
            for k, (text, f) in enumerate(zip(b.column(at), b.column(len(names)))):
                if size >= CUT_BYTES:
                    yield rows(lo, k, out)
                    out, lo, size = [[], [], [], [], []], k, 0
                text = text.as_py()
                raw = (text or "").encode("utf-8", "surrogatepass")
                spans = []
                if f.is_valid and len(f):
                    v = f.values
                    spans = removed_spans(v.field("at").to_numpy(), v.field("what").to_numpy(), depth)
                kept = without(raw, spans)
                told = text if not spans else without(raw, whole_characters(raw, spans)).decode("utf-8", "replace")
                for o, x in zip(out, (len(raw), len(raw) - len(kept), len(spans), kept, told)):
                    o.append(x)
                size += len(raw)
            yield rows(lo, b.num_rows, out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema.fields)
    return joined.mapInArrow(tidy(cut), schema + ", n_bytes long, n_removed long, n_spans long, kept binary, kept_text string")
