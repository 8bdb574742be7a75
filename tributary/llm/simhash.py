"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has a bit set where over half of its shingles' hashes
have it.  Equal fingerprints are one class.  To find all classes within ``d``
bits, the 64 bits are split into parts and each part gets its own threshold;
two fingerprints within ``d`` bits agree within the threshold in at least one
part whenever the thresholds add up to ``d - parts + 1``.  Bits that vary
together are put in one part, so that the other parts tell more, and the
thresholds are chosen by dynamic programming on the estimated number of
candidates of every (part, threshold).  A part probed with threshold t looks
its value up with up to t bits flipped.

Near copies can make a bucket of any size.  A bucket is compared in blocks of
bounded size, and a task gives back the links of a spanning forest of what it
compared, never all pairs: components need no more.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import shuffle_width, stage, text_key, tidy

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
BLANK = re.compile("[\\x20\\x09-\\x0D]")
LOWER = {c: c + 32 for c in range(65, 91)}
BLOCK = 2048          # fingerprints of a bucket compared in one block
PART = 1 << 18        # characters of a text whose words are held at once
KEY = ("__tributary_a", "__tributary_b")     # a text's hashes beside its fingerprint


def simhash(text: str | None, k: int = 4) -> int:
    """64-bit fingerprint of all ``k``-word shingles, repeats included.

    A-Z are lower-cased; fewer than ``k`` words: the whole sequence; no word
    (or null): zero.  Words of a part of ``PART`` characters are held at once."""
    text = (text or "").translate(LOWER)
    counts, n, words, at = np.zeros(64, np.int64), 0, [], 0

    def count(shingles):
        hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], ">u8")
        counts[:] += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        return len(shingles)

    while at < len(text):                       # a long text in parts that end between words
        cut = BLANK.search(text, at + PART) if len(text) - at > PART else None
        end = cut.start() if cut else len(text)
        words += WORD.findall(text, at, end)
        if len(words) >= k:
            n += count([" ".join(words[i:i + k]) for i in range(len(words) - k + 1)])
            words = words[len(words) - k + 1:]
        at = end
    if not n and words:
        n = count([" ".join(words)])
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big") if n else 0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, with_key: bool = False) -> DataFrame:
    """``id_col``, ``fp`` (the 64 bits as a signed long) per row of ``df``; a null text has fingerprint zero.

    ``with_key``: also ``KEY``, the text's hashes."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = np.array([simhash(t.as_py(), k) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps), *b.columns[2:]], names=[id_col, "fp", *beside])

    beside = list(KEY) if with_key else []
    keys = [text_key(text_col)[part].alias(c) for c, part in zip(beside, "ab")]
    return (df.select(F.col(id_col), F.col(text_col), *keys)
            .mapInArrow(tidy(run), f"`{id_col}` {id_type}, fp long" + "".join(f", {c} long" for c in beside)))


# --- the partition of the bits and its thresholds ----------------------------------------------

def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are and how often each two bits are set together (64 x 64 counts, summed in the tasks)."""
    def run(batches):
        both, n = np.zeros((64, 64), np.int64), 0
        for b in batches:
            bits = _bits(b.column(0).to_numpy()).astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array(range(4096), pa.int32()), pa.array(both.ravel()), pa.array([n] * 4096, pa.int64())], names=["cell", "n_both", "n"])

    rows = (fps.select("fp").mapInArrow(tidy(run), "cell int, n_both long, n long")
            .groupBy("cell").agg(F.sum("n_both").alias("n_both"), F.sum("n").alias("n")).collect())
    both = np.zeros(4096)
    for r in rows:
        both[r["cell"]] = r["n_both"]
    return int(rows[0]["n"]) if rows else 0, both.reshape(64, 64)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits (0: the highest) in ``parts`` groups of near equal size, those that vary together in one group (greedy)."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, out = set(range(64)), []
    for p in range(parts):
        size = -(-len(free) // (parts - p))
        pair = max(((corr[i, j], -i, -j) for i in free for j in free if i < j), default=None)
        group = [-pair[1], -pair[2]] if pair else list(free)[:1]
        while len(group) < size:
            rest = sorted(free - set(group))
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        out.append(sorted(group[:size]))
        free -= set(out[-1])
    return out


def expected_candidates(n: int, both: np.ndarray, group: list[int], threshold: int) -> float:
    """Pairs of fingerprints expected to differ in at most ``threshold`` bits of
    ``group``: every bit tells two texts apart with its own probability."""
    if threshold < 0:
        return 0.0
    share = np.diag(both)[group] / max(n, 1)
    differ = np.zeros(threshold + 2)
    differ[0] = 1
    for p in 2 * share * (1 - share):
        differ[1:] = differ[1:] * (1 - p) + differ[:-1] * p
        differ[0] *= 1 - p
        differ[-1] = 0
    return float(n) * (n - 1) / 2 * float(differ[:threshold + 1].sum())


def allocate(n: int, both: np.ndarray, groups: list[list[int]], distance: int) -> tuple[list[int], float]:
    """Thresholds (-1: the part is not used) adding up to ``distance - parts + 1`` with the least
    expected cost, by dynamic programming; cost: candidates compared and rows probed."""
    def cost(i: int, t: int) -> float:
        return expected_candidates(n, both, groups[i], t) + 30.0 * n * sum(comb(len(groups[i]), e) for e in range(t + 1)) if t >= 0 else 0.0

    total, m = distance - len(groups) + 1, len(groups)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(m):
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, distance + 1):
                now = (c + cost(i, t), [*ts, t])
                if used + t not in after or now[0] < after[used + t][0]:
                    after[used + t] = now
        best = after
    return best[total][1], best[total][0]


def choose_partition(n: int, both: np.ndarray, distance: int) -> tuple[list[list[int]], list[int]]:
    """The cheapest of 2 to ``distance + 1`` parts with its thresholds."""
    options = []
    for parts in range(max(1, min(2, distance + 1)), distance + 2):
        groups = group_bits(n, both, parts)
        thresholds, c = allocate(n, both, groups, distance)
        options.append((c, parts, groups, thresholds))
    _, _, groups, thresholds = min(options)
    return groups, thresholds


# --- candidates, verified links ----------------------------------------------------------------

def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links ``a[i]-b[i]`` (indices)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def _links(left: np.ndarray, right: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest between two blocks of fingerprints, all compared, in slabs."""
    values, inverse = np.unique(np.concatenate([left, right]), return_inverse=True)
    li, ri = inverse[:len(left)], inverse[len(left):]
    links: list[tuple[int, int]] = []
    ru = right.view(np.uint64)
    step = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), step):
        near = np.bitwise_count(left[at:at + step].view(np.uint64)[:, None] ^ ru[None, :]) <= distance
        i, j = np.nonzero(near)
        links += _forest(li[i + at], ri[j])
    if links:
        x, y = np.array(links).T
        links = _forest(x, y)
    return [(int(values[x]), int(values[y])) for x, y in links]


def near_links(fps: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all fingerprints within ``distance`` bits.

    ``fps``: one row per distinct fingerprint, column ``fp`` (long).  Every
    linked pair is within the distance; pairs already connected by other
    links may be left out.  Empty input: no links."""
    spark = fps.sparkSession
    n, both = bit_statistics(fps)
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    groups, thresholds = choose_partition(n, both, distance)

    def signatures(batches):
        """A row for each (part, value looked up): role 0 where the value is the fingerprint's own."""
        for b in batches:
            fp = b.column(0).to_numpy()
            u = fp.view(np.uint64)
            for part, (bits, t) in enumerate(zip(groups, thresholds)):
                if t < 0:
                    continue
                masks = [np.uint64(1 << (63 - x)) for x in bits]
                own = u & reduce(np.bitwise_or, masks)
                for e in range(t + 1):
                    for flips in combinations(masks, e):
                        value = own ^ reduce(np.bitwise_xor, flips, np.uint64(0))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part] * len(fp), pa.int32()), pa.array(value.view(np.int64)), b.column(0), pa.array([int(e > 0)] * len(fp), pa.int32())],
                            names=["part", "value", "fp", "probe"])

    signed = stage(fps.select("fp").mapInArrow(tidy(signatures), "part int, value long, fp long, probe int"), "simhash-signatures")
    # buckets worth comparing: a stored fingerprint and another row; a large bucket is cut into blocks
    sizes = (signed.groupBy("part", "value").agg(F.count("*").alias("rows"), F.sum(1 - F.col("probe")).alias("stored"))
             .where((F.col("stored") > 0) & (F.col("rows") > 1))
             .select("part", "value", F.ceil(F.col("stored") / block).cast("int").alias("sb"),
                     F.ceil(F.col("rows") / block).cast("int").alias("rb")))
    bucketed = signed.join(sizes, ["part", "value"])
    hashed = F.xxhash64("fp", F.lit(11))
    # each stored row goes to its block against every block of rows, each row to its block against every stored block
    stored = (bucketed.where("probe = 0")
              .withColumn("s", F.pmod(hashed, F.col("sb")).cast("int"))
              .withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)))
              .select("part", "value", "s", "r", "fp", F.lit(1).alias("side")))
    rows = (bucketed.withColumn("r", F.pmod(hashed, F.col("rb")).cast("int"))
            .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("sb") - 1)))
            .select("part", "value", "s", "r", "fp", F.lit(0).alias("side")))
    width = shuffle_width(spark)
    keys = ["part", "value", "s", "r"]
    dealt = stored.unionByName(rows).repartition(width, *keys).sortWithinPartitions(*keys)

    def compare(batches):
        held: list[pd.DataFrame] = []
        last = None

        def close(frame):
            left, right = frame.fp[frame.side == 1].to_numpy(), frame.fp[frame.side == 0].to_numpy()
            return _links(left, right, distance) if len(left) and len(right) else []

        out: list[tuple[int, int]] = []
        for b in batches:
            frame = b.to_pandas()
            if not len(frame):
                continue
            ks = frame[keys].to_numpy()
            cuts = [0, *(np.nonzero((ks[1:] != ks[:-1]).any(axis=1))[0] + 1).tolist(), len(frame)]
            for lo, hi in zip(cuts, cuts[1:]):
                key = tuple(ks[lo])
                if last is not None and key != last and held:
                    whole = pd.concat(held) if len(held) > 1 else held[0]
                    held = []
                    if len(whole) > 2:
                        out += close(whole)
                last = key
                held.append(frame.iloc[lo:hi])
            if out:
                yield _pairs(out)
                out = []
        if held:
            out += close(pd.concat(held))
        yield _pairs(out)

    return dealt.mapInArrow(tidy(compare), "a long, b long").distinct()


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())], names=["a", "b"])


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, distance: int = 4) -> DataFrame:
    """``id_col``, ``fp`` and ``component`` (the smallest id reachable over links, itself included) per row of ``df``.

    Null and wordless texts have fingerprint zero and link like any other;
    repeated rows are rows of one class; rows with a null id get their class's
    component but never name one (a component of null ids only has component
    null).  No rows: no rows.  Columns beside the two are not read.
    """
    return _in_components(stage(fingerprints(df, id_col, text_col, k), "simhash"), id_col, distance).select(id_col, "fp", "component")


def _in_components(marked: DataFrame, id_col: str, distance: int) -> DataFrame:
    """``marked`` with ``component`` and ``first_fp``, the smallest fingerprint that the component's smallest id has in it."""
    classes = stage(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-classes")
    from .components import components

    roots = components(near_links(classes.select("fp"), distance))
    named = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = F.min(F.when(F.col("least").isNotNull(), F.struct("least", "fp")))
    least = named.groupBy("root").agg(first.alias("first")).select("root", F.col("first.least").alias("component"), F.col("first.fp").alias("first_fp"))
    by_class = stage(named.select("fp", "root").join(least, "root").select("fp", "component", "first_fp"), "simhash-components")
    return marked.join(by_class, "fp")


def first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, distance: int = 4) -> DataFrame:
    """One document of each component: the rows of ``df`` with its smallest id
    and, of that id's fingerprints in the component, the smallest.

    All rows that repeat that id and fingerprint stay; of rows without any id
    in their component, all stay, as do all rows with a null id.  Each text of
    an id is judged by its own component, whatever becomes of the id's others."""
    marked = _in_components(stage(fingerprints(df, id_col, text_col, k, with_key=True), "simhash"), id_col, distance)
    # the rows that go are told by id and the text's hashes, so that no fingerprint is made twice
    gone = (marked.where(F.col(id_col).isNotNull() & ((F.col(id_col) != F.col("component")) | (F.col("fp") != F.col("first_fp"))))
            .select(id_col, *KEY).distinct())
    own = text_key(text_col)
    return (df.withColumn(KEY[0], own["a"]).withColumn(KEY[1], own["b"])
            .join(gone, [id_col, *KEY], "left_anti").drop(*KEY))
