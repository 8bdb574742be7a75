"""Best-fit packing with large-item matching.

Pieces above a third of the capacity can share a sequence with one other such
piece at most, so they are matched greedily (the largest with the largest that
still fits); smaller pieces, the largest first, go into the tightest gap that
takes them.  Pieces of one length are interchangeable, so the decisions need
only the *histogram* of lengths - at most ``capacity`` counts however large
the corpus - and the plan is a list of rank intervals per length.  Spark counts
the lengths, numbers the pieces of each length across the cluster, and each
piece looks its place up by its number.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import shuffle_width, stage, tidy


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Placement intervals ``(length, first_rank, n, sequence, per_sequence, offset)``.

    The n pieces of a length with ranks from ``first_rank`` go ``per_sequence``
    at a time into consecutive sequences from ``sequence``, the first of each
    at ``offset``.  Deterministic; the number of intervals depends on the
    number of distinct lengths only.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    left = {n: c for n, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}       # gap -> (first sequence, how many), offset being capacity - gap
    order: list[int] = []                             # the gaps in use, ascending
    sequences = 0

    def open_gap(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    def place(length: int, n: int, sequence: int, per: int, offset: int) -> None:
        out.append((length, rank[length], n, sequence, per, offset))
        rank[length] += n
        left[length] -= n

    large = sorted(n for n in left if 3 * n > capacity)
    partners = [n for n in large if n <= capacity // 2 or capacity - n >= large[0]]
    for length in reversed(large):
        while left[length]:
            while partners and not left[partners[-1]]:
                partners.pop()
            i = bisect_left(partners, capacity - length + 1) - 1
            while i >= 0 and not left[partners[i]]:
                partners.pop(i)
                i -= 1
            mate = partners[i] if i >= 0 else None
            if mate is None or (mate == length and left[length] == 1):
                # nothing left to share with (a lone middle-sized piece looks one size down)
                if mate == length:
                    below = [n for n in partners[:i] if left[n]]
                    if below:
                        place(length, 1, sequences, 1, 0)
                        place(below[-1], 1, sequences, 1, length)
                        open_gap(capacity - length - below[-1], sequences, 1)
                        sequences += 1
                        continue
                n = left[length]
                place(length, n, sequences, 1, 0)
                open_gap(capacity - length, sequences, n)
            elif mate == length:
                n = left[length] // 2
                place(length, 2 * n, sequences, 2, 0)
                open_gap(capacity - 2 * length, sequences, n)
            else:
                n = min(left[length], left[mate])
                place(length, n, sequences, 1, 0)
                place(mate, n, sequences, 1, length)
                open_gap(capacity - length - mate, sequences, n)
            sequences += n
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            i = bisect_left(order, length)
            if i == len(order):
                per = capacity // length
                n = -(-left[length] // per)
                open_gap(capacity, sequences, n)
                sequences += n
                continue
            gap = order[i]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(i)
            per = min(gap // length, left[length])
            used = min(n, left[length] // per)
            place(length, used * per, first, per, capacity - gap)
            open_gap(gap - per * length, first, used)
            open_gap(gap, first + used, n - used)
    return out


def pack(pieces: DataFrame, capacity: int = 1024, length_col: str = "length", order_by: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences of at
    most ``capacity`` as best fit finds, each filled gapless from 0.

    Rows whose ``length_col`` is not 1 to ``capacity`` (null, 0, too long) have
    no place: both columns are null.  Ties (pieces of one length) are numbered by ``order_by`` within a
    hash bucket of it; fully equal rows get different places in any order.  No
    rows: no sequences.  Columns of the names ``sequence_id`` and ``offset``
    in the input are replaced.  No task sees more than its share of a length: the buckets split a length that
    holds most of the corpus, and the driver sees ``capacity`` counts.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*kept)
    n_buckets = max(64, 4 * shuffle_width(spark))
    checked = F.when(F.col(length_col).between(1, capacity), F.col(length_col))
    written = stage(pieces.withColumn("__tributary_bucket", F.pmod(F.xxhash64(*order_by), F.lit(n_buckets)).cast("int"))
                   .withColumn("__tributary_length", checked.cast("int")), "pack")
    staged = written.where(F.col("__tributary_length").isNotNull())
    # the pieces of each length before each bucket: lengths x buckets rows at most
    per_bucket = staged.groupBy("__tributary_length", "__tributary_bucket").agg(F.count("*").alias("n"))
    counts = {r["__tributary_length"]: r["n"] for r in per_bucket.groupBy("__tributary_length").agg(F.sum("n").alias("n")).collect()}
    before = per_bucket.select(
        "__tributary_length", "__tributary_bucket",
        (F.sum("n").over(Window.partitionBy("__tributary_length").orderBy("__tributary_bucket")) - F.col("n")).alias("__tributary_before"))
    within = F.row_number().over(Window.partitionBy("__tributary_bucket", "__tributary_length").orderBy(*order_by))
    ranked = (staged.withColumn("__tributary_within", within)
              .join(before, ["__tributary_bucket", "__tributary_length"])
              .withColumn("__tributary_rank", F.col("__tributary_before") + F.col("__tributary_within") - 1))
    plan = plan_packing(counts, capacity)
    by_length: dict[int, np.ndarray] = {}
    for row in plan:
        by_length.setdefault(row[0], []).append(row)
    by_length = {k: np.asarray(sorted(v, key=lambda r: r[1]), dtype=np.int64) for k, v in by_length.items()}

    def places(batches):
        for b in batches:
            length, rank = b.column("__tributary_length").to_numpy(), b.column("__tributary_rank").to_numpy()
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                at = np.nonzero(length == n)[0]
                p = by_length[int(n)]
                row = p[np.searchsorted(p[:, 1], rank[at], "right") - 1]
                j = rank[at] - row[:, 1]
                seq[at] = row[:, 3] + j // row[:, 4]
                off[at] = row[:, 5] + j % row[:, 4] * n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(seq), pa.array(off)],
                                             names=[*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"
    placed = ranked.select(*kept, "__tributary_length", "__tributary_rank").mapInArrow(tidy(places), schema)
    none = F.lit(None).cast("long")
    return placed.unionByName(written.where(F.col("__tributary_length").isNull()).select(*kept, none.alias("sequence_id"), none.alias("offset")))


def packed_sequences(placed: DataFrame) -> DataFrame:
    """The token sequences themselves from pieces placed with their ``ids``
    (packed binary): ``sequence_id``, ``ids``, ``n_pieces``; a group is one sequence, so bounded."""
    return (placed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                    F.size("p").alias("n_pieces")))
