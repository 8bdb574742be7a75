"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is centred, rotated by a random orthogonal matrix and kept as the
signs of its components, packed to bits, with three correction scalars.  A
query's rotated remainder is quantised to a few bit planes, so that the inner
product with a code is a handful of popcounts; the scalars turn it into an
unbiased estimate with an error bound.  Per query and block the best estimates
are computed exactly first; their k-th best is the bar, and every further
vector whose estimate plus error bound reaches the bar is computed exactly
too.  All vectors are coded and all codes are compared: nothing is sampled.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import shuffle_width, stage

SEED = 20                # of the rotation
PLANES = 6               # bits of a quantised query component
ERROR = 2.5              # error bound in standard deviations of the estimate
CANDIDATES = 8192        # candidates of a block
QUERIES = 4096           # queries of a block
SLAB = 1 << 20           # estimates held at once in a task
HUGE = 1e100             # larger components have no part in the centre
MAX_NUMBERS = 1_000_000  # numbers of all centres (one centre per length of vectors)


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """Random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id``, ``vec`` (doubles), ``dim`` of the rows that take part; rows repeated in full count once."""
    v = F.col(vec_col)
    sound = (v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists(v, lambda x: x != 0))
    return (df.where(F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("vec"))
            .distinct().withColumn("dim", F.size("vec")))


def centres(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Mean of the vectors of each length, summed in the tasks.  Vectors with a component over
    ``HUGE`` don't count: one of them would move the centre away from all others."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for b in batches:
            for dim, block, _ in _matrices(b.column("vec")):
                block = block[np.abs(block).max(axis=1) <= HUGE]
                sums[dim] = sums.get(dim, 0) + block.sum(axis=0)
                counts[dim] = counts.get(dim, 0) + len(block)
        for dim, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array(s), pa.array([counts[dim]] * dim, pa.int64())],
                                             names=["dim", "i", "s", "n"])

    rows = (vectors.select("vec").mapInArrow(run, "dim int, i int, s double, n long").groupBy("dim", "i")
            .agg((F.sum("s") / F.greatest(F.sum("n"), F.lit(1))).alias("mean")).limit(MAX_NUMBERS + 1).collect())
    if len(rows) > MAX_NUMBERS:
        raise ValueError("vectors of too many lengths")
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["dim"], np.zeros(r["dim"]))[r["i"]] = r["mean"]
    return out


def _matrices(column):
    """``(dim, matrix, row indices)`` for each length in a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for dim in np.unique(sizes):
        at = np.nonzero(sizes == dim)[0]
        yield int(dim), flat[offsets[at][:, None] + np.arange(dim)].astype(np.float64), at


def _lengths(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's norm and direction, scaled first so that large components don't overflow."""
    top = np.abs(rows).max(axis=1)
    scaled = rows / np.where(top > 0, top, 1)[:, None]
    norm = np.linalg.norm(scaled, axis=1)
    return top * norm, scaled / np.where(norm > 0, norm, 1)[:, None]


def encode(vectors: DataFrame, means: dict[int, np.ndarray]) -> DataFrame:
    """Vectors with ``code`` (packed signs), ``centre_ip`` (<vector, centre>), ``norm``
    (of the centred vector) and ``aligned`` (<its direction, its code's direction>)."""
    def run(batches):
        for b in batches:
            n = b.num_rows
            code, scalars = [b""] * n, np.zeros((3, n))
            for dim, m, at in _matrices(b.column("vec")):
                c = means.get(dim, np.zeros(dim))
                rest = m - c
                norm, unit = _lengths(rest)
                turned = unit @ rotation(dim).T
                scalars[0, at], scalars[1, at] = m @ c, norm
                scalars[2, at] = np.abs(turned).sum(axis=1) / np.sqrt(dim)
                words = np.zeros((len(m), -(-dim // 64) * 8), np.uint8)
                words[:, :-(-dim // 8)] = np.packbits(turned > 0, axis=1)
                for i, row in zip(at, words):
                    code[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vec"), b.column("dim"), pa.array(code, pa.binary()), *map(pa.array, scalars)],
                                             names=["vec_id", "vec", "dim", "code", "centre_ip", "norm", "aligned"])

    return vectors.select("vec_id", "vec", "dim").mapInArrow(
        run, "vec_id long, vec array<double>, dim int, code binary, centre_ip double, norm double, aligned double")


def _estimates(planes, low, step, sums, codes, dim):
    """<code direction, rotated query> from popcounts, for some queries and all codes of a block."""
    total = np.zeros((len(low), len(codes)), np.float64)
    for p, plane in enumerate(planes):                                   # plane: queries x words
        hits = np.zeros(total.shape, np.uint32)
        for w in range(codes.shape[1]):
            hits += np.bitwise_count(plane[:, w][:, None] & codes[:, w][None, :])
        total += hits * float(1 << p)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    # sum of the query's components where the code has a one, twice, less the sum of all
    return (2 * (low[:, None] * ones[None, :] + step[:, None] * total) - sums[:, None]) / np.sqrt(dim)


def _search(q_ids, q_vecs, ids, vecs, codes, scalars, centre, k, error):
    """Exact best ``k`` of a block for each query, as ``(query position, id, score)`` arrays."""
    dim = vecs.shape[1]
    centre_ip, norm, aligned = scalars
    safe = np.where(aligned > 0, aligned, 1)
    slack = np.sqrt(np.maximum(1 - aligned ** 2, 0)) / safe * error / np.sqrt(max(dim - 1, 1))
    out = ([], [], [])
    width = max(1, SLAB // max(1, len(ids)))
    shift = codes.shape[1] * 64
    for at in range(0, len(q_ids), width):
        q = q_vecs[at:at + width]
        rest = q - centre
        turned = rest @ rotation(dim).T
        low = turned.min(axis=1)
        step = np.maximum((turned.max(axis=1) - low) / ((1 << PLANES) - 1), 1e-300)
        level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
        planes = []
        for p in range(PLANES):
            bits = np.zeros((len(q), shift // 8), np.uint8)
            bits[:, :-(-dim // 8)] = np.packbits((level >> p) & 1, axis=1)
            planes.append(bits.view(np.uint64))
        rounded = low[:, None] + step[:, None] * level
        length = _lengths(rest)[0]
        code_ip = _estimates(planes, low, step, rounded.sum(axis=1), codes, dim)
        guess = centre_ip[None, :] + (rest @ centre)[:, None] + norm[None, :] * code_ip / safe[None, :]
        # the estimate's own error and the rounding of the query's components
        bound = norm[None, :] * (length[:, None] * slack[None, :] + (step / 2 * error / np.sqrt(3))[:, None] / safe[None, :])
        unknown = ~(np.isfinite(guess) & np.isfinite(bound))         # beyond a double: computed exactly
        guess[unknown], bound[unknown] = np.inf, 0
        for i in range(len(q)):
            own = ids == q_ids[at + i]
            g = np.where(own, -np.inf, guess[i])
            n = int((~own).sum())
            if not n:
                continue
            first = np.argpartition(-g, min(4 * k, n) - 1)[:min(4 * k, n)]
            exact = vecs[first] @ q[i]
            bar = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else -np.inf
            more = np.nonzero(g + bound[i] >= bar)[0]
            more = more[~own[more]]
            more = np.union1d(first, more)
            score = np.einsum("ij,j->i", vecs[more], q[i])
            best = np.lexsort((ids[more], -score))[:k]
            out[0].append(np.full(len(best), at + i))
            out[1].append(ids[more][best])
            out[2].append(score[best])
    return [np.concatenate(x) if x else np.zeros(0) for x in out]


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            error: float = ERROR) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each query the ``k`` candidates with the largest
    inner product (double precision, on the original vectors) among those found; ties to the smaller id.

    ``queries`` has the columns of ``df``.  Null vectors, zero vectors and those
    holding null or non-finite components take no part, nor do rows without an
    id.  A row never finds its own id.  Rows repeated in full count once;
    different vectors under one id are each a query and a candidate.  Vectors
    meet those of their own length.  Fewer than ``k`` candidates: all; none: no
    rows.  Work is the stated query set against all rows, in blocks of bounded
    size; what is broadcast is one centre per length.
    """
    spark = df.sparkSession
    vectors = stage(valid_vectors(df, id_col, vec_col), "vectors")
    means = centres(vectors)
    coded = stage(encode(vectors, means), "codes")
    asked = stage(valid_vectors(queries, id_col, vec_col), "queries")
    n_blocks = max(1, -(-coded.count() // CANDIDATES))
    q_blocks = max(1, -(-asked.count() // QUERIES))
    spread = F.xxhash64("vec_id", "vec")
    cells = (coded.withColumn("c", F.pmod(spread, F.lit(n_blocks)).cast("int"))
             .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
             .withColumn("asked", F.lit(False)))
    questions = (asked.withColumn("q", F.pmod(spread, F.lit(q_blocks)).cast("int"))
                 .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
                 .withColumn("asked", F.lit(True)))
    keys = ["dim", "q", "c"]
    width = max(shuffle_width(spark), min(n_blocks * q_blocks, 100_000))
    dealt = (cells.unionByName(questions, allowMissingColumns=True)
             .select(*keys, "asked", "vec_id", "vec", "code", "centre_ip", "norm", "aligned")
             .repartition(width, *keys).sortWithinPartitions(*keys))

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def close():
            t = pa.Table.from_batches(held)
            dim = t.column("dim")[0].as_py()
            is_q = t.column("asked").to_numpy().astype(bool)
            q, c = t.filter(pa.array(is_q)), t.filter(pa.array(~is_q))
            if not q.num_rows or not c.num_rows:
                return None
            matrix = [next(iter(_matrices(x.column("vec"))))[1] for x in (q, c)]
            codes = np.frombuffer(b"".join(c.column("code").to_pylist()), np.uint64).reshape(c.num_rows, -1)
            scalars = [c.column(x).to_numpy() for x in ("centre_ip", "norm", "aligned")]
            q_ids = q.column("vec_id").to_numpy()
            at, ids, score = _search(q_ids, matrix[0], c.column("vec_id").to_numpy(), matrix[1], codes, scalars, means[dim], k, error)
            at = at.astype(np.int64)
            part = np.array([xxhash.xxh64_intdigest(m.tobytes()) for m in matrix[0]], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(part[at]), pa.array(ids.astype(np.int64)), pa.array(score.astype(np.float64))], names=["query_id", "own", "vec_id", "score"])

        for b in batches:
            ks = np.stack([b.column(x).to_numpy() for x in keys], axis=1)
            if not len(ks):
                continue
            cuts = [0, *(np.nonzero((ks[1:] != ks[:-1]).any(axis=1))[0] + 1).tolist(), len(ks)]
            for lo, hi in zip(cuts, cuts[1:]):
                if last is not None and tuple(ks[lo]) != last:
                    done = close()
                    held = []
                    if done is not None:
                        yield done
                last = tuple(ks[lo])
                held.append(b.slice(lo, hi - lo))
        if held:
            done = close()
            if done is not None:
                yield done

    found = dealt.mapInArrow(run, "query_id long, own long, vec_id long, score double")
    order = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
