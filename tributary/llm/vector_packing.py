"""Vector bin packing of training examples.

A sequence has several limits at once - tokens, segments, loss-bearing tokens
- so an example is a vector of demands and a sequence a vector of what is left
of each.  The dot-product heuristic fills one sequence at a time: of the
examples that fit in every dimension it takes the one whose demands, weighted
by how scarce each dimension is, have the largest product with what is left.
When none fits whole and cutting is allowed, the example of the largest
product is cut to the tokens left.  Examples are packed in blocks of bounded
size inside the tasks that hold them: nothing is shuffled, and all a block can
waste is what its last sequences leave.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import ship_package

BLOCK = 8192               # examples packed together


class Pool:
    """The block's examples that wait, by kind (tokens, loss): one row of demands a kind, a stack of examples each."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int):
        self.size = np.array([capacity, max_segments, max_loss], float)
        self.slot: dict[tuple[int, int], int] = {}
        self.stacks: list[list[tuple[int, int]]] = []      # of (example, start)
        self.demand = np.zeros((64, 3))
        self.left = np.zeros(64, bool)
        self.n = 0

    def add(self, example: int, start: int, tokens: int, loss: int) -> None:
        at = self.slot.get((tokens, loss))
        if at is None:
            at = self.slot[tokens, loss] = len(self.stacks)
            self.stacks.append([])
            if at == len(self.left):
                self.demand, self.left = np.vstack([self.demand, np.zeros_like(self.demand)]), np.concatenate([self.left, np.zeros_like(self.left)])
            self.demand[at] = tokens, 1, loss
        self.stacks[at].append((example, start))
        self.left[at] = True
        self.n += 1

    def take(self, at: int) -> tuple[int, int, int, int]:
        example, start = self.stacks[at].pop()
        self.left[at] = bool(self.stacks[at])
        self.n -= 1
        return example, start, int(self.demand[at, 0]), int(self.demand[at, 2])

    def weights(self) -> np.ndarray:
        """How scarce each dimension is: its share of the waiting demand."""
        counts = np.array([len(s) for s in self.stacks], float)
        need = counts @ (self.demand[:len(counts)] / self.size) if len(counts) else np.ones(3)
        return need / (need.sum() or 1)

    def best(self, room: np.ndarray, weights: np.ndarray, cut: bool) -> int:
        """The kind of the largest product with ``room`` among those that fit (``cut``: whose first token fits), or -1."""
        k = len(self.stacks)
        demand = self.demand[:k]
        if cut:
            fits = self.left[:k] & (room[0] >= 1) & (room[1] >= 1) & ((room[2] >= 1) | (demand[:, 2] < demand[:, 0]))
        else:
            fits = self.left[:k] & (demand <= room).all(axis=1)
        if not fits.any():
            return -1
        score = demand @ (weights * room / self.size ** 2)
        return int(np.argmax(np.where(fits, score, -1.0)))


def _split(tokens: int, loss: int, head: int) -> tuple[int, int]:
    """Loss-bearing tokens (an example's last ones) before and after a cut."""
    after = min(loss, tokens - head)
    return loss - after, after


def _power_below(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def pack_block(examples: list[tuple[int, int]], capacity: int, max_segments: int, max_loss: int,
               cut: bool) -> list[list[tuple[int, int, int, int]]]:
    """Sequences of ``(example, start, tokens, loss)`` for examples of ``(tokens, loss)``.

    With ``cut``, a sequence that can't be filled keeps a power of two of
    tokens and gives the rest back, so that none needs padding.  Without it,
    every example given must fit the limits alone."""
    pool = Pool(capacity, max_segments, max_loss)
    out: list[list[tuple[int, int, int, int]]] = []
    limit = min(capacity, max_loss) if cut else capacity
    for i, (tokens, loss) in enumerate(examples):
        start = 0
        while cut and tokens >= capacity:                  # a whole sequence by itself
            before, after = _split(tokens, loss, limit)
            if limit == capacity:
                out.append([(i, start, limit, before)])
            else:
                pool.add(i, start, limit, before)
            start, tokens, loss = start + limit, tokens - limit, after
        if tokens:
            pool.add(i, start, tokens, loss)
    weights = pool.weights()
    while pool.n:
        room, sequence = pool.size.copy(), []
        while pool.n:
            at = pool.best(room, weights, False)
            head = None
            if at < 0 and cut:
                at = pool.best(room, weights, True)
                if at >= 0:
                    head = min(int(room[0]), int(pool.demand[at, 0] - pool.demand[at, 2] + room[2]))
            if at < 0:
                break
            example, start, tokens, loss = pool.take(at)
            if head is not None:
                before, after = _split(tokens, loss, head)
                pool.add(example, start + head, tokens - head, after)
                tokens, loss = head, before
            sequence.append((example, start, tokens, loss))
            room -= (tokens, 1, loss)
        used = sum(s[2] for s in sequence)
        if cut and used < capacity:
            spare = used - _power_below(used)
            while spare:
                example, start, tokens, loss = sequence.pop()
                back = min(spare, tokens)
                before, after = _split(tokens, loss, tokens - back)
                if back < tokens:
                    sequence.append((example, start, tokens - back, before))
                pool.add(example, start + tokens - back, back, after)
                spare -= back
        out.append(sequence)
    return out


def pack_examples(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", loss_col: str | None = None, capacity: int = 1024,
                  max_segments: int = 64, max_loss: int | None = None, end_id: int | None = 0, cut: bool = True, with_ids: bool = False) -> DataFrame:
    """Examples' token pieces and their places in sequences.

    ``ids_col``: packed little-endian unsigned 32-bit ids (null: none), to
    which ``end_id`` is added.  ``loss_col``: how many tokens at an example's
    end bear loss, the end id included (null: 0; more than it has: all; without the column all
    but an example's first token).  Each sequence has at most ``capacity``
    tokens, ``max_segments`` pieces and ``max_loss`` loss-bearing tokens (None: no limit beyond the capacity).

    Result, per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``loss_tokens``, ``sequence_id``, ``offset`` and, with
    ``with_ids``, the packed ``piece_ids``.  With ``cut`` every token lies in one
    piece and a sequence is full or has a power of two of tokens, which needs
    no padding either.  Without it examples stay whole, and one that fits no
    empty sequence has a single piece whose place is null.

    An example without tokens (``end_id`` None) has no piece.  Rows are packed
    one by one: repeated rows, ties and null ids each keep their pieces.  No
    rows, no sequences.  Columns beside the three are not carried, so any
    names do.  A sequence never crosses tasks or blocks of ``BLOCK`` examples;
    a task retried alone gives its own sequences anew.
    """
    if capacity < 1 or max_segments < 1 or (max_loss is not None and max_loss < 1):
        raise ValueError("limits must be at least 1")
    ship_package(df.sparkSession)
    most = capacity if max_loss is None else min(max_loss, capacity)
    id_type = df.schema[id_col].dataType.simpleString()
    end = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()

    def rows_of(block, made):
        """The block's rows, numbered on from ``made`` sequences."""
        wanted = [(len(ids) // 4, loss) for _, ids, loss in block]
        fit = [i for i, (n, loss) in enumerate(wanted) if n and (cut or (n <= capacity and loss <= most))]
        sequences = pack_block([wanted[i] for i in fit], capacity, max_segments, most, cut)
        base = TaskContext.get().partitionId() << 36
        rows = []
        for s, sequence in enumerate(sequences, made):
            offset = 0
            for which, start, n, loss in sequence:
                key, ids, _ = block[fit[which]]
                own = ids[4 * start:4 * (start + n)]
                rows.append((key, start, n, zlib.crc32(own), len(ids) // 4, loss, base + s, offset, own if with_ids else None))
                offset += n
        placed = set(fit)
        rows += [(key, 0, len(ids) // 4, zlib.crc32(ids), len(ids) // 4, loss, None, None, ids if with_ids else None)
                 for i, (key, ids, loss) in enumerate(block) if i not in placed and ids]
        return rows, len(sequences)

    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"] + ["piece_ids"] * with_ids

    def run(batches):
        made, block, key_type = 0, [], None

        def flush():
            nonlocal made, block
            rows, n = rows_of(block, made)
            made, block = made + n, []
            for at in range(0, len(rows), 20_000):
                columns = list(zip(*rows[at:at + 20_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:8])] + [pa.array(columns[8], pa.binary())] * with_ids, names=names)

        held = 0
        for b in batches:
            key_type = b.schema.field(0).type
            for i in range(b.num_rows):
                ids = (b.column(1)[i].as_py() or b"") + end
                n = len(ids) // 4
                loss = max(0, n - 1) if loss_col is None else min(n, max(0, b.column(2)[i].as_py() or 0))
                block.append((b.column(0)[i].as_py(), ids, loss))
                held += len(ids)
                if len(block) >= BLOCK or held > 4096 * BLOCK:
                    yield from flush()
                    held = 0
        if block:
            yield from flush()

    schema = f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long" + ", piece_ids binary" * with_ids
    return df.select(F.col(id_col), F.col(ids_col), *([F.col(loss_col).cast("long")] if loss_col else [])).mapInArrow(run, schema)
