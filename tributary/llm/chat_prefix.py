"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only that reply is trainable.  The template marks the turns with
control strings; where those occur inside a text they are escaped with
backslashes, so that the turns can be read back from the output.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import shuffle_width

# The template's control strings.
HEAD, TAIL = "### ", "</turn>"
ESCAPE = re.compile(r"\\|#|(?<=<)/(?=turn>)")
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"### ((?:\\.|[^\\\n:])*): ((?:\\.|[^\\<]|<(?!/turn>))*)</turn>\n", re.S)
OUT_CHARS = 4 << 20     # characters of formatted text in one output batch
TURNS = 128             # turns whose examples one task writes


def escape(text: str) -> str:
    """``text`` with a backslash before every backslash, ``#`` and the slash of ``</turn>``."""
    return ESCAPE.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    """A role also has its line breaks and colons escaped."""
    return escape(role).replace("\n", "\\n").replace(":", "\\:")


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def unescape_role(role: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as the template writes it, and where its text starts and ends."""
    head = f"{HEAD}{escape_role(role)}: "
    body = escape(text)
    return f"{head}{body}{TAIL}\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of every turn of a formatted example."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


def _rows(batches, types: list) -> Iterator[tuple]:
    """Rows of Arrow batches; the type of the first column is noted in ``types``."""
    for b in batches:
        types[0] = b.schema.field(0).type
        yield from zip(*(c.to_pylist() for c in b.columns))


def _same(a, b) -> bool:
    """Equal ids; null equals null and NaN equals NaN, as in grouping."""
    return a == b or (a != a and b != b)


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    rows.clear()
    return done


def prefix_target_examples(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                           text_col: str = "text", target: str = "assistant", turns: int = TURNS) -> DataFrame:
    """``conv``, ``example``, ``formatted``, ``loss_start``, ``loss_end`` (code points), ``whole`` (holds all
    turns): an example per target turn, numbered in the order of the turns.

    A conversation's last example is followed by one without a trainable part
    (both bounds 0) if turns come after it, so that the examples together hold
    every turn.  Turns are ordered by ``turn_col`` (null first), then role,
    then text; rows repeated in full are turns of their own.  A null role or
    text is empty; rows with a null id are one conversation.  No rows, no
    examples; other columns are not read.

    The examples of every ``turns`` turns of a conversation are written by a
    task of their own, which is sent the turns before them, so a long
    conversation is dealt over many tasks.  A task holds one example's turns
    and a few megabytes of output.  What goes through one task by
    conversation is the numbering of its turns (sorted, on disk if need be):
    under 2 GB of text, since an example is one string value.
    """
    id_type = df.schema[conv_col].dataType.simpleString()
    rows = df.select(F.col(conv_col).alias("conv"), F.coalesce(role_col, F.lit("")).alias("role"),
                     F.coalesce(text_col, F.lit("")).alias("text"), F.col(turn_col).alias("turn"))
    one = Window.partitionBy("conv")
    numbered = rows.select("conv", "role", "text", (F.row_number().over(one.orderBy("turn", "role", "text")) - 1).alias("n"),
                           F.count(F.lit(1)).over(one).alias("total"))
    short, long = numbered.where(f"total <= {turns}"), numbered.where(f"total > {turns}")
    part = F.explode(F.sequence(F.expr(f"n div {turns}"), F.expr(f"(total - 1) div {turns}")))
    # a fixed number of partitions: the examples are far larger than the rows by which Spark would merge them
    dealt = (long.select("conv", part.alias("part"), "n", "total", "role", "text")
             .repartition(shuffle_width(df.sparkSession), "conv", "part").sortWithinPartitions("conv", "part", "n"))
    # a short conversation lies in one partition since its numbering
    kept = short.select("conv", F.lit(0).cast("long").alias("part"), "n", "total", "role", "text").sortWithinPartitions("conv", "n")
    names = ["conv", "example", "formatted", "loss_start", "loss_end", "whole"]

    def run(batches):
        types = [None, pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        out: list[tuple] = []
        held, key, key_part = 0, None, None
        for conv, part, n, total, role, text in _rows(batches, types):
            if part != key_part or not _same(conv, key):
                key, key_part, context, size, examples = conv, part, [], 0, 0
            formatted, start, end = format_turn(role, text)
            context.append(formatted)
            trained = role == target
            if n >= part * turns and (trained or n == total - 1):
                bounds = (size + start, size + end) if trained else (0, 0)
                out.append((conv, examples, "".join(context), *bounds, n == total - 1))
                held += size + len(formatted)
            examples += trained
            size += len(formatted)
            if held > OUT_CHARS or len(out) > 5000:
                yield _batch(out, types, names)
                held = 0
        if out:
            yield _batch(out, types, names)

    schema = f"conv {id_type}, example int, formatted string, loss_start long, loss_end long, whole boolean"
    return kept.mapInArrow(run, schema).unionByName(dealt.mapInArrow(run, schema))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its formatted examples say: ``conv``, ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``.

    The turns are read from the example that holds them all, the trained text
    from under every example's mask, in the order of ``example``; how the rows
    lie in partitions does not matter.  Only the trained texts are shuffled."""
    import hashlib

    id_type = examples.schema["conv"].dataType.simpleString()
    seen_names = ["conv", "example", "trained", "chars", "n_turns", "turns_sha256"]
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def see(batches):
        types = [None, pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        out: list[tuple] = []
        held = 0
        for b in batches:
            types[0] = b.schema.field(0).type
            for i in range(b.num_rows):
                conv, example, formatted, start, end, whole = (c[i].as_py() for c in b.columns)
                n, digest = None, None
                if whole:
                    told, n = hashlib.sha256(), 0
                    for m in TURN.finditer(formatted):
                        told.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                        n += 1
                    digest = told.hexdigest()
                out.append((conv, example, unescape(formatted[start:end]), len(formatted), n, digest))
                held += end - start
                if held > OUT_CHARS or len(out) > 5000:
                    yield _batch(out, types, seen_names)
                    held = 0
        if out:
            yield _batch(out, types, seen_names)

    def run(batches):
        types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        out: list[tuple] = []
        now = None
        for conv, _, trained, chars, n, digest in _rows(batches, types):
            if now is None or not _same(conv, key):
                if now is not None:
                    out.append((key, now["n"], now["turns"], now["loss"], now["hash"].hexdigest(), now["chars"]))
                    if len(out) > 5000:
                        yield _batch(out, types, names)
                key, now = conv, {"n": None, "turns": None, "loss": 0, "hash": hashlib.sha256(), "chars": 0}
            now["loss"] += len(trained)
            now["hash"].update(trained.encode("utf-8", "surrogatepass"))
            now["chars"] += chars
            if digest is not None:
                now["n"], now["turns"] = n, digest
        if now is not None:
            out.append((key, now["n"], now["turns"], now["loss"], now["hash"].hexdigest(), now["chars"]))
        if out:
            yield _batch(out, types, names)

    seen = (examples.select("conv", "example", "formatted", "loss_start", "loss_end", "whole")
            .mapInArrow(see, f"conv {id_type}, example int, trained string, chars long, n_turns long, turns_sha256 string"))
    return seen.repartition("conv").sortWithinPartitions("conv", "example").mapInArrow(
        run, f"conv {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
