"""Document fingerprints as invertible Bloom lookup sketches.

A text is a set of paragraphs (lines, long ones in pieces), each a 64-bit
digest.  The sketch spreads every digest over three cells that keep a count,
the XOR of the digests and the XOR of check values.  Two versions' sketches
subtract cell by cell: what they share cancels, and a cell left with one
digest gives it away; taking that digest out of its other cells frees the
next, until the differing digests are all recovered.  A sketch too small for
the difference fails, and a larger one is tried.  Everything here is a Spark
expression: no Python runs in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import shuffle_width, stage, ship_package

PIECE = 160            # code points of a paragraph's piece
HEAD, HEAD_PIECE = 160, 16          # a text's first code points come in smaller pieces, so that short texts have several
CELLS = 8              # cells of each of the three parts of a fingerprint
ROUNDS = 16            # peeling rounds before a sketch counts as too small
SMALL = 160            # digests of two texts together that are dealt into parts within one row
PART = 12              # digests of two texts together in one part of a larger sketch, on average
RETRIES = (8, 16, 32, 64, 128)      # cells a third of a part's sketch, in turn


def let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def digests(text: str | Column) -> Column:
    """The set of paragraph digests of a text; null or empty: the empty set."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def pieces(part, size):
        return F.regexp_extract_all(part, F.lit("[^\\n]{1,%d}" % size), F.lit(0))

    every = F.concat(pieces(F.substring(t, 1, HEAD), HEAD_PIECE), pieces(F.substring(t, HEAD + 1, 2 ** 31 - 1), PIECE))
    return F.array_distinct(F.transform(every, lambda x: F.xxhash64(x)))


def _entry(x: Column, sign: Column, cells: int | Column) -> Column:
    """A digest with its sign, check value and its cell in each third."""
    cells = F.lit(cells) if isinstance(cells, int) else cells
    return F.struct(sign.alias("n"), x.alias("k"), F.xxhash64(x, F.lit(77)).alias("s"),
                    *(F.pmod(F.xxhash64(x, F.lit(j)), cells).cast("int").alias(f"c{j}") for j in range(3)))


def _apply(cell: Column, index: Column, entries: Column, third: int, times: int) -> Column:
    """A cell after adding (1) or taking out (-1) the entries that fall into it."""
    return F.aggregate(F.filter(entries, lambda e: e[f"c{third}"] == index), cell, lambda c, e: F.struct(
        (c["n"] + times * e["n"]).cast("int").alias("n"), c["k"].bitwiseXOR(e["k"]).alias("k"), c["s"].bitwiseXOR(e["s"]).alias("s")))


def _blank() -> Column:
    return F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("s"))


def sketch(keys: Column, cells: int | Column = CELLS, taken: Column | None = None) -> Column:
    """The 3 x ``cells`` cells (count, XOR of digests, XOR of checks) of a digest set, as an array for each third.
    With ``taken``, that set's cells are subtracted as they are made."""
    places = F.array(*map(F.lit, range(cells))) if isinstance(cells, int) else F.sequence(F.lit(0), cells - 1)

    def third(entries, j):
        return F.transform(places, lambda i: _apply(_blank(), i, entries, j, 1))

    made = F.transform(keys, lambda x: _entry(x, F.lit(1), cells))
    if taken is not None:
        made = F.concat(made, F.transform(taken, lambda x: _entry(x, F.lit(-1), cells)))
    return let(made, lambda entries: F.array(*(third(entries, j) for j in range(3))))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: F.zip_with(p, q, lambda x, y: F.struct(
        (x["n"] - y["n"]).cast("int").alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["s"].bitwiseXOR(y["s"]).alias("s"))))


def peel(difference: Column, cells: int | Column) -> Column:
    """How many digests a subtracted sketch gives back, or null if it is too small for them.

    Each round takes out the digests of all cells that hold exactly one; the
    first round without such a cell is the last."""
    def pure(state: Column) -> Column:
        lone = F.filter(F.flatten(state["cells"]), lambda c: (F.abs(c["n"]) == 1) & (F.xxhash64(c["k"], F.lit(77)) == c["s"]))

        def signed(lone: Column, n: int) -> Column:
            keys = F.array_distinct(F.transform(F.filter(lone, lambda c: c["n"] == n), lambda c: c["k"]))
            return F.transform(keys, lambda k: _entry(k, F.lit(n), cells))

        return let(lone, lambda x: F.concat(signed(x, 1), signed(x, -1)))

    def empty(c: Column) -> Column:
        return (c["n"] == 0) & (c["k"] == 0) & (c["s"] == 0)

    def without(cells_of_third: Column, taken: Column, j: int) -> Column:
        return F.transform(cells_of_third, lambda c, i: F.when(empty(c), c).otherwise(_apply(c, i, taken, j, -1)))

    def turn(state: Column, _) -> Column:
        return F.when(state["done"], state).otherwise(let(pure(state), lambda p: F.when(
            F.size(p) == 0, F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(True).alias("done"))).otherwise(F.struct(
                F.array(*(without(state["cells"][j], p, j) for j in range(3))).alias("cells"),
                (state["found"] + F.size(p)).cast("int").alias("found"), F.lit(False).alias("done")))))

    start = F.struct(difference.alias("cells"), F.lit(0).alias("found"), F.lit(False).alias("done"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
    return let(end, lambda e: F.when(F.forall(F.flatten(e["cells"]), empty), e["found"]))


def _retried(a: Column, b: Column) -> Column:
    """Digests in one of two small sets and not the other: sketched, subtracted and peeled, larger
    each time it fails; if all fail, compared digest by digest."""
    peeled = F.aggregate(F.array(*map(F.lit, RETRIES)), F.lit(None).cast("int"),
                         lambda found, m: F.coalesce(found, peel(sketch(a, m, b), m)))
    return F.coalesce(peeled, F.size(F.array_except(a, b)) + F.size(F.array_except(b, a)))


def in_parts(a: Column, b: Column) -> Column:
    """The same of two sets of at most ``SMALL`` digests together: dealt into parts by a hash, each retried on its own."""
    n = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / PART)).cast("int")

    def dealt(keys):
        return F.transform(keys, lambda x: F.struct(F.pmod(F.xxhash64(x, F.lit(5)), n).cast("int").alias("p"), x.alias("x")))

    def of(keys, p):
        return F.transform(F.filter(keys, lambda e: e["p"] == p), lambda e: e["x"])

    return let(F.struct(dealt(a).alias("a"), dealt(b).alias("b")), lambda both: F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, p: total + let(
            F.struct(of(both["a"], p).alias("a"), of(both["b"], p).alias("b")), lambda part: _retried(part["a"], part["b"]))))


def written(cells: Column) -> Column:
    """A sketch as text: a fixed number of hexadecimal digits a cell."""
    return F.lower(F.concat_ws("", F.transform(F.flatten(cells), lambda c: F.concat(
        F.lpad(F.hex(c["n"].cast("long")), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["s"]), 16, "0")))))


def peelable(a: Column, b: Column) -> Column:
    """Whether two sets' sizes leave room for a fingerprint to peel: it gives back no more digests than it has cells."""
    return F.abs(F.size(a) - F.size(b)) <= 3 * CELLS


def differing(pairs: DataFrame, key: str = "key", a: str = "a", b: str = "b") -> DataFrame:
    """``key``, ``n_different``: digests in one set of a pair and not the other, for sets of any size.

    ``pairs`` has unique keys and two digest arrays (sets).  First their
    fingerprints are subtracted and peeled; where that fails, a larger sketch
    in parts, each with about ``PART`` digests, peeled apart and retried larger
    on its own."""
    first = F.when(peelable(F.col(a), F.col(b)), peel(subtract(sketch(F.col(a)), sketch(F.col(b))), CELLS))
    tried = stage(pairs.select(F.col(key).alias("key"), first.alias("found"), F.col(a).alias("a"), F.col(b).alias("b"))
                  .withColumns({c: F.when(F.col("found").isNull(), F.col(c)) for c in ("a", "b")}), "iblt-tried")
    n_parts = F.greatest(F.lit(1), F.ceil((F.size("a") + F.size("b")) / PART)).cast("long")
    both = F.concat(F.transform("a", lambda x: F.struct(x.alias("x"), F.lit(True).alias("in_a"))), F.transform("b", lambda x: F.struct(x.alias("x"), F.lit(False).alias("in_a"))))
    parts = (tried.where("found is null").select("key", n_parts.alias("n"), F.explode(both).alias("e"))
             .groupBy("key", F.pmod(F.xxhash64("e.x", F.lit(5)), F.col("n")).alias("part"))
             .agg(F.collect_set(F.when(F.col("e.in_a"), F.col("e.x"))).alias("a"), F.collect_set(F.when(~F.col("e.in_a"), F.col("e.x"))).alias("b")))
    settled = parts.select("key", _retried(F.col("a"), F.col("b")).alias("found")).groupBy("key").agg(F.sum("found").cast("int").alias("found"))
    return (tried.where("found is not null").select("key", "found").unionByName(settled.select("key", "found"))
            .select(F.col("key"), F.col("found").alias("n_different")))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text``, ``next`` and a unique ``key``: each row with the text of the next one by descending
    id (then by a hash of the text), the first one's after the last.

    Ids are dealt into ranges by approximate quantiles, and the first row of
    each range is sent to the range before it as well, so that the texts are
    shuffled once and no task sees more than its range.  An id that spans
    several quantiles has that many ranges, by the hash of the text.  A null id comes last."""
    spark = df.sparkSession
    n_ranges = 4 * shuffle_width(spark)
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63)))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), order.alias("o"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    cuts = rows.agg(F.percentile_approx("o", [i / n_ranges for i in range(1, n_ranges)], 20 * n_ranges).alias("q")).first()["q"] or []
    spans = {c: cuts.count(c) for c in set(cuts)}
    hot = {c for c, n in spans.items() if n > 1}
    cuts = sorted({*cuts, *(c + 1 for c in hot if c < 2 ** 63 - 1)})
    # the ids of place p are those from cuts[p - 1] to before cuts[p]; a hot id has a place of its own, of several ranges
    width = [1, *(spans[c] if c in hot else 1 for c in cuts)]
    first = [sum(width[:p]) for p in range(len(width))]
    if cuts:
        steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
        bounds = F.array(*map(F.lit, cuts))

        def halve(s, _):
            return let(F.floor((s["lo"] + s["hi"]) / 2).cast("int"), lambda mid: F.when(s["lo"] >= s["hi"], s).otherwise(
                F.when(F.get(bounds, mid) <= F.col("o"), F.struct((mid + 1).alias("lo"), s["hi"].alias("hi")))
                .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))))

        # how many cuts are at or below the id, by binary search
        found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), halve)
        place = F.struct(found["lo"].alias("p"))

        def numbers(values):
            return F.array(*map(F.lit, values))

        # within an id texts go by rising hash, ranges fall: the smallest hashes have its last range
        share = F.col("t") / F.lit(2.0 ** 64) + 0.5
        rows = rows.withColumn("range", let(place, lambda x: let(F.get(numbers(width), x["p"]), lambda w: (
            F.get(numbers(first), x["p"]) + w - 1 - F.least(w - 1, F.floor(share * w))).cast("int"))))
    else:
        rows = rows.withColumn("range", F.lit(0))
    tops = rows.groupBy("range").agg(F.min(F.struct((-(F.col("o") + 1)).alias("o"), F.col("t").alias("t"))).alias("m")).collect()
    tops = sorted(((r["range"], -r["m"]["o"] - 1, r["m"]["t"]) for r in tops), reverse=True)
    size = sum(width)
    top_o, top_t, sent_to = [None] * size, [None] * size, [None] * size
    for (r, o, t), before in zip(tops, [tops[-1], *tops[:-1]] if tops else []):
        top_o[r], top_t[r], sent_to[r] = o, t, before[0]

    def lookup(values, kind):
        return F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("range"))

    is_top = (F.col("o") == lookup(top_o, "long")) & (F.col("t") == lookup(top_t, "long"))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    dealt = (rows.withColumn("place", F.explode(F.when(is_top, F.array(own, F.struct(lookup(sent_to, "int").alias("range"), F.lit(True).alias("guest")))).otherwise(F.array(own))))
             .select("id", "text", "o", "t", "place.range", "place.guest"))
    w = Window.partitionBy("range").orderBy("guest", F.desc("o"), "t")
    return (dealt.withColumn("next", F.lead(F.coalesce("text", F.lit(""))).over(w)).withColumn("n", F.row_number().over(w))
            .where(~F.col("guest"))
            .select("id", "text", "next", (F.shiftleft(F.col("range").cast("long"), 40) + F.col("n")).alias("key")))


def versions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.

    The edited text has the last floor(n/3) code points replaced by the first
    as many (or all) of the next text (:func:`with_next`).  Likeness: one less
    the share of digests that differ; two empty texts are alike (1).  Null
    texts count as empty; repeated rows each have their result; a single row
    is its own next; no rows, no result.  Columns beside the two are not read."""
    ship_package(df.sparkSession)
    text = F.coalesce("text", F.lit(""))
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), n - cut), F.substring(F.col("next"), F.lit(1), cut))
    rows = stage(with_next(df, id_col, text_col)
                 .select("key", "id", text.alias("text"), "next", n.cast("long").alias("n_chars"), edited.alias("edited"))
                 .select("key", "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                         digests("text").alias("own"), digests("edited").alias("edit"), digests("next").alias("follow")), "iblt-digests")
    def likeness(d, other):
        total = F.size("own") + F.size(other)
        return F.when(total == 0, F.lit(1.0)).otherwise(1 - d / total)

    def result(df, d_edit, d_follow):
        return df.select("id", "n_chars", "edited_sha256", written(F.col("sketches")["own"]).alias("fingerprint"), written(F.col("sketches")["edit"]).alias("edited_fingerprint"),
                         likeness(d_edit, "edit").alias("near_edited"), likeness(d_follow, "follow").alias("near_next"))

    # Every text is sketched once where two rows' digests are few: all is settled in the row, without a shuffle.
    large = F.size("own") + F.greatest(F.size("edit"), F.size("follow")) > SMALL
    sketched = F.transform(F.array("own", "edit", "follow"), lambda keys: sketch(keys))

    others = F.array("edit", "follow")
    few = rows.where(~large).withColumn("sketches", let(sketched, lambda s: F.struct(
        s[0].alias("own"), s[1].alias("edit"), F.transform(others, lambda other, i: F.coalesce(
            F.when(peelable(F.col("own"), other), peel(subtract(s[0], s[i + 1]), CELLS)), in_parts(F.col("own"), other))).alias("d"))))
    # Larger ones: their differences are found in parts that are dealt over the cluster.
    many = rows.where(large)
    pairs = many.select(F.explode(F.array(*(F.struct((F.col("key") * 2 + i).alias("key"), F.col("own").alias("a"), F.col(c).alias("b"))
                                            for i, c in enumerate(("edit", "follow"))))).alias("p")).select("p.*")
    by_row = (differing(pairs).groupBy(F.shiftright("key", 1).alias("key"))
              .agg(F.max(F.when(F.col("key") % 2 == 0, F.col("n_different"))).alias("d_edit"), F.max(F.when(F.col("key") % 2 == 1, F.col("n_different"))).alias("d_follow")))
    joined = many.join(by_row, "key").withColumn("sketches", F.struct(sketch(F.col("own")).alias("own"), sketch(F.col("edit")).alias("edit")))
    return result(few, F.col("sketches.d")[0], F.col("sketches.d")[1]).unionByName(result(joined, F.col("d_edit"), F.col("d_follow")))
