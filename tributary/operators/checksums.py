"""Cross-source consistency by checksums.

Both sources are summed up in buckets of the key's hash; a bucket whose sums
agree holds the same keys as often on both sides.  Only keys of the other
buckets are grouped and joined.  The sums do not depend on order and add up,
so those of a partition can be stored and merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tributary.operators.checks import _q, cross_source_consistency

BUCKET_BITS = 16
PIECE_BITS = 22            # three pieces of a 64-bit hash: their sums hold up to 2^41 rows a bucket
SUMS = ["rows", "s0", "s1", "s2"]


def _bucket(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(1), key), 64 - bits)


def key_checksums(df: DataFrame, key: str, bits: int = BUCKET_BITS) -> DataFrame:
    """``bucket``, ``rows``, ``s0``, ``s1``, ``s2``: the multiset of ``key``'s values, at most 2^bits
    rows however many keys there are, summed in the tasks first.  NULL is a value."""
    h = F.xxhash64(F.lit(2), _q(key), _q(key).isNull())
    pieces = [F.shiftrightunsigned(h, i * PIECE_BITS).bitwiseAND(F.lit((1 << PIECE_BITS) - 1)) for i in range(3)]
    return df.groupBy(_bucket(_q(key), bits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(p).alias(f"s{i}") for i, p in enumerate(pieces)])


def merge_checksums(checksums: DataFrame) -> DataFrame:
    """Checksums of several partitions as one."""
    return checksums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in SUMS])


def unequal_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """The buckets whose sums differ or that one side lacks."""
    a, b = left.alias("a"), right.alias("b")
    return a.join(b, F.col("a.bucket") == F.col("b.bucket"), "full").where(
        ~F.struct(*[F.col(f"a.{c}") for c in SUMS]).eqNullSafe(F.struct(*[F.col(f"b.{c}") for c in SUMS]))).select(
        F.coalesce("a.bucket", "b.bucket").alias("bucket"))


def consistency_differences(left: DataFrame, left_key: str, right: DataFrame, right_key: str, left_name: str = "left",
                            right_name: str = "right", bits: int = BUCKET_BITS, left_sums: DataFrame | None = None,
                            right_sums: DataFrame | None = None) -> DataFrame:
    """The rows of ``cross_source_consistency`` whose counts differ or that one side lacks.

    Where the sources agree no key is shuffled: their sums meet in at most
    2^bits rows, and the broadcast list of unequal buckets (at most 2^bits
    numbers) filters each side before its group-by.  ``*_sums``: stored checksums, else made here.
    Both keys must have one type.  Two buckets that differ agree in 64 bits of sums with
    a chance of about 2^-64."""
    kinds = left.schema[left_key].dataType, right.schema[right_key].dataType
    if kinds[0] != kinds[1]:
        raise TypeError(f"keys of different types: {kinds[0].simpleString()}, {kinds[1].simpleString()}")
    sums = [made if made is not None else key_checksums(df, key, bits)
            for df, key, made in ((left, left_key, left_sums), (right, right_key, right_sums))]
    buckets = F.broadcast(unequal_buckets(*sums))

    def only(df: DataFrame, key: str) -> DataFrame:
        keys = df.select(_q(key).alias("k"))
        return keys.join(buckets, _bucket(F.col("k"), bits) == buckets["bucket"], "left_semi")

    out = cross_source_consistency(only(left, left_key), "k", only(right, right_key), "k", left_name, right_name)
    return out.where(~F.col(f"n_{left_name}").eqNullSafe(F.col(f"n_{right_name}")))
