"""Connected components of a link table, by alternating large and small stars.

Every round re-hangs each node's larger neighbours on its smallest one; the
state is the shrinking edge table, written to the shared checkpoint folder
after each round, so nothing is held on the driver and no neighbour list is
gathered in one place (a hub's edges stay rows, its minimum is a partial
aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges ``(u, v)`` with ``u > v``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u > v").distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u")
    return (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u > v").distinct())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node that has a link: the root is the
    smallest node reachable.  Self links and repeated links are harmless,
    links with a null end are ignored; no links, no rows."""
    edges = stage(links.where(F.col(a) != F.col(b))
                  .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")

    def state(df: DataFrame):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    now = state(edges)
    while now[0]:
        edges = stage(_round(edges), "stars")
        before, now = now, state(edges)
        if now == before:
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
