"""Connected components of an edge table by alternating large-star and small-star rounds.

Edges stay distributed; each round is a few grouped minima and joins, written to the
shared folder so that a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import drop_written, written


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free digest, to see that a round changed nothing."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], row["h"]


#: Neighbours of one node that meet its least one in one task; the edges of a larger star are dealt out in parts.
STAR = 500
#: Keys of more than one row in SHARE are told to every task (so there are about SHARE of them at most) and dealt out; others may stay together.
SHARE = 1024


def _with_least(pairs: DataFrame, n: int) -> DataFrame:
    """The n pairs (u, v) with m, the least v of their u; no task gets the whole of a large star."""
    bar = max(STAR, n // SHARE)
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.ceil(F.count(F.lit(1)) / bar).cast("int").alias("parts"))
    hot = F.broadcast(least.where("parts > 1").select("u", "parts"))  # at most n / bar rows, about SHARE
    dealt = pairs.join(hot, "u", "left").select("u", "v", F.pmod(F.xxhash64("v"), F.coalesce("parts", F.lit(1))).alias("part"))
    copies = least.select("u", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"))
    return dealt.join(copies, ["u", "part"])


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node next to it."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    tied = _with_least(both, 2 * n).where(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Smaller neighbours and the node itself are tied to the least of them (edges have u > v)."""
    tied = _with_least(edges, n)
    return tied.select(F.explode(F.array(F.struct(F.col("v").alias("a")), F.struct(F.col("u").alias("a")))).alias("e"), "m").select(
        F.col("e.a").alias("u"), F.col("m").alias("v")
    ).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a smaller one in its component; root is the least of them.

    ``edges`` has two columns of one orderable type.  Loops and repeated edges are fine;
    an empty table gives an empty result.
    """
    a, b = edges.columns
    now = written(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )
    seen = _fingerprint(now)
    while seen[0]:
        # the large star leaves no more edges than it gets: each pair with v > u gives one
        after = written(_small_star(_large_star(now, seen[0]), seen[0]), "edges")
        drop_written(now)
        now, before = after, seen
        seen = _fingerprint(now)
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
