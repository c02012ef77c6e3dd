"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round only groups and joins on node ids. A hub (a node that a third of all edges touch) is one key, so its edges are
dealt over SALTS parts by their other end: minima are taken within each part, then over the parts, and the minimum goes back
to exactly the parts that exist, at most SALTS rows for a node. No neighbour list is ever gathered, and no task holds all
edges of a hub. Every round is written to the shared folder and the one before deleted, so a lost executor costs one round. Rounds grow
with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.cluster import discard, stored

#: Parts that the edges of a node are dealt over.
SALTS = 64


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest v of their u as ``m``; repeated edges meet."""
    dealt = edges.select("u", F.pmod(F.xxhash64("v"), F.lit(SALTS)).alias("s"), "v")
    parts = dealt.groupBy("u", "s").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"), F.collect_list("s").alias("s")).select("u", F.explode("s").alias("s"), "m")
    return dealt.join(least, ["u", "s"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node with the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours with the smallest of them."""
    moved = _with_least(edges)
    return moved.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame) -> tuple[int, int]:
    got = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return got["n"], got["x"] or 0


def _on_driver(edges: DataFrame) -> DataFrame:
    """The components of a few edges, joined in one place."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for u, v in edges.collect():
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return edges.sparkSession.createDataFrame([(u, find(u)) for u in root if find(u) != u], edges.schema)


def connected_components(edges: DataFrame, few: int = 0) -> DataFrame:
    """From edges (u, v) of comparable ids to (u, v): each node that isn't the smallest of its component, and that one.

    Up to ``few`` different edges are joined on the driver, without rounds.
    """
    level, path = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = _state(level)
    if 0 < before[0] <= few:
        return _on_driver(level)
    while before[0]:
        level, made = stored(_small_star(_large_star(level).distinct()).distinct(), "edges")
        discard(edges.sparkSession, path)
        path, now = made, _state(level)
        if now == before:
            break
        before = now
    return level
