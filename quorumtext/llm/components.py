"""Connected components over a distributed edge list: partial union-find in each task, then alternating large-star and small-star rounds.

Each task first turns every CHUNK of its edges into stars, which leaves rounds little to do. Every round is joins and sums with
map-side combining; a vertex with thousands of edges is never gathered into one row. Rounds end when only stars are left: each vertex but the
smallest of its component has one edge, to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.common import materialize, tidy

CHUNK = 200_000


def stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components, one for each vertex of a chunk that isn't the smallest it reaches there."""

    def joined(us: list[int], vs: list[int]) -> pd.DataFrame:
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        for u, v in zip(us, vs):
            u, v = find(u), find(v)
            if u != v:
                up[max(u, v)] = min(u, v)
        rows = [(x, r) for x in up if (r := find(x)) != x]
        return pd.DataFrame(rows, columns=["u", "v"], dtype="int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        us: list[int] = []
        vs: list[int] = []
        for batch in batches:
            us += batch.u.tolist()
            vs += batch.v.tolist()
            if len(us) >= CHUNK:
                yield joined(us, vs)
                us, vs = [], []
        yield joined(us, vs)

    return edges.mapInPandas(run, "u long, v long")


def only_stars(edges: DataFrame) -> bool:
    ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    degrees = edges.select(F.inline(ends)).groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.where("up > 1 OR (up > 0 AND down > 0)").agg(F.count(F.lit(1))).first()[0] == 0


@tidy
def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (u, v), any direction, repeated or not -> (v, component) for vertices that aren't the smallest of theirs."""
    edges = materialize(edges.where("u <> v").select("u", "v"), "edges")
    tasks = edges.count() // CHUNK + 1
    edges = materialize(stars(edges.coalesce(tasks)).distinct(), "edges")
    for _ in range(rounds):
        if only_stars(edges):
            return edges.select(F.col("u").alias("v"), F.col("v").alias("component"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written first, so that the joins are plain ones and Spark can split a vertex with many edges
        least = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "edges")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = materialize(small.where("u <> v").distinct(), "edges")
    raise RuntimeError(f"components didn't settle in {rounds} rounds")
