"""Near-duplicate embeddings: exact comparison in tiles, in PCA order.

Vectors are compared with those of the same label and length only. Each is scaled to length 1 and turned onto the principal axes of
all vectors of its length (a rotation keeps every product), so that the leading dimensions carry the most. Equal vectors of a label are
one class. Classes are put into cells of a grid over the first GRID components and, in order of cells, cut into tiles. Unit vectors of
cosine c are sqrt(2 - 2c) apart at most, which is the width of a cell: two tiles meet only if they hold the same or neighbouring cells (a plain join on
cells) and their boxes over the first LEAD components are that close. In a pair of tiles, products over the leading dimensions are summed
first; what the rest can add is at most the product of the suffix norms, and pairs that cannot reach the threshold are dropped
before the next dimensions. Survivors are confirmed by the cosine of the original vectors in double precision.

A tile travels with up to PARTNERS others at a time, and a pair of tiles returns counts of links by vector and a spanning forest of them,
never the pairs. The second moments are summed by partition (length squared numbers). Axes are kept for the lengths with most vectors, up to
AXES numbers in all; vectors of other lengths keep their own axes, which drops fewer pairs early and loses none.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing, as do rows without a label or an
id; repeated rows link; rows that share an id are one vertex, their links summed; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product as grid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorumtext.llm.common import materialize, tidy
from quorumtext.llm.components import components

TILE, STEP, GRID, LEAD, PARTNERS = 1024, 8, 3, 8, 16
#: Numbers of all axes together, 8 bytes each, which are broadcast.
AXES = 1 << 22
#: Slack for rounding, far above it and far below any difference that matters; survivors are confirmed exactly.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def read_vectors(values, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype("float64")


def principal_axes(vectors: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """vectors (size, v) -> for each length the axes of the second moments of the unit vectors, as columns, largest first."""
    counts, left, wanted = vectors.groupBy("size").count().orderBy(F.desc("count"), "size").limit(256).collect(), AXES, set()
    for r in counts:
        if r["size"] ** 2 <= left:
            left -= r["size"] ** 2
            wanted.add(r["size"])

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, some in batch.groupby("size"):
                if size in wanted:
                    x = unit(read_vectors(some.v, kind))
                    total[size] = total.get(size, 0) + x.T @ x
        for size, t in total.items():
            yield pd.DataFrame({"size": size, "i": np.arange(size), "row": list(t)})

    rows = vectors.select("size", "v").mapInPandas(moments, "size int, i int, row array<double>")
    summed = rows.select("size", "i", F.posexplode("row").alias("j", "x")).groupBy("size", "i", "j").agg(F.sum("x").alias("x"))
    totals = {size: np.zeros((size, size)) for size in wanted}
    for r in summed.toLocalIterator():
        totals[r["size"]][r.i, r.j] = r.x
    return {size: np.ascontiguousarray(np.linalg.eigh(t)[1][:, ::-1]) for size, t in totals.items()}


def compare_tiles(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of x, j of y; i < j where both are one tile) of unit vectors in PCA order that may reach the threshold."""
    rest = lambda v, d: np.sqrt(np.maximum(0.0, 1.0 - (v[:, :d] ** 2).sum(axis=1)))
    d = STEP
    product = x[:, :d] @ y[:, :d].T
    open_pairs = product + np.outer(rest(x, d), rest(y, d)) >= threshold - SLACK
    if same:
        open_pairs = np.triu(open_pairs, 1)
    i, j = np.nonzero(open_pairs)
    sums = product[i, j]
    while d < x.shape[1] and len(i):
        to = min(2 * d, x.shape[1])
        for at in range(0, len(i), 65_536):
            part = slice(at, at + 65_536)
            sums[part] += np.einsum("ab,ab->a", x[i[part], d:to], y[j[part], d:to])
        d = to
        keep = sums + rest(x, d)[i] * rest(y, d)[j] >= threshold - SLACK
        i, j, sums = i[keep], j[keep], sums[keep]
    return i, j


def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for p, q in zip(a.tolist(), b.tolist()):
        p, q = find(p), find(q)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((p, q))
    return out


def tiles_of(classes: DataFrame, axes, kind: str, width: float) -> DataFrame:
    """classes (label, size, rep, copies, v) -> tiles of up to TILE of them: label, size, tile, low and high (of the leading components), cells,
    and what they hold. axes is a broadcast of principal_axes."""

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, some in batch.groupby("size"):
                x = unit(read_vectors(some.v, kind))
                lead = x @ axes.value[size][:, :LEAD] if size in axes.value else x[:, :LEAD]
                lead = np.pad(lead, ((0, 0), (0, LEAD - lead.shape[1])))
                cells = np.floor(lead[:, :GRID] / width).astype("int64")
                yield some.assign(lead=[r.tobytes() for r in lead], next=lead[:, GRID], **{f"c{k}": cells[:, k] for k in range(GRID)})

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = None, None

        def tile(rows: pd.DataFrame) -> pd.DataFrame:
            lead = np.frombuffer(b"".join(rows.lead), "float64").reshape(-1, LEAD)
            cells = rows[cell].drop_duplicates().to_numpy().tolist()
            name = hashlib.blake2b(repr((rows.label.iloc[0], rows.rep.tolist())).encode() + rows.v.iloc[0], digest_size=8).hexdigest()
            one = {"label": rows.label.iloc[0], "size": rows["size"].iloc[0], "tile": name, "low": lead.min(axis=0), "high": lead.max(axis=0), "cells": [dict(zip(cell, c)) for c in cells]}
            return pd.DataFrame({k: [v] for k, v in (one | {"reps": rows.rep.to_numpy(), "copies": rows.copies.to_numpy(), "v": b"".join(rows.v)}).items()})

        for chunk in batches:
            for key, some in chunk.groupby(["label", "size"], sort=False, dropna=False):
                if held is not None and key != at:
                    yield tile(held)
                    held = None
                held, at = some if held is None else pd.concat([held, some], ignore_index=True), key
                while len(held) > TILE:
                    yield tile(held.iloc[:TILE])
                    held = held.iloc[TILE:]
        if held is not None:
            yield tile(held)

    cell = [f"c{k}" for k in range(GRID)]
    label = classes.schema["label"].dataType.simpleString()
    rows = classes.select("label", "size", "rep", "copies", "v").mapInPandas(placed, f"label {label}, size int, rep long, copies long, v binary, lead binary, next double, " + ", ".join(f"{c} long" for c in cell))
    order = ["label", "size", *cell, "next", "rep"]
    schema = f"label {label}, size int, tile string, low array<double>, high array<double>, cells array<struct<{','.join(f'{c}:bigint' for c in cell)}>>, reps array<long>, copies array<long>, v binary"
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(tiled, schema)


def tile_pairs(tiles: DataFrame, width: float) -> DataFrame:
    """(a, b), a <= b: the pairs of tiles that may hold a link, a tile with itself among them."""
    several = tiles.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("label", "size")
    cells = tiles.select("label", "size", "tile", "low", "high", F.explode("cells").alias("cell")).join(several, ["label", "size"])
    near = F.array(*[F.struct(*[F.lit(x).alias(f"c{k}") for k, x in enumerate(d)]) for d in grid((-1, 0, 1), repeat=GRID)])
    moved = F.transform(near, lambda d: F.struct(*[(F.col("cell")[f"c{k}"] + d[f"c{k}"]).alias(f"c{k}") for k in range(GRID)]))
    a = cells.select("label", "size", *[F.col(c).alias(f"{c}_a") for c in ("tile", "low", "high")], F.explode(moved).alias("cell"))
    b = cells.select("label", "size", *[F.col(c).alias(f"{c}_b") for c in ("tile", "low", "high")], "cell")
    gap = lambda k: F.greatest(F.lit(0.0), F.col("low_b")[k] - F.col("high_a")[k], F.col("low_a")[k] - F.col("high_b")[k])
    far = sum((gap(k) * gap(k) for k in range(1, LEAD)), gap(0) * gap(0))
    met = a.join(b, ["label", "size", "cell"]).where((F.col("tile_a") < F.col("tile_b")) & (far <= width * width)).select(F.col("tile_a").alias("a"), F.col("tile_b").alias("b")).distinct()
    return met.unionByName(tiles.select(F.col("tile").alias("a"), F.col("tile").alias("b")))


def linked(tiles: DataFrame, pairs: DataFrame, axes, kind: str, threshold: float) -> DataFrame:
    """(u, v, n): with v null, how many vectors u links with in a pair of tiles; else an edge of the forest of a pair's links."""
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
    dealt = pairs.join(groups, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    firsts = dealt.select("a", "part").distinct().select("a", "part", F.lit(0).alias("side"), F.col("a").alias("tile"))
    sides = firsts.unionByName(dealt.select("a", "part", F.lit(1).alias("side"), F.col("b").alias("tile")))
    data = sides.join(tiles.select("tile", "size", "reps", "copies", "v"), "tile")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in (r for batch in batches for r in batch.itertuples(index=False)):
            raw = read_vectors([r.v], kind).reshape(-1, r.size)
            raw = raw / np.abs(raw).max(axis=1, keepdims=True)
            norm = np.linalg.norm(raw, axis=1)
            turned = raw / norm[:, None]
            side = (r.reps, r.copies, raw, norm, turned @ axes.value[r.size] if r.size in axes.value else turned)
            if r.side == 0:
                one = side
                continue
            (ra, ca, va, na, xa), (rb, cb, vb, nb, xb) = one, side
            i, j = compare_tiles(xa, xb, threshold, r.a == r.tile)
            if len(i):
                cosine = np.concatenate([np.einsum("ab,ab->a", va[i[at : at + 65_536]], vb[j[at : at + 65_536]]) for at in range(0, len(i), 65_536)]) / (na[i] * nb[j])
                i, j = i[cosine >= threshold], j[cosine >= threshold]
            counts = pd.concat([pd.DataFrame({"u": ra[i], "n": cb[j]}), pd.DataFrame({"u": rb[j], "n": ca[i]})]).groupby("u", as_index=False).n.sum()
            forest = spanning(ra[i], rb[j])
            yield pd.DataFrame({"u": counts.u, "v": pd.array([None] * len(counts), "Int64"), "n": counts.n.astype("int64")})
            yield pd.DataFrame({"u": [u for u, _ in forest], "v": pd.array([v for _, v in forest], "Int64"), "n": 0})

    return data.repartition("a", "part").sortWithinPartitions("a", "part", "side", "tile").mapInPandas(compared, "u long, v long, n long")


@tidy
def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vectors (vec_id, embedding, label) -> vec_id, n_links, component_id, kept; one row per vector."""
    short = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "float32" if short else "float64"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<float>" if short else "array<double>").alias("v"))
    sound = F.col("label").isNotNull() & F.col("v").isNotNull() & F.col("vec_id").isNotNull() & (F.size("v") > 0)
    sound &= ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = [(np.asarray(x, kind) + 0).tobytes() for x in batch.v]  # -0.0 is 0.0
            yield batch.assign(v=v, size=batch.v.map(len), key=[hashlib.blake2b(x, digest_size=16).digest() for x in v])

    label = rows.schema["label"].dataType.simpleString()
    usable = materialize(rows.where(sound).mapInPandas(packed, f"vec_id long, label {label}, v binary, size int, key binary"), "vectors")
    classes = usable.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"), F.first("size").alias("size"))
    classes = materialize(classes, "classes")
    axes = vectors.sparkSession.sparkContext.broadcast(principal_axes(usable, kind))
    width = (2 - 2 * threshold) ** 0.5 + 1e-6
    tiles = materialize(tiles_of(classes, axes, kind, width), "tiles")
    found = materialize(linked(tiles, materialize(tile_pairs(tiles, width), "pairs"), axes, kind, threshold), "links")
    named = components(found.where("v IS NOT NULL").select("u", "v"))
    degrees = found.where("v IS NULL").groupBy("u").agg(F.sum("n").alias("n"))
    by_class = (
        classes.select("label", "key", "rep", "copies").join(degrees, F.col("rep") == F.col("u"), "left").join(named, F.col("rep") == F.col("v"), "left")
        .select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    named = materialize(usable.select("vec_id", "label", "key").join(by_class, ["label", "key"]).select("vec_id", "n_links", "component_id"), "names")
    alone = rows.where(~F.coalesce(sound, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE x AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM x a JOIN x b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
r AS (SELECT vec_id AS v, vec_id AS c FROM x UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.v)
SELECT r.v AS vec_id, (SELECT count(*) FROM e WHERE e.a = r.v) AS n_links, min(c) AS component_id, min(c) = r.v AS kept FROM r GROUP BY r.v
"""
