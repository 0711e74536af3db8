"""Pairing transliteration blocks with translation blocks on a page.

Scores come from an equi-join within the page, where blocks are few; matching goes page by page over batches of sorted pairs, without a
shuffle of its own where blocks are dealt by page.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pairing:
    """Weights, decay, tiers and penalties of the profile."""

    distance: float = 0.30
    column: float = 0.30
    language: float = 0.15
    markers: float = 0.15
    order: float = 0.10
    decay: float = 0.35
    max_distance: float = 0.5
    tiers: tuple[tuple[str, float], ...] = (("high", 0.48), ("medium", 0.44), ("low", 0.40))
    interlinear_window: float = 120.0
    commentary_penalty: float = 0.35
    min_chars: int = 15
    max_punctuation: float = 0.4
    min_language_confidence: float = 0.15


def eligible(blocks: DataFrame, p: Pairing = Pairing()) -> DataFrame:
    """Blocks (text, lang_conf) that are long enough, not mostly punctuation, and of a language sure enough."""
    signs = F.length("text") - F.length(F.regexp_replace("text", r"\p{P}", ""))
    return blocks.where((F.length("text") >= p.min_chars) & (signs / F.length("text") <= p.max_punctuation) & (F.col("lang_conf") >= p.min_language_confidence))


def scores(sources: DataFrame, targets: DataFrame, p: Pairing = Pairing()) -> DataFrame:
    """(page_id, block_id, y, column, ord, lang_conf, has_marker, is_commentary, page_height) twice -> page_id, source_id, target_id, score, tier."""
    names = ("block_id", "y", "column", "ord", "lang_conf", "has_marker", "is_commentary")
    s, t = (d.select("page_id", *([] if k else ["page_height"]), *[F.col(c).alias(f"{c}_{'st'[k]}") for c in names]) for k, d in enumerate((sources, targets)))
    far = F.abs(F.col("y_s") - F.col("y_t")) / F.greatest("page_height", F.lit(1.0))
    score = (
        F.exp(-far / p.decay) * p.distance + (F.col("column_s") == F.col("column_t")).cast("double") * p.column + F.least("lang_conf_s", "lang_conf_t") * p.language
        + (F.col("has_marker_s") | F.col("has_marker_t")).cast("double") * p.markers + (F.col("ord_t") > F.col("ord_s")).cast("double") * p.order
        - F.when(F.col("is_commentary_t"), p.commentary_penalty).otherwise(0.0)
    )
    near = F.abs(F.col("y_s") - F.col("y_t")) <= p.interlinear_window
    joined = s.join(t, "page_id").where(far <= p.max_distance).withColumn("score", score)
    tier = F.lit(None).cast("string")
    for name, least in sorted(p.tiers, key=lambda x: x[1]):
        tier = F.when(F.col("score") >= least, name).otherwise(tier)
    return joined.withColumn("tier", tier).where("tier IS NOT NULL").select("page_id", F.col("block_id_s").alias("source_id"), F.col("block_id_t").alias("target_id"), "score", "tier", near.alias("interlinear"))


def _by_page(scored: DataFrame, *order: Column | str) -> DataFrame:
    """Pages one after the other in each partition, their pairs numbered in order by n. The window, unlike a repartition, says what the
    following step needs, so adaptive execution can't split a page."""
    return scored.withColumn("n", F.row_number().over(Window.partitionBy("page_id").orderBy(*order)))


def greedy(scored: DataFrame) -> DataFrame:
    """The best pair first, then the best of what remains. A page's pairs pass by in that order; only the blocks it has taken are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources, targets = set(), set()
        for batch in batches:
            keep = []
            for n, s, t in zip(*(batch.column(c).to_pylist() for c in ("n", "source_id", "target_id"))):
                if n == 1:
                    sources, targets = set(), set()
                free = s not in sources and t not in targets
                if free:
                    sources.add(s)
                    targets.add(t)
                keep.append(free)
            yield batch.filter(pa.array(keep, pa.bool_())).select(columns)

    columns = scored.columns
    return _by_page(scored, F.desc("score"), "source_id", "target_id").mapInArrow(run, scored.schema)


def assignment(cost: list[list[float]]) -> list[int]:
    """For each row its column in an assignment of least cost (rows <= columns), by shortest augmenting paths."""
    n, m = len(cost), len(cost[0]) if cost else 0
    row_price, col_price, row_of = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row_of[0], at = i, 0
        least, came, seen = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while row_of[at]:
            seen[at] = True
            i0, step, to = row_of[at], float("inf"), 0
            for j in range(1, m + 1):
                if not seen[j]:
                    reduced = cost[i0 - 1][j - 1] - row_price[i0] - col_price[j]
                    if reduced < least[j]:
                        least[j], came[j] = reduced, at
                    if least[j] < step:
                        step, to = least[j], j
            for j in range(m + 1):
                if seen[j]:
                    row_price[row_of[j]] += step
                    col_price[j] -= step
                else:
                    least[j] -= step
            at = to
        while at:
            row_of[at] = row_of[came[at]]
            at = came[at]
    out = [-1] * n
    for j in range(1, m + 1):
        if row_of[j]:
            out[row_of[j] - 1] = j - 1
    return out


def _best_total(pairs: list[tuple]) -> list[int]:
    """Of a page's pairs (source, target, score) the places of those with the greatest total."""
    if len(pairs) == 1 and not pairs[0][2] <= 0:
        return [0]
    # infinite scores don't add up, so they weigh more than all others together; NaN is the greatest, as it is in Spark
    top = 1.0 + sum(abs(x) for _, _, x in pairs if math.isfinite(x))
    at = {(s, t): (x if math.isfinite(x) else -top if x < 0 else top, k) for k, (s, t, x) in enumerate(pairs)}
    left, right = (sorted(set(ids), key=lambda b: (b is not None, b)) for ids in zip(*at))
    # every row may also stay alone, at cost 0
    cost = [[-at[a, b][0] if (a, b) in at else 1e6 for b in right] + [0.0] * len(left) for a in left]
    return sorted(at[a, right[j]][1] for a, j in zip(left, assignment(cost)) if j < len(right) and (a, right[j]) in at)


def optimal(scored: DataFrame) -> DataFrame:
    """The pairs of greatest total score on each page; a page's blocks fit in memory."""

    def solved(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = pa.Table.from_batches(parts).combine_chunks()
        starts = [*np.flatnonzero(pages.column("n").to_numpy() == 1).tolist(), pages.num_rows]
        pairs = list(zip(*(pages.column(c).to_pylist() for c in ("source_id", "target_id", "score"))))
        taken = [a + k for a, z in zip(starts, starts[1:]) for k in _best_total(pairs[a:z])]
        yield from pages.select(columns).take(pa.array(taken, pa.int64())).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # the page that may go on in the next batch
        for batch in batches:
            starts = np.flatnonzero(batch.column("n").to_numpy() == 1)
            if len(starts):
                yield from solved([*held, batch.slice(0, starts[-1])])
                held = []
            held.append(batch.slice(starts[-1] if len(starts) else 0))
        if held:
            yield from solved(held)

    columns = scored.columns
    return _by_page(scored, "source_id", "target_id").mapInArrow(run, scored.schema)
