"""The pairs that consensus compares, as joins: for inspection, and for terms that need no similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.text import split_lines

PAGE = ["page_id", "angle"]


def _sides(df: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    return tuple(df.select(*PAGE, *[F.col(c).alias(f"{c}_{side}") for c in names]) for side in "ab")


def candidate_pairs(candidates: DataFrame) -> DataFrame:
    """Ordered pairs of candidates of different engines on a page at an angle."""
    a, b = _sides(candidates, ["engine", "engine_ord"])
    return a.join(b, PAGE).where("engine_a <> engine_b")


def unordered_pairs(candidates: DataFrame) -> DataFrame:
    a, b = _sides(candidates, ["engine", "engine_ord"])
    return a.join(b, PAGE).where("engine_ord_a < engine_ord_b")


def candidate_lines(candidates: DataFrame) -> DataFrame:
    """One row per candidate and line number."""
    return candidates.select(*PAGE, "engine", "engine_ord", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))


def line_pairs(candidates: DataFrame) -> DataFrame:
    """Ordered pairs of lines at the same number whose texts differ; equal lines don't compare."""
    lines = candidate_lines(candidates)
    a, b = (lines.select(*PAGE, "line_no", F.col("engine").alias(f"engine_{s}"), F.col("line").alias(f"line_{s}")) for s in "ab")
    return a.join(b, [*PAGE, "line_no"]).where("line_a <> line_b")


def weighted(candidates: DataFrame, weights: DataFrame) -> DataFrame:
    """candidates with their engine's weight, 1 where weights (engine, weight) has none."""
    return candidates.join(weights, "engine", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
