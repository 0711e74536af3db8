"""Whether a corrected text may replace what was read: budgets for edits, words, kept characters and lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.text import SPACE, split_lines


@dataclass(frozen=True)
class Guardrails:
    akkadian_budget: float = 0.03
    other_budget: float = 0.15
    vocabulary_ratio: float = 1.6
    preserve: str = "šṣṭḫāēīūᵈᵐᶠ"
    same_line_count: bool = True


def edit_share(before: Column, after: Column) -> Column:
    return F.levenshtein(before, after) / F.greatest(F.length(before), F.lit(1))


def _vocabulary(text: Column) -> Column:
    return F.size(F.array_distinct(F.filter(F.split(text, SPACE + "+"), lambda w: w != "")))


def _kept(before: Column, after: Column, signs: str) -> Column:
    count = lambda t, c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    kept = F.lit(True)
    for c in signs:
        kept &= count(after, c) >= count(before, c)
    return kept


def accept(rows: DataFrame, rails: Guardrails = Guardrails()) -> DataFrame:
    """rows (before, after, is_akkadian) with edit_share, and accepted by all rails."""
    before, after = F.col("before"), F.col("after")
    budget = F.when(F.col("is_akkadian"), rails.akkadian_budget).otherwise(rails.other_budget)
    ok = (F.col("edit_share") <= budget) & (_vocabulary(after) <= rails.vocabulary_ratio * F.greatest(_vocabulary(before), F.lit(1))) & _kept(before, after, rails.preserve)
    if rails.same_line_count:
        ok &= F.size(split_lines(before)) == F.size(split_lines(after))
    return rows.withColumn("edit_share", edit_share(before, after)).withColumn("accepted", ok)


def line_limits(lines: DataFrame, keys: list[str], min_confidence: float = 0.55, max_lines: int = 1000) -> DataFrame:
    """Lines confident enough, the first max_lines of each page by line_no; lines without a confidence stay."""
    from pyspark.sql import Window

    sure = lines.where(F.col("raw_confidence").isNull() | (F.col("raw_confidence") >= min_confidence))
    return sure.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("line_no"))).where(F.col("_n") <= max_lines).drop("_n")


def quality_filter(lines: DataFrame, min_confidence: float = 0.55, min_height: float = 8.0, max_rotation: float = 5.0) -> DataFrame:
    """Lines that are sure, high and level enough; what a line doesn't say (confidence, box, a column rotation) isn't held against it."""
    ok = (F.col("raw_confidence").isNull() | (F.col("raw_confidence") >= min_confidence)) & (F.col("bbox").isNull() | (F.col("bbox.y1") - F.col("bbox.y0") >= min_height))
    if "rotation" in lines.columns:
        ok &= F.col("rotation").isNull() | (F.abs("rotation") <= max_rotation)
    return lines.where(ok)


def block_role(text: Column) -> Column:
    """A coarse role by pattern: reference, figure, header or body."""
    return (
        F.when(text.rlike(r"(?i)^\s*(\[\d+\]|\d+\)|see |cf\.|vgl\.|bkz\.)"), "reference")
        .when(text.rlike(r"(?i)^\s*(fig(ure|\.)|abb(ildung|\.)|res(im|\.)|tab(le|elle|lo|\.))\s*\d"), "figure")
        .when((F.length(text) <= 60) & text.rlike(r"^\s*(\d{1,4}\s*)?[\p{Lu}\d .,:–-]+(\s*\d{1,4})?\s*$"), "header")
        .otherwise("body")
    )


def word_votes(readings: DataFrame, keys: list[str], min_agreement: int = 2) -> DataFrame:
    """Word-level voting: (keys, engine_ord, text) -> keys, text: at each place the word most engines read, if at least min_agreement, else the
    first engine's; more places than an engine has count for the others alone."""
    words = readings.select(*keys, "engine_ord", F.posexplode(F.split("text", SPACE + "+")).alias("place", "word"))
    votes = words.groupBy(*keys, "place", "word").agg(F.count(F.lit(1)).alias("n"), F.min("engine_ord").alias("first"))
    agreed = F.when(F.col("n") >= min_agreement, F.col("n")).otherwise(F.lit(0))
    best = votes.groupBy(*keys, "place").agg(F.max(F.struct(agreed.alias("n"), (-F.col("first")).alias("first"), "word")).alias("best"))
    return best.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("best.word").alias("word")))), lambda x: x["word"]), " ").alias("text"))
