"""From lines to candidates: what an engine read on a page at an angle, in the variant that served it best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.text import diacritic_richness, normalize_whitespace, strip
from quorumtext.operators.layout import Layout, reading_order

READING = ("page_id", "angle", "angle_ord", "engine", "engine_ord", "variant", "variant_ord")

# The image variants that engines are tried on, in this order.
PREFERRED = {"": ("adaptive", "morphology", "contrast", "sharpen", "original"), "kraken": ("morphology", "adaptive", "binary", "sharpen", "contrast")}


def preferred_variants(engine: str) -> tuple[str, ...]:
    return PREFERRED.get(engine, PREFERRED[""])


def quality(text: Column, confidence: Column) -> Column:
    return F.length(strip(text)) + 100.0 * confidence + 50.0 * diacritic_richness(text)


def readings(lines: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Lines (with page_width) to one row per engine and variant, text in reading order. Missing confidences don't count in the mean."""
    # dealt by what all steps up to the best variant share, so that texts move once
    ordered = reading_order(lines.repartition("page_id", "angle", "engine"), READING, layout)
    grouped = ordered.groupBy(*READING).agg(
        F.array_sort(F.collect_list(F.struct("position", "text"))).alias("lines"),
        F.coalesce(F.avg("raw_confidence"), F.lit(0.0)).alias("confidence"),
        F.count(F.lit(1)).cast("int").alias("line_count"),
    )
    text = normalize_whitespace(F.array_join(F.transform("lines", lambda x: x["text"]), "\n"))
    return grouped.withColumn("text", text).drop("lines")


def best_variant(candidates: DataFrame) -> DataFrame:
    """One candidate per page, angle and engine: the best quality, the first variant of equals."""
    keys = [k for k in READING if not k.startswith("variant")]
    rest = [c for c in candidates.columns if c not in keys]
    better = F.struct(quality(F.col("text"), F.col("confidence")), -F.col("variant_ord"))
    best = candidates.where(strip(F.col("text")) != "").groupBy(*keys).agg(F.max_by(F.struct(*rest), better).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in rest if c != "variant_ord"])
