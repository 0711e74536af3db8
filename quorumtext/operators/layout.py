"""Reading order of lines on a page: top to bottom, or two columns where one wide gap separates them.

All steps are windows over the same keys, so one shuffle serves them and large pages sort with spill.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.functions.geometry import x_center
from quorumtext.functions.text import SPACE


@dataclass(frozen=True)
class Layout:
    detect_multi_column: bool = True
    min_lines_for_columns: int = 4
    column_gap_ratio: float = 0.14
    column_overlap_ratio: float = 0.55


#: A column gap is never taken for one below so many pixels, nor columns with fewer lines than these.
LEAST_GAP, LEAST_CENTERS, LEAST_SIDE = 24.0, 4, 2


def visible(text: Column) -> Column:
    """Whether anything but white space is there."""
    return text.rlike("[^" + SPACE[1:])


def column_gap(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """lines with center, gap (to the next center on the page) and split: the page's widest gap, first of equals, as (gap, middle)."""
    by_center = Window.partitionBy(*keys).orderBy(F.col("center").asc_nulls_last(), "line_no")
    page = Window.partitionBy(*keys)
    after = F.lead("center").over(by_center)
    return (
        lines.withColumn("center", x_center(F.col("bbox")))
        .withColumn("gap", after - F.col("center"))
        .withColumn("middle", (F.col("center") + after) / 2.0)
        .withColumn("split", F.max(F.when(F.col("gap") > 0, F.struct("gap", (-F.col("center")).alias("first"), "middle"))).over(page))
    )


def reading_order(lines: DataFrame, keys: Sequence[str], layout: Layout = Layout()) -> DataFrame:
    """Visible lines (keys, line_no, text, bbox, page_width) with columns (1 or 2), column (null without a box) and position from 1.

    Two columns need enough boxed lines, a gap that is wide for the page, two lines on each side and little overlap. Lines
    without a box come last, in their own order.
    """
    page = Window.partitionBy(*keys)
    width = F.greatest(F.coalesce("page_width", F.lit(1.0)), F.lit(1.0))
    found = column_gap(lines.where(visible(F.col("text"))), keys)
    side = F.when(F.col("bbox").isNull(), None).when(F.col("center") <= F.col("split.middle"), 0).otherwise(1)
    of = lambda name, k, f: f(F.when(F.col("side") == k, F.col("bbox")[name])).over(page)
    sided = (
        found.withColumn("side", side)
        .withColumn("boxed", F.count("bbox").over(page))
        .withColumns({"left_n": F.count(F.when(F.col("side") == 0, 1)).over(page), "right_n": F.count(F.when(F.col("side") == 1, 1)).over(page)})
        .withColumns({"left_x0": of("x0", 0, F.min), "left_x1": of("x1", 0, F.max), "right_x0": of("x0", 1, F.min)})
    )
    apart = (F.col("right_x0") > F.col("left_x1")) | ((F.col("left_x1") - F.col("right_x0")) / width <= layout.column_overlap_ratio)
    two = (
        F.lit(layout.detect_multi_column)
        & (F.col("boxed") >= max(2, layout.min_lines_for_columns, LEAST_CENTERS))
        & (F.col("split.gap") >= F.greatest(width * layout.column_gap_ratio, F.lit(LEAST_GAP)))
        & (F.col("left_n") >= LEAST_SIDE) & (F.col("right_n") >= LEAST_SIDE) & apart
    )
    turned = F.col("right_x0") < F.col("left_x0")
    column = F.when(F.col("two"), F.when(turned, 1 - F.col("side")).otherwise(F.col("side"))).otherwise(F.when(F.col("bbox").isNotNull(), 0))
    order = Window.partitionBy(*keys).orderBy(F.col("column").asc_nulls_last(), F.col("bbox.y0").asc_nulls_last(), F.col("bbox.x0").asc_nulls_last(), "line_no")
    done = sided.withColumn("two", F.coalesce(two, F.lit(False))).withColumn("column", column).withColumn("position", F.row_number().over(order))
    return done.select(*lines.columns, F.when(F.col("two"), 2).otherwise(1).alias("columns"), "column", "position")
