"""Boxes, as struct<x0, y0, x1, y1> in page pixels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box, or null where a coordinate is missing."""
    sides = {"x0": x0, "y0": y0, "x1": x1, "y1": y1}
    whole = x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()
    return F.when(whole, F.struct(*[v.cast("double").alias(k) for k, v in sides.items()]))


def polygon_box(points: Column) -> Column:
    """The box around array<array<double>> points; null for none, or if any point lacks a coordinate."""
    at = lambda i: F.transform(points, lambda p: F.get(p, F.lit(i)).cast("double"))
    sound = (F.size(points) > 0) & ~F.exists(points, lambda p: p.isNull() | (F.size(p) < 2) | F.get(p, F.lit(0)).isNull() | F.get(p, F.lit(1)).isNull())
    return F.when(sound, box(F.array_min(at(0)), F.array_min(at(1)), F.array_max(at(0)), F.array_max(at(1))))


def scaled_box(geometry: Column, width: Column, height: Column) -> Column:
    """Shares of the page to pixels: two points of two numbers are corners in their order, more are a polygon."""
    at = lambda i, k: F.get(F.get(geometry, F.lit(i)), F.lit(k)).cast("double")
    corners = (F.size(geometry) == 2) & (F.size(F.get(geometry, F.lit(0))) == 2) & (F.size(F.get(geometry, F.lit(1))) == 2)
    around = polygon_box(F.transform(geometry, lambda p: F.array(F.get(p, F.lit(0)) * width, F.get(p, F.lit(1)) * height)))
    return F.when(corners, box(at(0, 0) * width, at(0, 1) * height, at(1, 0) * width, at(1, 1) * height)).otherwise(around)


def union_box(boxes: Column) -> Column:
    """The box around an array of boxes, null for none."""
    side = lambda name: F.transform(F.filter(boxes, lambda b: b.isNotNull()), lambda b: b[name])
    return box(F.array_min(side("x0")), F.array_min(side("y0")), F.array_max(side("x1")), F.array_max(side("y1")))


def x_center(b: Column) -> Column:
    return (b["x0"] + b["x1"]) / 2.0


def rotated_box(b: Column, angle: Column, width: Column, height: Column) -> Column:
    """A box after the page turned counter-clockwise by a multiple of 90 degrees, the page growing to fit."""
    turn = F.pmod(angle, F.lit(360))
    return (
        F.when(turn == 0, b)
        .when(turn == 90, box(b["y0"], width - b["x1"], b["y1"], width - b["x0"]))
        .when(turn == 180, box(width - b["x1"], height - b["y1"], width - b["x0"], height - b["y0"]))
        .when(turn == 270, box(height - b["y1"], b["x0"], height - b["y0"], b["x1"]))
    )


def dpi_scale(dpi: Column) -> Column:
    return dpi / 72.0
