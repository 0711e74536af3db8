"""Mixing sources to target weights along a time-varying curriculum.

Each source has a schedule: knots (t, weight) with t from 0 to 1, joined by straight lines. Its integral is the
source's weight in the mix, its running integral the share of the source's demand that training has used up by time t.
A document stands in its source's stream at the words before it; inverting the running integral there gives the
training position, and sorting by position gives the training order.

Nothing is collected: running sums go through (source, bucket) totals, where a bucket is a prefix of the md5 of the id (of the text's
hash where there is no id), so a source with a third of all rows is spread over 4096 groups, or more where there are so many rows that a group
would hold over about GROUP. Only the table of sources meets in one task: sources are expected to be few enough to be listed.

Defined cases: null text has size 0; null sources form a source of their own, last in order; rows without an id and rows that share
one are rows of their own, each with its place and copies (the hash of the row decides between them); an empty table gives an empty
plan; other columns are ignored by the plan and kept in the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.llm.common import WORD, materialize, tidy

Schedule = Sequence[tuple[float, float]]

#: Rows of a source that are ordered together.
GROUP = 20_000

#: Weights 5, 2, 1: the heaviest sources early, the lightest late.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))


def integrate(schedule: Schedule) -> list[float]:
    """The running integral at each knot."""
    out = [0.0]
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if t1 <= t0 or w0 < 0 or w1 < 0:
            raise ValueError("knots must rise in time and weigh 0 or more")
        out.append(out[-1] + (w0 + w1) / 2 * (t1 - t0))
    if len(out) < 2 or out[-1] <= 0:
        raise ValueError("a schedule needs two knots and some weight")
    return out


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(key, source, source_size) -> with rank and target.

    Targets are min(most * size, level * weight), with the one level at which they add up to share of all sizes: the
    end of resharing the excess over and over. The level is the largest of (total - capped) / (weight not capped) over
    the prefixes of the sources in order of cap / weight.
    """
    ordered = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(1))
    filled = Window.orderBy("ratio", "rank")
    return (
        ordered.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("capped", F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", F.max((F.col("total") - F.col("capped")) / F.col("open")).over(everything))
        .withColumn("target", F.greatest(F.lit(0.0), F.least("cap", F.col("level") * F.col("weight"))))
        .select("key", "source", "source_size", "rank", "target")
    )


def _position(middle, schedules: Sequence[Schedule]):
    """The time at which the share middle (0 to 1) of a source's demand is used up, for the schedule of its rank."""
    arrays = lambda rows: F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in rows]), (F.col("rank") % len(schedules) + 1).cast("int"))
    times, weights, sums = (arrays(x) for x in ([[t for t, _ in s] for s in schedules], [[w for _, w in s] for s in schedules], [integrate(s) for s in schedules]))
    need = middle * F.element_at(sums, -1)
    at = F.least(F.greatest(F.size(F.filter(sums, lambda c: c <= need)), F.lit(1)), F.size(sums) - 1)
    t0, t1, w0, w1 = (F.element_at(a, k) for a, k in ((times, at), (times, at + 1), (weights, at), (weights, at + 1)))
    rest = need - F.element_at(sums, at)
    root = w0 + F.sqrt(w0 * w0 + F.lit(2.0) * ((w1 - w0) / (t1 - t0)) * rest)
    return t0 + F.when(root > 0, F.lit(2.0) * rest / root).otherwise(F.lit(0.0))


def _sized(docs: DataFrame, *carried) -> DataFrame:
    """doc_id, source, size, order (of the rows of a source) and tie of each row, with columns carried along."""
    whole = [F.col(c) for c, kind in docs.dtypes if not any(x in kind for x in ("map<", "variant"))]
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.xxhash64("text").cast("string"))).cast("binary"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), order.alias("order"), F.xxhash64(*whole).alias("tie"), *carried)


def _planned(rows: DataFrame, sizes: DataFrame, schedules: Sequence[Schedule], share: float, most: float) -> DataFrame:
    """rows (of _sized) with source_size, target, rank, before, taken, copies; sizes are the same rows, written."""
    digits, n = 3, sizes.count()
    while n > GROUP * 16**digits:
        digits += 1
    keyed = lambda df: df.withColumns({"key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")), "bucket": F.substring("order", 1, digits)})
    totals = keyed(sizes).groupBy("key", "bucket").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    sources = totals.groupBy("key").agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(sources, [integrate(s)[-1] for s in schedules], share, most).drop("source")
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("key", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset")).join(targets, "key")
    within = Window.partitionBy("key", "bucket").orderBy("order", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    stop, start = F.floor(F.col("target") + 0.5), F.col("before")
    passes = [start + F.col("source_size") * k for k in range(int(-(-most // 1)))]
    return (
        keyed(rows).join(offsets, ["key", "bucket"])
        .withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .withColumn("taken", sum((F.least("size", F.greatest(F.lit(0), stop - p)) for p in passes), F.lit(0)).cast("long"))
        .withColumn("copies", sum(((p + F.col("size") / 2 < stop).cast("int") for p in passes), F.lit(0)))
        .drop("key", "bucket", "offset")
    )


@tidy
def mix(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The plan of a mix: one row per document.

    doc_id, source, size (words), source_size, target (of its source), before (words ahead of it in its source), taken
    (words the mix takes: the source's stream is read from its start, over again at most `most` times, and cut at the
    target, so at most one document of a source is taken in part), copies (whole copies when documents aren't cut: one
    for each time that its middle lies before the target), position (of its first copy, null where nothing is taken).
    """
    sizes = materialize(_sized(docs), "sizes")
    position = F.when(F.col("taken") > 0, _position(F.least(F.lit(1.0), (F.col("before") + F.col("size") / 2) / F.col("target")), schedules))
    return _planned(sizes, sizes, schedules, share, most).withColumn("position", position).select("doc_id", "source", "size", "source_size", "target", "before", "taken", "copies", "position", "rank")


@tidy
def training_order(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed corpus: docs' columns, a row for each whole copy, range-sorted by training position. docs is read twice and must not
    change in between."""
    sizes = materialize(_sized(docs), "sizes")
    rows = _planned(_sized(docs, F.struct("*").alias("row")), sizes, schedules, share, most)
    copies = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    middle = F.least(F.lit(1.0), (F.col("before") + F.col("copy") * F.col("source_size") + F.col("size") / 2) / F.col("target"))
    placed = copies.select(_position(middle, schedules).alias("position"), "order", "doc_id", "tie", "copy", "row")
    return placed.orderBy("position", "order", "doc_id", "tie", "copy").select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(CAST(doc_id AS VARCHAR)) AS o FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][k % 3 + 1] AS weight, 2 * source_size AS cap FROM r),
f AS (SELECT *, 1.5 * sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
        sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
t AS (SELECT source, source_size, k, weight, least(cap, max((total - capped) / rest) OVER () * weight) AS target FROM f),
b AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before FROM d),
j AS (SELECT b.doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, k, weight,
        CAST(least(size, greatest(0, floor(target + 0.5) - before)) + least(size, greatest(0, floor(target + 0.5) - before - source_size)) AS BIGINT) AS taken,
        weight * least(1, (before + size / 2) / target) AS need
      FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken,
  CASE WHEN taken > 0 THEN round(2 * need / ([7.5::DOUBLE, 2.0, 0.5][k % 3 + 1] + sqrt(pow([7.5::DOUBLE, 2.0, 0.5][k % 3 + 1], 2) + 2 * [-5.0::DOUBLE, 0.0, 1.0][k % 3 + 1] * need)), 6) END AS position
FROM j
"""
