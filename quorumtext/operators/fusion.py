"""Consensus of the candidates of a page at an angle.

The few candidates of a page are one array, so scoring needs one grouping and no self-join; the pairs to compare are arrays too, and go
through one Arrow UDF call, in one Python worker for all of a page's comparisons. Equal and empty keys are settled before it; pages that
don't need a comparison (one candidate, or the other branch) send none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorumtext.functions.similarity import Ratios
from quorumtext.functions.text import alnum_ratio, comparison_key, completeness, contains_arabic, diacritic_richness, normalize_whitespace, split_lines, strip

PAGE = ("page_id", "angle", "angle_ord")


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def similarities(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Element by element similarity of two arrays of keys, null where a key is null; pairs that repeat in a batch are matched once."""
    for a, b in pairs:
        known = Ratios()
        found = [None if x is None or y is None else known[x, y] for x, y in zip(a.flatten().to_pylist(), b.flatten().to_pylist())]
        ends = np.cumsum([0, *a.value_lengths().to_pylist()], dtype="int32")
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.float64()))


def _weight(weights: dict[str, float] | None) -> callable:
    items = [x for k, v in (weights or {}).items() for x in (F.lit(k), F.lit(float(v)))]
    return lambda engine: F.coalesce(F.element_at(F.create_map(*items), engine), F.lit(1.0)) if items else F.lit(1.0)


def _mean(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)).otherwise(F.lit(0.0))


def _mean_of(pairs: Column, at: callable) -> Column:
    """The mean similarity of the scored pairs for which at holds."""
    return _mean(F.transform(F.filter(pairs, at), lambda p: p["s"]))


def _settled(p: Column) -> Column:
    """The similarity of a pair that needs no matching, else null."""
    return F.when(p["a"] == p["b"], 1.0).when((p["a"] == "") | (p["b"] == ""), 0.0)


def _scored(df: DataFrame, **pairs: Column) -> DataFrame:
    """Adds arrays of pairs, structs with keys a and b, with their similarity s. All arrays go through one call."""
    df = df.withColumns(pairs)
    side = lambda k: F.concat(*[F.transform(name, lambda p: F.when(_settled(p).isNull(), p[k])) for name in pairs])
    df, start = df.withColumn("_s", similarities(side("a"), side("b"))), F.lit(1)
    done = {}
    for name in pairs:
        done[name] = F.zip_with(name, F.slice("_s", start, F.size(name)), lambda p, x: p.withField("s", F.coalesce(_settled(p), x)))
        start = start + F.size(name)
    return df.withColumns(done).drop("_s")


def gathered(candidates: DataFrame) -> DataFrame:
    """page, angle -> c: its candidates with text, in engine order, with keys and lines."""
    viable = candidates.where(strip(F.col("text")) != "")
    ready = viable.withColumns({"key": comparison_key(F.col("text")), "richness": diacritic_richness(F.col("text")), "lines": split_lines(F.col("text"))})
    fields = ["engine_ord", "engine", "text", "confidence", "variant", "line_count", "key", "richness", "lines"]
    return ready.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("c"))


def _whole_pairs(c: Column, wanted: Column) -> Column:
    others = lambda x, i: F.transform(F.filter(c, lambda y: y["engine"] != x["engine"]), lambda y: F.struct(i.alias("i"), x["key"].alias("a"), y["key"].alias("b")))
    return F.flatten(F.transform(F.when(wanted, c).otherwise(F.slice(c, 1, 0)), others))


def whole_scores(df: DataFrame, weights: dict[str, float] | None = None, wanted: Column | None = None) -> DataFrame:
    """Adds whole: per candidate its score as a whole text (empty where not wanted)."""
    wanted = F.lit(True) if wanted is None else wanted
    return _whole(_scored(df, wp=_whole_pairs(F.col("c"), wanted)), weights, wanted)


def _whole(df: DataFrame, weights: dict[str, float] | None, wanted: Column) -> DataFrame:
    """whole from the scored pairs wp."""
    weight = _weight(weights)
    score = lambda x, i: (
        weight(x["engine"]) * 0.35 + _mean_of(F.col("wp"), lambda p: p["i"] == i) + x["richness"] * 0.4 + completeness(x["text"]) * 0.1
        + F.greatest(x["confidence"], F.lit(0.0)) * 0.15 + F.least(F.coalesce(x["line_count"], F.lit(0)) / 12.0, F.lit(1.0)) * 0.12
    )
    return df.withColumn("whole", F.transform(F.when(wanted, F.col("c")).otherwise(F.slice("c", 1, 0)), score)).drop("wp")


def line_scores(df: DataFrame, weights: dict[str, float] | None = None, wanted: Column | None = None) -> DataFrame:
    """Adds options: per line number an array of (score, -place, line) over the candidates (empty where not wanted)."""
    df = _with_rows(df, F.lit(True) if wanted is None else wanted)
    return _options(_scored(df, lp=_line_pairs()), weights)


def _with_rows(df: DataFrame, wanted: Column) -> DataFrame:
    """Adds rows: per line number the candidates' lines. The key of an only line is that of the text."""
    key = lambda x, n: F.when(F.size(x["lines"]) == 1, F.when(n == 0, x["key"])).otherwise(comparison_key(F.get(x["lines"], n)))
    numbers = F.when(wanted, F.sequence(F.lit(0), F.size(F.get("c", F.lit(0))["lines"]) - 1)).otherwise(F.array().cast("array<int>"))
    return df.withColumn("rows", F.transform(numbers, lambda n: F.transform("c", lambda x, i: F.struct(
        n.alias("n"), i.alias("i"), x["engine"].alias("engine"), x["confidence"].alias("confidence"), F.get(x["lines"], n).alias("line"), key(x, n).alias("key")
    ))))


def _line_pairs() -> Column:
    """For each line and candidate one pair with every candidate, in order, so that they are found by place; keys are null where the lines
    are equal."""
    pair = lambda x, y: F.when(x["line"] != y["line"], F.struct(x["key"].alias("a"), y["key"].alias("b"))).otherwise(F.struct(F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b")))
    return F.flatten(F.transform("rows", lambda row: F.flatten(F.transform(row, lambda x: F.transform(row, lambda y: pair(x, y))))))


def _options(df: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """options from rows and the scored pairs lp."""
    weight = _weight(weights)
    score = lambda x: (
        weight(x["engine"]) * 0.35 + _mean_of(F.slice("lp", (x["n"] * F.size("c") + x["i"]) * F.size("c") + 1, F.size("c")), lambda p: p["a"].isNotNull()) + diacritic_richness(x["line"]) * 0.45
        + F.when(contains_arabic(x["line"]), 0.15).otherwise(0.0) + x["confidence"] * 0.1
    )
    options = F.transform("rows", lambda row: F.transform(row, lambda x: F.struct(score(x).alias("score"), (-x["i"]).alias("place"), x["line"].alias("line"))))
    return df.withColumn("options", options).drop("rows", "lp")


def _orientation_pairs() -> Column:
    return F.flatten(F.transform("c", lambda x, i: F.transform(F.filter("c", lambda y, j: j > i), lambda y: F.struct(x["key"].alias("a"), y["key"].alias("b")))))


def fuse(candidates: DataFrame, weights: dict[str, float] | None = None, keep_candidates: bool = False) -> DataFrame:
    """One row per page and angle that has a candidate with text.

    One candidate stays as it is; equal numbers of lines are fused line by line, the best option of each; otherwise the best whole text
    wins. Ties go to the engine that comes first. Kept candidates (c) come with the pairs that orientation_scores() compares (op).
    """
    df = gathered(candidates).withColumn("n", F.size("c"))
    counts = F.transform("c", lambda x: F.size(x["lines"]))
    df = df.withColumn("branch", F.when(F.col("n") == 1, "one").when(F.array_min(counts) == F.array_max(counts), "lines").otherwise("whole"))
    whole, lines = F.col("branch") == "whole", F.col("branch") == "lines"
    pairs = {"wp": _whole_pairs(F.col("c"), whole), "lp": _line_pairs()} | ({"op": _orientation_pairs()} if keep_candidates else {})
    df = _options(_whole(_scored(_with_rows(df, lines), **pairs), weights, whole), weights)
    best = F.get("c", -F.array_max(F.transform("whole", lambda s, i: F.struct(s.alias("s"), (-i).alias("place"))))["place"])
    first, engines = F.get("c", F.lit(0)), F.transform("c", lambda x: x["engine"])
    fused = normalize_whitespace(F.array_join(F.transform("options", lambda o: F.array_max(o)["line"]), "\n"))
    mean = F.aggregate("c", F.lit(0.0), lambda a, x: a + x["confidence"]) / F.col("n")
    by = lambda one, lines, whole: F.when(F.col("branch") == "one", one).when(F.col("branch") == "lines", lines).otherwise(whole)
    none = F.lit(None)
    done = df.withColumn("best", best).select(
        *PAGE,
        by(first["engine"], F.lit("ensemble"), F.lit("ensemble")).alias("engine"),
        by(first["text"], fused, F.col("best.text")).alias("text"),
        by(first["confidence"], mean, F.col("best.confidence")).alias("confidence"),
        by(first["variant"], F.lit("fused"), F.col("best.variant")).alias("variant"),
        by(none.cast("string"), F.lit("line_consensus"), F.lit("whole_text_consensus")).alias("method"),
        by(none.cast("string"), none.cast("string"), F.col("best.engine")).alias("winner"),
        by(none.cast("array<string>"), engines, none.cast("array<string>")).alias("sources"),
        engines.alias("engines_used"),
        *(["c", "op"] if keep_candidates else []),
    )
    return done


def orientation_scores(fused: DataFrame) -> DataFrame:
    """fused with keep_candidates -> with score: how much a page at this angle looks like text read upright."""
    df = fused if "op" in fused.columns else _scored(fused, op=_orientation_pairs())
    text = strip(F.col("text"))
    confidence = F.aggregate("c", F.lit(0.0), lambda a, x: a + x["confidence"]) / F.size("c")
    score = (
        F.length(text) / 120.0 + confidence * 0.8 + _mean(F.transform("op", lambda p: p["s"])) * 0.7 + alnum_ratio(text) * 0.4
        + diacritic_richness(text) * 2.0 + F.least(F.size(split_lines(text)) / 12.0, F.lit(1.0)) * 0.35
    )
    return df.withColumn("score", F.when(text == "", F.lit(-1.0)).otherwise(score)).drop("op", "c")


def best_orientation(scored: DataFrame) -> DataFrame:
    """One row per page: the angle with the best score, the first of equals, and all scores by angle."""
    row = F.struct("score", (-F.col("angle_ord")).alias("place"), *[c for c in scored.columns if c not in ("score", "page_id")])
    angles = F.array_sort(F.collect_list(F.struct("angle_ord", F.col("angle").cast("string").alias("angle"), F.bround("score", 4).alias("score"))))
    best = scored.groupBy("page_id").agg(F.max(row).alias("best"), angles.alias("angles"))
    return best.select(
        "page_id", "best.text", F.lit("ensemble").alias("method"), F.col("best.engines_used").alias("engines_used"), F.coalesce("best.winner", F.lit("ensemble")).alias("winner"),
        F.col("best.angle").alias("rotation_angle"), F.map_from_entries(F.transform("angles", lambda a: F.struct(a["angle"], a["score"]))).alias("orientation_scores"),
    )


def error_map(errors: DataFrame) -> DataFrame:
    """(page_id, angle_ord, angle, engine, error) -> page_id, errors: engine@angle to message; of equal keys the last angle wins."""
    name = F.concat_ws("@", "engine", F.col("angle").cast("string"))
    last = errors.groupBy("page_id", name.alias("name")).agg(F.max_by("error", "angle_ord").alias("error"))
    return last.groupBy("page_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "error")))).alias("errors"))


def extract_pages(pages: DataFrame, candidates: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, text and what it rests on, for every page; pages that no engine read have empty text."""
    found = best_orientation(orientation_scores(fuse(candidates, weights, keep_candidates=True)))
    joined = pages.select("page_id").join(found, "page_id", "left")
    return joined.withColumns({"text": F.coalesce("text", F.lit("")), "method": F.lit("ensemble"), "engines_used": F.coalesce("engines_used", F.array().cast("array<string>"))})


def choose_text(pages: DataFrame, force_ocr: bool = False, kind: str = "ensemble") -> DataFrame:
    """pages (layer_text, layer_ok, ocr_text) with page_text, used_text_layer and method (text_layer, or ocr_ and the kind of recognition).

    A sound text layer is taken unless OCR is forced; forced OCR that reads nothing falls back to a sound layer.
    """
    read = F.coalesce(strip(F.col("ocr_text")) != "", F.lit(False))
    layer = F.coalesce(F.col("layer_ok"), F.lit(False)) & (~read if force_ocr else F.lit(True))
    return pages.withColumns({
        "page_text": F.when(layer, F.col("layer_text")).otherwise(F.coalesce("ocr_text", F.lit(""))),
        "used_text_layer": layer,
        "method": F.when(layer, "text_layer").otherwise(f"ocr_{kind}"),
    })
