"""The page-text plan: text layer where it is sound, recognition only for the other pages, detection, and rows for the deliverables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.charlm import CharLM
from quorumtext.operators.candidates import best_variant, readings
from quorumtext.operators.detect import DetectionProfile, detect
from quorumtext.operators.fusion import choose_text, error_map, extract_pages
from quorumtext.operators.layout import Layout
from quorumtext.plans.options import EnsembleProfile, PipelineOptions
from quorumtext.sources.engines import failure_rows, loaded, read_lines

KEYS = ["pdf_name", "page"]


def recognize(pages: DataFrame, profile: EnsembleProfile, kind: str = "ensemble") -> DataFrame:
    """page_id, ocr_text, winner, engines, errors and scores for pages, by the registered line sources that start: those of the profile, or
    the one engine that kind names."""
    sized = pages.select("page_id", "page_width")
    ready, failed = loaded(list(profile.engines) if kind == "ensemble" else [kind], pages)
    if not ready:  # every page is empty, and says why
        empty = pages.select("page_id", F.lit("").alias("ocr_text"), F.array().cast("array<string>").alias("engines_used"), F.lit("ensemble").alias("winner"))
        return empty.join(error_map(failure_rows(pages, failed, profile.angles)), "page_id", "left")
    lines = read_lines(pages, ready).drop("page_width").join(sized, "page_id")
    candidates = best_variant(readings(lines, Layout(**profile.layout)))
    found = extract_pages(pages, candidates, profile.weights).withColumnRenamed("text", "ocr_text").drop("method")
    return found.join(error_map(failure_rows(pages, failed, profile.angles)), "page_id", "left")


def page_text(pages: DataFrame, options: PipelineOptions, profile: EnsembleProfile = EnsembleProfile(), detection: DetectionProfile = DetectionProfile(), model: CharLM | None = None) -> DataFrame:
    """pages (page_id, pdf_name, page, page_width, layer_text, layer_ok) -> pdf_name, page, page_text, has_akkadian, used_text_layer, method.

    Pages whose layer is sound never reach recognition (unless it is forced): they are split off before it, as an expression
    alone would not save the work.
    """
    sound = F.coalesce(F.col("layer_ok"), F.lit(False))
    done = pages.where(sound) if options.prefer_text_layer and not options.force_ocr else pages.where(F.lit(False))
    rest = pages.where(~sound) if options.prefer_text_layer and not options.force_ocr else pages
    columns = ["page_id", *KEYS, "layer_text", "layer_ok"]
    if options.ocr_fallback:
        read = rest.select(*columns).join(recognize(rest, profile, options.ocr_fallback).select("page_id", "ocr_text"), "page_id", "left")
    else:
        read = rest.select(*columns).withColumn("ocr_text", F.lit(""))
    every = done.select(*columns).withColumn("ocr_text", F.lit("")).unionByName(read)
    chosen = choose_text(every, options.force_ocr, options.ocr_fallback or "ensemble")
    return detect(chosen, ["page_id"], detection, "page_text", model).select(*KEYS, "page_text", "has_akkadian", "used_text_layer", "method")


def unprocessed(pages: DataFrame, finished: DataFrame) -> DataFrame:
    """The pages that an earlier run hasn't written."""
    return pages.join(finished.select(*KEYS), KEYS, "left_anti")
