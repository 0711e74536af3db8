"""Page manifests: from a table of gold rows to (pdf_path, page), with page ranges and missing files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names that gold tables use, the first that is there counts.
PDF_COLUMNS = ("PDF LINK", "pdf", "pdf_name", "pdf_link", "file", "filename")
PAGE_COLUMNS = ("PAGE", "page", "page_no", "page_number")


def pick_column(names: Sequence[str], wanted: Sequence[str]) -> str:
    """The column of the first wanted name, in any case; of columns that differ in case alone the last."""
    by_name = {n.lower().lstrip("﻿"): n for n in names}
    for name in wanted:
        if name.lower() in by_name:
            return by_name[name.lower()]
    raise ValueError(f"none of {', '.join(wanted)} is among the columns {', '.join(names)}")


def _number(text: Column) -> Column:
    return F.expr("NULL").cast("int") if text is None else F.when(F.trim(text).rlike(r"^[+-]?\d{1,9}$"), F.trim(text).cast("int"))


def pages_of(spec: Column, expand_ranges: bool) -> Column:
    """The pages a specification names: a number, or with expand_ranges a range in either direction; else none."""
    single = _number(spec)
    one = F.when(single.isNotNull(), F.array(single)).otherwise(F.array().cast("array<int>"))
    if not expand_ranges:
        return one
    dash = F.instr(spec, "-")
    a, b = _number(F.substring(spec, F.lit(1), dash - 1)), _number(F.substring(spec, dash + 1, F.length(spec)))
    span = F.when(a.isNotNull() & b.isNotNull(), F.sequence(F.least(a, b), F.greatest(a, b))).otherwise(F.array().cast("array<int>"))
    return F.when(dash > 0, span).otherwise(one)


def gold_rows(gold: DataFrame) -> DataFrame:
    """(pdf_path, spec) of the rows that have both, trimmed."""
    pdf, page = (F.trim(F.col(f"`{pick_column(gold.columns, c)}`").cast("string")) for c in (PDF_COLUMNS, PAGE_COLUMNS))
    return gold.select(pdf.alias("pdf_path"), page.alias("spec")).where("pdf_path <> '' AND spec <> ''")


def build_manifest(gold: DataFrame, files: DataFrame, expand_ranges: bool = False, strict: bool = False) -> DataFrame:
    """(pdf_path, page), duplicates kept. files: pdf_path of those that exist; with strict only they are listed."""
    rows = gold_rows(gold)
    if strict:
        rows = rows.join(files.select("pdf_path"), "pdf_path", "left_semi")
    return rows.select("pdf_path", F.explode(pages_of(F.col("spec"), expand_ranges)).alias("page"))


def missing_files(gold: DataFrame, files: DataFrame) -> DataFrame:
    """The distinct paths that gold names and files lacks."""
    return gold_rows(gold).select("pdf_path").join(files.select("pdf_path"), "pdf_path", "left_anti").distinct()


def missing_report(gold: DataFrame, files: DataFrame, shown: int = 10) -> str:
    missing = missing_files(gold, files)
    n = missing.count()
    names = [r.pdf_path for r in missing.orderBy("pdf_path").limit(shown).collect()]
    return f"{n} missing" + "".join(f"\n  {x}" for x in names) + (f"\n  ... and {n - shown} more" if n > shown else "")


def check_strict(gold: DataFrame, files: DataFrame) -> None:
    """Raises if a file is missing, naming the first ones."""
    if not missing_files(gold, files).isEmpty():
        raise FileNotFoundError(missing_report(gold, files))


def single_pdf(pdfs: DataFrame) -> DataFrame:
    """(pdf_path, page_count, null if it couldn't be read) -> (pdf_path, page): every page, one at least."""
    return pdfs.select("pdf_path", F.explode(F.sequence(F.lit(1), F.greatest(F.coalesce("page_count", F.lit(1)), F.lit(1)))).alias("page"))
