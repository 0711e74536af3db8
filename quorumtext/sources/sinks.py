"""Deliverables. Bulk results go to parquet; the two CSV deliverables have fixed byte formats and are single files by contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.text import escape_newlines


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Tab-separated, no header."""
    manifest.select("pdf_path", "page").write.mode("overwrite").csv(path, sep="\t", header=False, quote="")


def page_text_rows(pages: DataFrame) -> DataFrame:
    """Page output as text columns: line ends escaped, lower-case booleans."""
    return pages.select("pdf_name", F.col("page").cast("int").alias("page"), escape_newlines(F.coalesce("page_text", F.lit(""))).alias("page_text"), F.col("has_akkadian").cast("string").alias("has_akkadian"))


def progress_rows(progress: DataFrame) -> DataFrame:
    """Progress as text columns: capitalized booleans, ISO time to the microsecond."""
    shown = {c: F.initcap(F.col(c).cast("string")) for c in ("used_text_layer", "has_akkadian")}
    return progress.select("pdf_name", F.col("page").cast("int").alias("page"), F.col("ms").cast("bigint").alias("ms"), *[v.alias(k) for k, v in shown.items()], F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))


def write_csv_file(rows: DataFrame, path: str, bom: bool, note: Callable[[int], None] | None = None) -> int:
    """One CSV file with CRLF line ends and minimal quotes, rows in their order. Rows stream through the driver partition by partition;
    use parquet for bulk. Returns the number of rows, and tells note every hundred and at the end."""
    import csv

    n = 0
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(rows.columns)
        for row in rows.toLocalIterator(prefetchPartitions=True):
            out.writerow(row)
            n += 1
            if note and n % 100 == 0:
                note(n)
    if note:
        note(n)
    return n


def write_page_text(pages: DataFrame, path: str, note: Callable[[int], None] | None = None) -> int:
    return write_csv_file(page_text_rows(pages.orderBy("pdf_name", "page")), path, True, note)


def write_progress(progress: DataFrame, path: str) -> int:
    return write_csv_file(progress_rows(progress), path, False)
