"""Page-level inputs derived from the plain tables: pages, engine readings, boxes, gold. Deterministic and whole: every document, every line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumtext.functions.text import strip_diacritics

PAGE_LINES = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with place: where a row stands in it, files by name, rows as they are in the file."""
    rows = table(spark, sf_dir, name).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index"))
    files = rows.select("file").distinct().withColumn("file_ord", F.row_number().over(Window.orderBy("file")).cast("long"))
    return rows.join(F.broadcast(files), "file").withColumn("place", F.shiftleft("file_ord", 40) + F.col("row_index")).drop("file", "file_ord", "row_index")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, line_no (0-based), line; blank lines keep their numbers but not their rows."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "source", "lang", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.where(F.btrim("line") != "")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pdf_name, page (from 1), text: PAGE_LINES lines of a document each."""
    lines = doc_lines(spark, sf_dir).withColumn("page", (F.col("line_no") / PAGE_LINES).cast("int") + 1)
    grouped = lines.groupBy("doc_id", "page").agg(F.first("source").alias("pdf_name"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"))
    return grouped.select("doc_id", "pdf_name", "page", F.array_join(F.transform("x", lambda r: r["line"]), "\n").alias("text"))


def boxed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with boxes: odd lines in a right column in every other document, one line in eleven without a box."""
    column = F.when(F.col("doc_id") % 2 == 0, F.col("line_no") % 2).otherwise(0)
    x0, y0 = 40.0 + 270.0 * column, 40.0 + 22.0 * (F.col("line_no") / 2).cast("int")
    box = F.when(F.col("line_no") % 11 != 10, F.struct(x0.alias("x0"), y0.alias("y0"), (x0 + 200.0).alias("x1"), (y0 + 18.0).alias("y1")))
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", F.col("line").alias("text"), box.alias("bbox"), F.lit(520.0).alias("page_width"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as short pages: page_id, text. Comparing them is long work on few bytes, so they are dealt out by page first."""
    t = table(spark, sf_dir, "conversations")
    pages = t.select((F.col("conv_id") * 1000 + F.col("turn")).alias("page_id"), F.coalesce("text", F.lit("")).alias("text"))
    return pages.repartition(4 * spark.sparkContext.defaultParallelism, "page_id")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four engines' readings of every turn: without marks, exact, with look-alikes, and without the last sentence on every third page."""
    t = turns(spark, sf_dir)
    cut = F.when(F.col("page_id") % 3 == 0, F.concat(F.col("text"), F.lit("\nx"))).otherwise(F.col("text"))
    engines = [("paddle", strip_diacritics(F.col("text")), 0.80), ("doctr", F.col("text"), 0.78), ("mmocr", F.translate("text", "nl", "u1"), 0.65), ("kraken", cut, 0.77)]
    rows = F.array(*[F.struct(F.lit(e).alias("engine"), F.lit(k).alias("engine_ord"), x.alias("text"), F.lit(c).alias("confidence")) for k, (e, x, c) in enumerate(engines)])
    angles = F.array(F.struct(F.lit(0).alias("angle"), F.lit(0).alias("angle_ord")), F.struct(F.lit(180).alias("angle"), F.lit(1).alias("angle_ord")))
    spread = t.select("page_id", F.explode(angles).alias("a"), "text").select("page_id", "a.angle", "a.angle_ord", F.inline(rows))
    upside = F.col("angle") == 180
    return spread.withColumns({"text": F.when(upside, F.reverse("text")).otherwise(F.col("text")), "confidence": F.when(upside, 0.05).otherwise(F.col("confidence")), "variant": F.lit("original"), "line_count": F.lit(None).cast("int")})
