"""Scans of the engine's files: gold tables, manifests, PDFs, evaluation runs, page output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumtext import schema


def gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """A gold table with whatever columns it has, all strings, quoted line ends included; the byte order mark is no part of a name."""
    df = spark.read.csv(path, header=True, multiLine=True, encoding="UTF-8", quote='"', escape='"')
    if not df.columns:
        raise ValueError(f"{path} has no header")
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(pdf_path, page), with or without a header line; lines that begin with # are comments; duplicates stay."""
    raw = spark.read.csv(path, sep="\t", schema="pdf_path string, page_no string", comment="#", ignoreTrailingWhiteSpace=True)
    return raw.where(F.col("page_no").rlike(r"^\s*\d+\s*$")).select("pdf_path", F.trim("page_no").cast("int").alias("page"))


def rich_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest that carries gold text in quotes over several lines."""
    return spark.read.csv(path, sep="\t", header=True, multiLine=True, quote='"', escape='"', schema=schema.RICH_MANIFEST)


def pdf_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(pdf_path) of the PDFs in a folder, extension in any case. Contents aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF,Pdf}").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return found.select(F.col("path").alias("pdf_path"), "length")


def pdf_contents(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF,Pdf}").option("recursiveFileLookup", str(recursive).lower()).load(folder).select(F.col("path").alias("pdf_path"), "content")


def evaluation(spark: SparkSession, path: str, engine: str = "single") -> DataFrame:
    """An evaluation run in long form; runs without an engine column get one."""
    columns = spark.read.csv(path, header=True).columns
    fields = [f for f in schema.EVALUATION.split(", ") if f.split()[0] in columns]
    df = spark.read.csv(path, header=True, quote='"', escape='"', schema=", ".join(fields), enforceSchema=False)
    return df if "engine" in df.columns else df.withColumn("engine", F.lit(engine))


def extraction_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, quote='"', escape='"', schema=schema.EXTRACTION)


def page_output(spark: SparkSession, path: str) -> DataFrame:
    """Page output read back: escaped line ends become line ends."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", schema="pdf_name string, page int, page_text string, has_akkadian string", enforceSchema=True)
    return raw.withColumns({"page_text": F.replace("page_text", F.lit("\\n"), F.lit("\n")), "has_akkadian": F.lower("has_akkadian") == "true"})


def progress(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, header=True, schema="pdf_name string, page int, ms bigint, used_text_layer string, has_akkadian string, timestamp string")
    flags = {c: F.lower(c) == "true" for c in ("used_text_layer", "has_akkadian")}
    return raw.withColumns(flags | {"timestamp": F.col("timestamp").cast("timestamp_ntz")})
