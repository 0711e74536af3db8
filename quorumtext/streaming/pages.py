"""Pages as they land: a file stream of page rows, flagged line by line, written as page text and progress in each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quorumtext.operators.detect import DetectionProfile, detect

LANDED = "pdf_name string, page int, text string, used_text_layer boolean, ms bigint, landed_at timestamp"


def landed_pages(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def write_batch(output: str, profile: DetectionProfile = DetectionProfile()):
    """A batch writer: page text and progress under output, each batch in its own folder, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        flagged = detect(batch, ["pdf_name", "page"], profile)
        flagged.select("pdf_name", "page", F.col("text").alias("page_text"), "has_akkadian").write.mode("overwrite").parquet(f"{output}/page_text/batch={batch_id}")
        flagged.select("pdf_name", "page", "ms", "used_text_layer", "has_akkadian", F.col("landed_at").alias("timestamp")).write.mode("overwrite").parquet(f"{output}/progress/batch={batch_id}")
        batch.unpersist()

    return write


def run(spark: SparkSession, folder: str, output: str, checkpoint: str, profile: DetectionProfile = DetectionProfile(), once: bool = True) -> StreamingQuery:
    writer = landed_pages(spark, folder).writeStream.foreachBatch(write_batch(output, profile)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def throughput(progress: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Pages and milliseconds by window of landing time; rows later than the watermark are left out."""
    return progress.withWatermark("landed_at", late).groupBy(F.window("landed_at", window)).agg(F.count(F.lit(1)).alias("pages"), F.sum("ms").alias("ms"))
