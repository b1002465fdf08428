"""Page records as a stream: an optional extra for inputs that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.joins import snapshot_diff
from quire.sources.pages import PAGE, spans


def stream_pages(spark: SparkSession, folder: str, files: int = 100) -> DataFrame:
    """Page records of files as they come into the folder."""
    return spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files).json(folder)


def style_counts(pages: DataFrame) -> DataFrame:
    """Running counts of spans by style; complete or update mode."""
    return spans(pages).groupBy("f", "s", "c").agg(F.count("*").alias("n"))


def sessions(events: DataFrame, at: str, by: list[str], gap: str = "40 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of events with no gap longer than gap; events later than late are left out, state older than that goes."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), *by).agg(F.count("*").alias("n")).select(*by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def keep_snapshot(ids: DataFrame, folder: str, version: str, checkpoint: str):
    """Merges each batch of (id, place) into the snapshot in the folder; a batch run again gives the same snapshot."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(["id"]).select("id", "place")
        try:
            old = spark.read.parquet(f"{folder}/{number - 1}")
        except Exception as e:  # the first batch
            if number > 0:
                raise e
            old = spark.createDataFrame([], "id string, place string, since string, retired string")
        snapshot_diff(old.select("id", "place", "since", "retired"), new, "id", "place", version).write.mode("overwrite").parquet(f"{folder}/{number}")

    return ids.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
