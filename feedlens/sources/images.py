"""Photo listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.media import file_name


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the photo files below a folder; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.jpg")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files.select(file_name("path").alias("image"))


def image_files(messages: DataFrame) -> DataFrame:
    """Names of the photos a message table refers to."""
    return messages.where(F.col("media_path").isNotNull()).select(
        file_name("media_path").alias("image")
    )
