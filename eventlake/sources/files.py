"""A replayable stream source: raw records in Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.schema import RAW_SCHEMA


def raw_file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream the raw records under ``path``, oldest file first.

    ``max_files_per_trigger`` bounds a micro-batch as the offset limit does for Kafka.
    """
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
