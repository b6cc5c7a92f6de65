"""The Kafka stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.settings import KafkaSettings


def kafka_options(kafka: KafkaSettings) -> dict[str, str]:
    """Options of Spark's Kafka reader. ``maxOffsetsPerTrigger`` bounds every micro-batch."""
    return {
        "kafka.bootstrap.servers": kafka.bootstrap_servers,
        "subscribe": kafka.topic,
        "startingOffsets": kafka.starting_offsets,
        "maxOffsetsPerTrigger": str(kafka.max_offsets_per_trigger),
        "failOnDataLoss": str(kafka.fail_on_data_loss).lower(),
    }


def kafka_stream(spark: SparkSession, kafka: KafkaSettings) -> DataFrame:
    """The topic as a streaming frame; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(kafka)).load()
