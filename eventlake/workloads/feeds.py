"""Raw log records derived by Spark from the given tables; every row of a table yields a record.

The click-stream feed, from ``events``:

* ``error`` rows stand for a broken producer. By the hour of day they arrive as text that is not
  JSON, as JSON without an event id, as a null value, or as blanks.
* ``purchase`` rows are sent twice, the copy at the next offset.
* every other row is one well-formed JSON record.

The log partition is chosen by the user, as a keyed producer does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.schema import EVENT_SCHEMA

LOG_PARTITIONS = 4
NOT_JSON = "sensor offline; retry in 30s"
NO_ID = '{"device":"kiosk-7","battery":41}'
BLANKS = "   "

CHANNEL_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("channel", T.StringType())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clickstream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table with its time stamp as an instant."""
    # Read as a zone-less value; the session zone is UTC (see queries.py).
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def originals(
    rows: DataFrame, channel: Column | None = None, untimed: Column | None = None
) -> DataFrame:
    """First delivery of every row. ``channel`` adds a field; ``untimed`` rows lose their time."""
    return rows.select(*_record(rows, F.lit(0), F.lit(0), channel, untimed))


def resends(
    rows: DataFrame, later_days: int = 0, channel: Column | None = None
) -> DataFrame:
    """Second delivery of the purchases, stamped ``later_days`` after the first."""
    purchases = rows.where(F.col("event_type") == "purchase")
    return purchases.select(*_record(purchases, F.lit(1), F.lit(later_days), channel, None))


def raw_clickstream(rows: DataFrame, **options) -> DataFrame:
    """The whole feed: first and second deliveries."""
    channel = options.get("channel")
    return originals(rows, **options).unionByName(resends(rows, channel=channel))


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of every document as a record; none of them is an event."""
    return table(spark, sf_dir, "documents").select(
        F.col("text").cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.col("doc_id").cast("long").alias("offset"),
    )


def _record(
    rows: DataFrame,
    delivery: Column,
    later_days: Column,
    channel: Column | None,
    untimed: Column | None,
) -> list[Column]:
    millis = F.unix_millis("ts") + later_days.cast("long") * F.lit(86_400_000)
    if untimed is not None:
        millis = F.when(~untimed, millis)
    fields = [
        F.concat(F.lit("e"), F.col("event_id")).alias("eventId"),
        F.concat(F.lit("u"), F.col("user_id")).alias("userId"),
        F.col("event_type").alias("eventType"),
        F.concat(F.lit("shelf="), F.get_json_object("props", "$.k")).alias("url"),
        F.concat(F.lit("campaign-"), F.col("user_id") % 9).alias("referrer"),
        F.col("value").alias("amount"),
        millis.alias("timestamp"),
    ]
    if channel is not None:
        fields.append(channel.alias("channel"))
    hour = F.hour("ts")
    broken = (
        F.when(hour < 6, F.lit(NOT_JSON))
        .when(hour < 12, F.lit(NO_ID))
        .when(hour < 18, F.lit(None).cast("string"))
        .otherwise(F.lit(BLANKS))
    )
    text = F.when(F.col("event_type") == "error", broken).otherwise(F.to_json(F.struct(*fields)))
    return [
        text.cast("binary").alias("value"),
        F.pmod(F.col("user_id"), F.lit(LOG_PARTITIONS)).cast("int").alias("partition"),
        (F.col("event_id") * 2 + delivery).cast("long").alias("offset"),
    ]
