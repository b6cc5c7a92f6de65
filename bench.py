"""Headline timings on the given tables; prints one JSON line.

Set-up (not timed) writes the raw click-stream feed as Parquet files, as a log would hold it, and a
bulk feed made from ``lineitem``. Every timed step runs on whole feeds.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import (
    clickstream_events,
    dead_letters,
    exactly_once,
    parse_events,
    rows_per_date,
    top_event_types,
)
from eventlake.plans import compact, dead_letter_table, events_table, land_batch
from eventlake.plans.upkeep import partition_files
from eventlake.schema import DATE_COLUMN
from eventlake.session import build_session, scratch_path
from eventlake.settings import MergeSettings, Settings
from eventlake.sources import LakeTable, raw_file_stream
from eventlake.streaming import ClickstreamIngest
from eventlake.workloads import feeds

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def main() -> None:
    SparkSession.builder.config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    ).config("spark.driver.memory", "8g").master(f"local[{CPUS}]").getOrCreate()
    spark = build_session("bench", shuffle_partitions=CPUS, master=f"local[{CPUS}]")
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, "bench")
    bench = Bench(spark, base)
    bench.set_up()
    bench.run()
    spark.stop()


class Bench:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self.seconds: dict[str, float] = {}
        self.facts: dict[str, float] = {}

    def set_up(self) -> None:
        rows = feeds.clickstream_rows(self.spark, SF_DIR)
        for wave in (feeds.originals(rows), feeds.resends(rows)):
            wave.repartitionByRange(CPUS, "offset").write.mode("append").parquet(f"{self.base}/raw")
        bulk_feed(self.spark).repartition(CPUS).write.parquet(f"{self.base}/bulk")
        # Warm-up: one landing, so that the first timing is not that of class loading.
        dead = dead_letter_table(self.spark, f"{self.base}/warm/dead")
        land_batch(self.raw(), self.table("warm"), dead)

    def raw(self, name: str = "raw") -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}")

    def table(self, name: str) -> LakeTable:
        return events_table(self.spark, f"{self.base}/{name}/events")

    def timed(self, name: str, action):
        start = time.perf_counter()
        result = action()
        self.seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def run(self) -> None:
        records, bulk = self.raw().count(), self.raw("bulk").count()
        self.operators()
        events = self.landing()
        self.reports(events)
        self.upkeep()
        self.stream()
        s = self.seconds
        self.facts |= {
            "raw_records": records,
            "bulk_records": bulk,
            "first_ingest_rows_per_sec": round(records / s["first_ingest"]),
            "full_replay_rows_per_sec": round(records / s["full_replay"]),
            "stream_rows_per_sec": round(records / s["stream_ingest"]),
            "bulk_unique_rows_per_sec": round(bulk / s["bulk_unique"]),
        }
        print(
            json.dumps(
                {
                    "metric": "click-stream landing, total of headline steps",
                    "value": round(sum(s.values()), 3),
                    "unit": "sec",
                    "queries": s,
                    "sf": Path(SF_DIR).name.removeprefix("sf"),
                    "cpus": CPUS,
                    "facts": self.facts,
                }
            )
        )

    def operators(self) -> None:
        for name, frame in {
            "parse_events": parse_events(self.raw()),
            "dead_letters": dead_letters(self.raw()),
            "clickstream": clickstream_events(self.raw()),
            "bulk_parse": parse_events(self.raw("bulk")),
            "bulk_unique": clickstream_events(self.raw("bulk")),
        }.items():
            self.timed(name, frame.write.format("noop").mode("overwrite").save)

    def landing(self) -> LakeTable:
        events = self.table("main")
        self.timed("first_ingest", lambda: land_batch(self.raw(), events))
        self.timed("full_replay", lambda: land_batch(self.raw(), events))
        shuffled = MergeSettings(broadcast_bytes=0)
        self.timed("full_replay_shuffled", lambda: land_batch(self.raw(), events, merge=shuffled))

        both, dead = self.table("both"), dead_letter_table(self.spark, f"{self.base}/both/dead")
        self.timed("first_ingest_with_dead_letters", lambda: land_batch(self.raw(), both, dead))
        self.timed("full_replay_with_dead_letters", lambda: land_batch(self.raw(), both, dead))

        # The newest day again: matched in its own window, then against the whole table.
        last = events.scan().agg(F.max(DATE_COLUMN)).first()[0]
        day = F.to_date((F.get_json_object(F.col("value").cast("string"), "$.timestamp") / 1000)
                        .cast("timestamp")) == F.lit(last)
        day_raw = self.raw().where(day).persist()
        self.facts["last_day_records"] = day_raw.count()
        self.timed("merge_last_day_window", lambda: land_batch(day_raw, events))
        everywhere = MergeSettings(scope="table")
        self.timed("merge_last_day_table", lambda: land_batch(day_raw, events, merge=everywhere))
        day_raw.unpersist()
        window = events.scan_window(str(last), str(last), with_null=False)
        self.facts["files_in_window"] = len(window.inputFiles())
        self.facts["files_in_table"] = len(events.scan().inputFiles())
        return events

    def reports(self, events: LakeTable) -> None:
        self.timed("verify_exactly_once", lambda: exactly_once(events.scan()).collect())
        self.timed("rows_per_date", lambda: rows_per_date(events.scan()).collect())
        self.timed("top_event_types", lambda: top_event_types(events.scan()).collect())

    def upkeep(self) -> None:
        events = self.table("parts")
        for partition in range(feeds.LOG_PARTITIONS):
            land_batch(self.raw().where(F.col("partition") == partition), events)
        one_id = events.scan().agg(F.min("eventId")).first()[0]

        def look_up():
            return events.scan().where(F.col("eventId") == one_id).collect()

        look_up()
        self.timed("lookup_before_compact", look_up)
        self.facts["files_before_compact"] = self.files(events)
        self.timed("compact", lambda: compact(events, "eventId"))
        self.facts["files_after_compact"] = self.files(events)
        look_up()
        self.timed("lookup_after_compact", look_up)

    def files(self, table: LakeTable) -> int:
        return partition_files(self.spark, table).agg(F.sum("files")).first()[0]

    def stream(self) -> None:
        settings = Settings.from_mapping(
            {
                "storage": {
                    "base_path": f"{self.base}/stream",
                    "checkpoint_path": f"{self.base}/stream/checkpoints",
                },
                "stream": {"once": True},
            }
        )
        source = raw_file_stream(self.spark, f"{self.base}/raw", max_files_per_trigger=CPUS)
        self.timed("stream_ingest", ClickstreamIngest(self.spark, settings, source).run)


def bulk_feed(spark: SparkSession) -> DataFrame:
    """Every ``lineitem`` row as an event; returned items ("R") are sent a second time."""
    items = feeds.table(spark, SF_DIR, "lineitem")
    number = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    value = F.to_json(
        F.struct(
            F.concat(F.lit("o"), F.col("l_orderkey"), F.lit("-"), "l_linenumber").alias("eventId"),
            F.concat(F.lit("s"), F.col("l_suppkey")).alias("userId"),
            F.col("l_returnflag").alias("eventType"),
            F.concat(F.lit("/p/"), F.col("l_partkey")).alias("url"),
            F.col("l_extendedprice").alias("amount"),
            F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        )
    ).cast("binary")
    first = items.select(
        value.alias("value"),
        F.pmod("l_suppkey", F.lit(CPUS)).cast("int").alias("partition"),
        (number * 2).cast("long").alias("offset"),
        (F.col("l_returnflag") == "R").alias("again"),
    )
    second = first.where("again").withColumn("offset", F.col("offset") + 1)
    return first.unionByName(second).drop("again")


if __name__ == "__main__":
    main()
