"""Command line: ``spark-submit`` or ``python -m eventlake ingest | verify | maintain``."""

from __future__ import annotations

import argparse
import logging
import signal
import sys

from pyspark.sql import SparkSession

from eventlake.operators.verify import (
    exactly_once_of,
    rows_per_date_of,
    top_event_types_of,
    verification,
)
from eventlake.plans import events_table, maintain, unfinished
from eventlake.session import build_session, input_bytes, sized_shuffles
from eventlake.settings import Settings
from eventlake.sources import LakeTable
from eventlake.streaming import ClickstreamIngest


UNSETTLED = 3  # exit code of a verification that cannot see the whole table


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="eventlake", description=__doc__)
    parser.add_argument("job", choices=["ingest", "verify", "maintain"])
    job = parser.parse_args(argv).job
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)

    settings = Settings.from_env()
    spark = build_session(
        f"eventlake-{job}", settings.storage, settings.stream.shuffle_partitions
    )
    try:
        if job == "ingest":
            # Turn a termination signal into an ordinary exit, so the query is stopped first.
            signal.signal(signal.SIGTERM, lambda *_: sys.exit(0))
            ClickstreamIngest(spark, settings).run()
            return 0
        if job == "maintain":
            table = events_table(spark, settings.storage.table_path)
            print(f"compacted {maintain(table, settings.maintenance)}")
            return 0
        table = LakeTable(spark, settings.storage.table_path)
        if runs := unfinished(table):
            print(f"NOT VERIFIED: rows may be out of sight until compaction {runs[0]} is settled")
            return UNSETTLED
        return _report(spark, table)
    finally:
        spark.stop()


def _report(spark: SparkSession, table: LakeTable) -> int:
    """Print what one pass over the table says; 1 if an id is stored twice."""
    events = table.scan()
    verified = verification(events).persist()
    try:
        with sized_shuffles(spark, input_bytes(events)):
            verified.count()
        result = exactly_once_of(verified).first()
        print(f"rows with an id: {result['total']}, distinct ids: {result['distinct']}")
        for report in (rows_per_date_of(verified), top_event_types_of(verified)):
            for key, rows in report.toLocalIterator():
                print(f"{key!s:<16} {rows:>12}")
    finally:
        verified.unpersist()  # a later pass over the same files must not see this one
    print(f"rows stored more than once: {result['total'] - result['distinct']}")
    print("PASS" if result["pass"] else "FAIL")
    return 0 if result["pass"] else 1


if __name__ == "__main__":
    sys.exit(main())
