"""The same results as plain SQL over the given tables, for the side-by-side check."""

from __future__ import annotations

MILLIS = "epoch_us(ts) // 1000"

# Deliveries of a row: 0 for all, 1 again for purchases.
FEED = f"""
feed AS (
    SELECT e.*, {MILLIS} AS millis, d.delivery,
           CAST(user_id % 4 AS INTEGER) AS part, event_id * 2 + d.delivery AS pos
    FROM events e
    JOIN (VALUES (0), (1)) AS d(delivery)
      ON d.delivery = 0 OR e.event_type = 'purchase'
)"""

FIELDS = """
    part AS "kafkaPartition", pos AS "kafkaOffset", 'e' || event_id AS "eventId",
    'u' || user_id AS "userId", event_type AS "eventType",
    'shelf=' || json_extract_string(props, '$.k') AS "url",
    'campaign-' || (user_id % 9) AS "referrer", value AS "amount"
"""

TIMES = """
    millis AS "timestamp", make_timestamp(millis * 1000) AS "eventTime",
    CAST(make_timestamp(millis * 1000) AS DATE) AS "eventDate"
"""

PARSED = f"""
WITH {FEED} SELECT {FIELDS}, millis AS "timestamp" FROM feed WHERE event_type <> 'error'"""

UNIQUE = f"""
WITH {FEED} SELECT {FIELDS}, {TIMES} FROM feed WHERE event_type <> 'error' AND delivery = 0"""

REJECTED = """
SELECT CAST(user_id % 4 AS INTEGER) AS "kafkaPartition", event_id * 2 AS "kafkaOffset",
       CASE WHEN hour(ts) < 6 THEN 'sensor offline; retry in 30s'
            WHEN hour(ts) < 12 THEN '{"device":"kiosk-7","battery":41}'
            WHEN hour(ts) < 18 THEN NULL
            ELSE '   ' END AS "rawValue",
       CASE WHEN hour(ts) < 12 THEN 'unparseable or missing eventId'
            WHEN hour(ts) < 18 THEN 'null value'
            ELSE 'empty value' END AS "errorReason"
FROM events WHERE event_type = 'error'"""

REJECTED_DOCUMENTS = """
SELECT CAST(0 AS INTEGER) AS "kafkaPartition", doc_id AS "kafkaOffset", text AS "rawValue",
       CASE WHEN text IS NULL THEN 'null value'
            WHEN length(trim(text, ' ')) = 0 THEN 'empty value'
            ELSE 'unparseable or missing eventId' END AS "errorReason"
FROM documents"""

ORACLES: dict[str, str] = {
    "raw_records": f"""
        WITH {FEED}
        SELECT part AS "partition", pos AS "offset",
               event_type = 'error' AND hour(ts) >= 12 AND hour(ts) < 18 AS "isNull",
               event_type = 'error' AND hour(ts) >= 18 AS "isBlank"
        FROM feed""",
    "parse_valid_events": PARSED,
    "enrich_valid_events": f"""
        WITH {FEED} SELECT {FIELDS}, {TIMES} FROM feed WHERE event_type <> 'error'""",
    "dedupe_in_batch": f"""
        WITH {FEED} SELECT {FIELDS}, millis AS "timestamp"
        FROM feed WHERE event_type <> 'error' AND delivery = 0""",
    "rejected_records": REJECTED,
    "dlq_merge": REJECTED,
    "stream_dlq": REJECTED,
    "rejected_documents": REJECTED_DOCUMENTS,
    "dlq_documents": REJECTED_DOCUMENTS,
    "merge_window": """
        SELECT CAST(min(ts) AS DATE) AS "minDate", CAST(max(ts) AS DATE) AS "maxDate"
        FROM events WHERE event_type <> 'error'""",
    "merge_counts": """
        SELECT i AS "landing", CASE WHEN i = 1 THEN n ELSE 0 END AS "rowsInserted"
        FROM (SELECT count(*) AS n FROM events WHERE event_type <> 'error'), range(1, 4) r (i)""",
    "compact_report": """
        SELECT CAST(ts AS DATE) AS "eventDate", count(*) AS "rows", TRUE AS "merged"
        FROM events WHERE event_type <> 'error' GROUP BY 1""",
    "vacuum_report": """
        SELECT count(*) AS "rows", CAST(1 AS BIGINT) AS "runsBefore", CAST(0 AS BIGINT) AS "runsAfter"
        FROM events WHERE event_type <> 'error'""",
    "merge_cross_window": f"""
        WITH {FEED}, moved AS (
            SELECT * REPLACE (millis + CAST(delivery AS BIGINT) * 400 * 86400000 AS millis) FROM feed)
        SELECT {FIELDS}, {TIMES} FROM moved WHERE event_type <> 'error'""",
    "merge_null_dates": f"""
        WITH {FEED}, untimed AS (
            SELECT * REPLACE (CASE WHEN event_type <> 'signup' THEN millis END AS millis)
            FROM feed)
        SELECT {FIELDS}, make_timestamp(millis * 1000) AS "eventTime",
               CAST(make_timestamp(millis * 1000) AS DATE) AS "eventDate"
        FROM untimed WHERE event_type <> 'error' AND delivery = 0""",
    "schema_evolution": f"""
        WITH {FEED}, cut AS (SELECT min(ts) + (max(ts) - min(ts)) / 3 AS early FROM events)
        SELECT {FIELDS}, {TIMES},
               CASE WHEN ts >= early THEN 'web-' || event_type END AS "channel"
        FROM feed, cut WHERE event_type <> 'error' AND delivery = 0""",
    "verify_exactly_once": """
        SELECT count(*) AS "total", count(DISTINCT event_id) AS "distinct", TRUE AS "pass"
        FROM events WHERE event_type <> 'error'""",
    "verify_repeated_rows": f"""
        WITH {FEED}
        SELECT count(*) AS "total", count(DISTINCT event_id) AS "distinct",
               count(*) = count(DISTINCT event_id) AS "pass"
        FROM feed WHERE event_type <> 'error'""",
    "rows_by_date": """
        SELECT CAST(ts AS DATE) AS "eventDate", count(*) AS "rows"
        FROM events WHERE event_type <> 'error' GROUP BY 1 ORDER BY 1""",
    "frequent_event_types": """
        SELECT event_type AS "eventType", count(*) AS "rows"
        FROM events WHERE event_type <> 'error' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "stored_ids": """
        SELECT DISTINCT 'e' || event_id AS "eventId" FROM events WHERE event_type <> 'error'""",
    "batch_audit": f"""
        WITH {FEED}
        SELECT count(*) AS "rowsRead",
               count(*) FILTER (WHERE event_type <> 'error') AS "rowsValid",
               count(*) FILTER (WHERE event_type = 'error') AS "rowsDead",
               count(DISTINCT event_id) FILTER (WHERE event_type <> 'error') AS "rowsInserted"
        FROM feed""",
    # Landing is idempotent, so however the feed is cut and repeated the table is the same.
    **dict.fromkeys(
        [
            "clickstream",
            "merge_overlap",
            "merge_replay",
            "merge_shuffled",
            "merge_table_scope",
            "table_scan",
            "compact_table",
            "vacuum_table",
            "stream_ingest",
            "stream_replay",
        ],
        UNIQUE,
    ),
    # The same, and the step in question is seen to have been taken.
    "merge_pruned": f'SELECT *, TRUE AS "pruned" FROM ({UNIQUE})',
    "maintain_then_replay": f'SELECT *, TRUE AS "merged" FROM ({UNIQUE})',
    "stream_maintained": f'SELECT *, TRUE AS "merged" FROM ({UNIQUE})',
    "verify_in_one_pass": """
        WITH valid AS (SELECT * FROM events WHERE event_type <> 'error')
        SELECT 'ids' AS "report", CAST(NULL AS VARCHAR) AS "key", count(*) AS "rows",
               count(DISTINCT event_id) AS "distinct" FROM valid
        UNION ALL
        SELECT 'dates', CAST(CAST(ts AS DATE) AS VARCHAR), count(*), 1 FROM valid GROUP BY 2
        UNION ALL
        SELECT 'types', event_type, count(*), 1 FROM valid GROUP BY 2""",
}
