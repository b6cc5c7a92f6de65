"""Sample events that the tests have in common."""

from __future__ import annotations

import json

# Three instants on three consecutive UTC dates: 2024-07-03, -04 and -05.
DAY1, DAY2, DAY3 = 1_720_000_000_000, 1_720_100_000_000, 1_720_200_000_000


def event(event_id, timestamp=DAY1, **fields):
    record = {"eventId": event_id, "userId": "u1", "eventType": "click", "timestamp": timestamp}
    return json.dumps(record | fields)


def ids(frame):
    return sorted(r["eventId"] for r in frame.select("eventId").collect())
