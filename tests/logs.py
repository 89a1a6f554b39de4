"""Hand-written session records."""

from __future__ import annotations

import datetime as dt

from cartwheel.schemas import ACTION, LANDED_LOG


def action(kind=None, at=0, **fields):
    values = {"type": kind, "time_offset": at, **fields}
    return tuple(values.get(f.name) for f in ACTION.fields)


def session(name, user=1, start="2024-01-01T10:00:00Z", actions=(), day=None, **fields):
    listed = None if actions is None else list(actions)
    bought = any(a[0] == "purchase" for a in listed or [])
    values = {
        "event_id": f"e-{name}",
        "timestamp": start,
        "user_id": user,
        "user_segment": "vip",
        "session_id": name,
        "device": ("mobile", "android", "chrome", "1"),
        "location": ("Hanoi", "VN", (21.0, 105.8)),
        "actions": listed,
        "session_metrics": (
            fields.pop("duration", 60), fields.pop("pages", 1), len(listed or []), bought,
            fields.pop("revenue", 10.1 if bought else 0.0),
        ),
        "properties": ("A", "vi", "VND", True),
        "ingest_date": day or dt.date.fromisoformat(start[:10]),
        **fields,
    }
    return tuple(values.get(f.name) for f in LANDED_LOG.fields)


def frame(spark, *sessions):
    return spark.createDataFrame(list(sessions), LANDED_LOG)
