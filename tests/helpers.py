"""Hand-written rows and plain-Python models the operators are checked against."""

from __future__ import annotations

import datetime as dt
import json

from statelake.schemas import LOG_SCHEMA


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def event(event_id, order_id, kind, when, ingested=None, status=None, **more) -> dict:
    return {
        "event_id": event_id,
        "order_id": order_id,
        "customer_id": f"c-{order_id}",
        "event_type": kind,
        "original_event_time": when[:19] if when else None,
        "event_time": when,
        "ingestion_time": ingested or when,
        "order_status": status or (kind or "").lower(),
        **more,
    }


def log_rows(spark, payloads, topic="order-events", partitions=2):
    """A log of the payloads (dicts, raw text or None) with offsets in order per partition."""
    offsets = [0] * partitions
    rows = []
    for i, payload in enumerate(payloads):
        order = payload.get("order_id") if isinstance(payload, dict) else None
        slot = sum(map(ord, order)) % partitions if order else i % partitions
        text = json.dumps(payload) if isinstance(payload, dict) else payload
        rows.append(
            (
                bytearray((order or "").encode()),
                None if text is None else bytearray(text.encode()),
                topic,
                slot,
                offsets[slot],
                at("2024-03-01T00:00:00"),
            )
        )
        offsets[slot] += 1
    return spark.createDataFrame(rows, LOG_SCHEMA)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
