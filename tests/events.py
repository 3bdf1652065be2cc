"""Small events for tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from decimal import Decimal

from vigilpay.schemas import EVENT

START = datetime(2026, 5, 10, 2, 0, tzinfo=timezone.utc)


def event(n: int, second: float = 0, **changes) -> dict:
    when = START + timedelta(seconds=second)
    row = dict(
        event_id=f"evt-{n:06d}", transaction_id=f"txn-{n:06d}", user_id="user-1", account_id="acct-1",
        card_id=f"card-{n}", merchant_id="merchant-1", device_id=f"device-{n}", ip="10.0.0.1",
        province="Shanghai", city="Shanghai", amount="10.00", currency="CNY", payment_method="WALLET",
        transaction_type="PAY", transaction_status="SUCCESS",
        event_time=when.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), process_time="2026-05-10T03:00:00Z",
        channel="APP", app_version="6.0.0", is_black_device=False, is_black_card=False,
        risk_label="NORMAL", event_ts=when, arrival_seq=n,
    )
    row.update(changes)
    return row


def frame(spark, rows: list[dict]):
    rows = [{**r, "amount": Decimal(str(r["amount"]))} for r in rows]
    return spark.createDataFrame([tuple(r[f] for f in EVENT.names) for r in rows], EVENT)


def as_json(row: dict, **changes) -> str:
    body = {k: v for k, v in row.items() if k not in ("event_ts", "arrival_seq")}
    body["amount"] = float(body["amount"])
    body.update(changes)
    return json.dumps(body)
