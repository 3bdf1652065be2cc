"""Column contracts of the tables this package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _B, _L, _TS = T.StringType(), T.BooleanType(), T.LongType(), T.TimestampType()
MONEY = T.DecimalType(18, 2)
TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# --- fixed values: event contract (field names, enums, limits) -------------
TRANSACTION_FIELDS = [
    "event_id", "transaction_id", "user_id", "account_id", "card_id", "merchant_id",
    "device_id", "ip", "province", "city", "amount", "currency", "payment_method",
    "transaction_type", "transaction_status", "event_time", "process_time", "channel",
    "app_version", "is_black_device", "is_black_card", "risk_label",
]
USER_EVENT_FIELDS = [
    "event_id", "user_id", "device_id", "ip", "event_type", "event_time",
    "province", "city", "channel",
]
CURRENCIES = ["CNY"]
PAYMENT_METHODS = ["BALANCE", "BANK_CARD", "CREDIT_CARD", "DEBIT_CARD", "WALLET"]
TRANSACTION_TYPES = ["PAY", "REFUND", "TRANSFER", "WITHDRAW"]
TRANSACTION_STATUSES = ["SUCCESS", "FAILED", "CANCELLED", "PENDING"]
CHANNELS = ["APP", "H5", "MINI_PROGRAM", "POS", "API"]
USER_EVENT_TYPES = ["LOGIN", "LOGOUT", "BIND_CARD", "UNBIND_CARD", "CHANGE_DEVICE", "CHANGE_PASSWORD"]
EVENT_ID_MIN_LENGTH = 8
# ---------------------------------------------------------------------------

_TYPED = {"amount": MONEY, "is_black_device": _B, "is_black_card": _B}

#: the event as published (no derived columns)
TRANSACTION = _struct(*[(f, _TYPED.get(f, _S)) for f in TRANSACTION_FIELDS])

#: every field as text, for tolerant parsing before casting
TRANSACTION_TEXT = _struct(*[(f, _S) for f in TRANSACTION_FIELDS])

#: a parsed event: the contract plus its event-time instant and its place in arrival order
EVENT = T.StructType(TRANSACTION.fields + _struct(("event_ts", _TS), ("arrival_seq", _L)).fields)

USER_EVENT = _struct(*[(f, _S) for f in USER_EVENT_FIELDS])

ALERT = _struct(
    ("alert_id", _S), ("rule_id", _S), ("rule_name", _S), ("risk_level", _S), ("reason", _S),
    ("event_id", _S), ("transaction_id", _S), ("user_id", _S), ("account_id", _S), ("card_id", _S),
    ("merchant_id", _S), ("device_id", _S), ("amount", MONEY), ("event_time", _S),
    ("alert_time", _TS), ("window_start", _TS), ("window_end", _TS), ("evidence", TEXT_MAP),
)

#: alerts as published: times in epoch milliseconds
ALERT_JSON = _struct(*[(f.name, _L if f.dataType == _TS else f.dataType) for f in ALERT.fields])

METRIC = _struct(
    ("metric_id", _S), ("metric_name", _S), ("dimensions", TEXT_MAP), ("value", T.DoubleType()),
    ("count", _L), ("window_start", _TS), ("window_end", _TS), ("emit_time", _TS),
)

#: metrics as published
METRIC_JSON = _struct(*[(f.name, _L if f.dataType == _TS else f.dataType) for f in METRIC.fields])

DEAD_LETTER = _struct(("topic", _S), ("raw_event", _S), ("error_message", _S), ("created_at", _TS))

#: raw anti-money-laundering file; the time column is accepted under either of its two names
AML_ROW = _struct(
    ("record_key", _S), ("timestamp", _S), ("from_bank", _S), ("from_account", _S),
    ("from_country", _S), ("to_bank", _S), ("to_account", _S), ("to_country", _S),
    ("amount_received", _S), ("receiving_currency", _S), ("amount_paid", _S),
    ("payment_currency", _S), ("payment_format", _S), ("is_laundering", _S),
    ("predicted_alert", _S), ("model_score", _S), ("is_dashboard_sample", _S),
)
