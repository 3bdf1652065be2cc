"""SQL for a single-node engine that gives the same rows as each query of the catalog.

Written independently of the operators: plain window functions over whole
tables, sliding windows by generating every window of a row.
"""

from __future__ import annotations

from vigilpay import config
from vigilpay.schemas import TRANSACTION_FIELDS

# --- fixed values, written out so that a slip in the operators shows ---------------------
RULE_IDS = ["R001", "R002", "R003", "R004", "R005", "R006", "R007", "R008"]
COUNTRY_LOCATION = {
    "US": ("California", "San Francisco"),
    "CN": ("Shanghai", "Shanghai"),
    "SG": ("Singapore", "Singapore"),
    "UK": ("England", "London"),
    "DE": ("Hessen", "Frankfurt"),
    "FR": ("Ile-de-France", "Paris"),
    "JP": ("Tokyo", "Tokyo"),
    "KR": ("Seoul", "Seoul"),
    "AU": ("New South Wales", "Sydney"),
    "CA": ("Ontario", "Toronto"),
}
CHANNEL_ORDER = ["APP", "H5", "API", "POS", "MINI_PROGRAM"]
AML_COUNTRIES = ["US", "CN", "SG", "UK", "DE", "FR", "JP", "KR", "AU", "CA", "BR", ""]
# -----------------------------------------------------------------------------------------

ORACLE: dict[str, str] = {}


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _uuid(expr: str) -> str:
    h = f"md5({expr})"
    return (
        f"(substr({h},1,8)||'-'||substr({h},9,4)||'-3'||substr({h},14,3)||'-'"
        f"||translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab')"
        f"||substr({h},18,3)||'-'||substr({h},21,12))"
    )


def _iso(us: str) -> str:
    return (
        f"(CASE WHEN ({us}) % 1000000 = 0 THEN strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%SZ') "
        f"ELSE strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S.%fZ') END)"
    )


def _fixed2(total: str, n: str) -> str:
    """``total / n`` with two decimals, half up, in integers."""
    cents = f"((2 * CAST({total} * 100 AS HUGEINT) + {n}) // (2 * {n}))"
    return f"({cents} // 100)::VARCHAR || '.' || lpad(({cents} % 100)::VARCHAR, 2, '0')"


_SRC = f"""
src AS (
  SELECT event_id AS no, user_id AS u, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 2880 AS us
  FROM events),
placed AS (
  SELECT *, 0 AS copy, CASE WHEN no % 97 = 0 THEN (no + 1000) * 4 ELSE no * 4 + 2 END AS arrival_seq FROM src
  UNION ALL
  SELECT *, 1 AS copy, (no + 3) * 4 + 1 AS arrival_seq FROM src WHERE no % 11 = 0),
arr AS (
  SELECT no, us, copy, 'evt-'||no AS event_id, 'txn-'||no AS transaction_id, 'user-'||u AS user_id,
    'acct-'||u AS account_id, 'card-'||(k % 37) AS card_id, 'merchant-'||k AS merchant_id,
    'device-'||k AS device_id, '10.0.0.'||k AS ip,
    'province-'||(u % 5) AS province,
    'city-'||(u % 7) AS city,
    CAST(value * 100 AS DECIMAL(18,2)) AS amount, 'CNY' AS currency,
    ['BALANCE','BANK_CARD','CREDIT_CARD','DEBIT_CARD','WALLET'][no % 5 + 1] AS payment_method,
    ['PAY','REFUND','TRANSFER','WITHDRAW'][no % 4 + 1] AS transaction_type,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS transaction_status,
    {_iso('us')} AS event_time, {_iso('us + 250000 + copy * 1000000')} AS process_time,
    us + 250000 + copy * 1000000 AS process_us,
    ['APP','H5','MINI_PROGRAM','POS','API'][no % 5 + 1] AS channel, '6.0.0' AS app_version,
    k % 25 = 0 AS is_black_device, false AS is_black_card,
    CASE WHEN k % 25 = 0 THEN 'BLACK_DEVICE'
         WHEN CAST(value * 100 AS DECIMAL(18,2)) > 20000 THEN 'LARGE_AMOUNT' ELSE 'NORMAL' END AS risk_label,
    arrival_seq
  FROM placed)"""

_PREP = _SRC + """,
marked AS (
  SELECT *, max(us) OVER (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60000000 AS wm,
         row_number() OVER (PARTITION BY event_id ORDER BY arrival_seq) AS nth
  FROM arr),
ded AS (SELECT *, coalesce(us < wm, false) AS is_late FROM marked WHERE nth = 1),
ont AS (SELECT *, us // 60000000 AS m FROM ded WHERE NOT is_late),
paid AS (SELECT * FROM ont WHERE transaction_status = 'SUCCESS')"""


def _sql(body: str, *ctes: str, base: str = _PREP) -> str:
    return "WITH " + ",".join([base.strip(), *ctes]) + "\n" + body


_ALERT_COLUMNS = (
    "alert_id rule_id rule_name risk_level reason event_id transaction_id user_id account_id card_id "
    "merchant_id device_id amount event_time alert_time window_start window_end evidence"
).split()


def _alert(rule: config.Rule, source: str, given: dict[str, str], proof: dict[str, str]) -> str:
    evidence = " || ',' || ".join(f"""'"{k}":"' || {v} || '"'""" for k, v in proof.items())
    cols = {
        "rule_id": f"'{rule.rule_id}'", "rule_name": f"'{rule.name}'",
        "risk_level": f"'{rule.level}'", "reason": f"'{rule.reason}'",
        "evidence": f"'{{' || {evidence} || '}}'", **given,
    }
    kinds = {"amount": "DOUBLE", "alert_time": "BIGINT", "window_start": "BIGINT", "window_end": "BIGINT"}
    picked = ", ".join(
        f"CAST({cols.get(c, 'NULL')} AS {kinds.get(c, 'VARCHAR')}) AS {c}" for c in _ALERT_COLUMNS
    )
    return f"SELECT {picked} FROM {source}"


def _window_alert(rule, source, key, minutes, proof) -> str:
    start, end = "w * 60000", f"(w + {minutes}) * 60000"
    return _alert(rule, source, {
        "alert_id": _uuid(f"concat_ws('|','{rule.rule_id}','{key}',{key},({start})::VARCHAR,({end})::VARCHAR)"),
        key: key, "alert_time": f"{end} - 1", "window_start": start, "window_end": end,
    }, proof)


def _event_alert(rule, source, proof) -> str:
    same = ["event_id", "transaction_id", "user_id", "account_id", "card_id", "merchant_id", "device_id",
            "amount", "event_time"]
    return _alert(rule, source, {
        **{c: c for c in same}, "alert_id": _uuid(f"concat_ws('|','{rule.rule_id}',event_id)"),
        "alert_time": "us // 1000",
    }, proof)


def _windows(minutes: int) -> str:
    return f"unnest(range(m - {minutes - 1}, m + 1))"


def _users_cte(name: str, key: str, threshold: int) -> str:
    return f"""
{name}_u AS (SELECT {key}, w, user_id, min(arrival_seq) AS s
             FROM (SELECT {key}, user_id, arrival_seq, {_windows(10)} AS w FROM ont) GROUP BY 1, 2, 3),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY {key}, w ORDER BY s) AS r FROM {name}_u),
{name} AS (SELECT {key}, w, count(*) AS n, string_agg(user_id, ',' ORDER BY s) FILTER (WHERE r <= 8) AS users
           FROM {name}_r GROUP BY 1, 2 HAVING count(*) > {threshold})"""


_RULE_CTES = {
    "R001": """
f AS (SELECT user_id, m AS w, count(*) AS n FROM ont GROUP BY 1, 2)""",
    "R002": f"""
a AS (SELECT user_id, w, sum(amount) AS t FROM (SELECT user_id, amount, {_windows(5)} AS w FROM paid) GROUP BY 1, 2)""",
    "R003": _users_cte("dev", "device_id", 5),
    "R004": _users_cte("crd", "card_id", 3),
    "R005": """
isl AS (SELECT *, sum((transaction_status <> 'FAILED')::INT) OVER (PARTITION BY user_id ORDER BY arrival_seq) AS g FROM ont),
runs AS (SELECT *, sum((transaction_status = 'FAILED')::INT) OVER (PARTITION BY user_id, g ORDER BY arrival_seq) AS n FROM isl)""",
    "R006": "",
    "R007": """
hist AS (SELECT *, count(*) OVER prev AS n, sum(amount) OVER prev AS t FROM paid
         WINDOW prev AS (PARTITION BY user_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    "R008": f"""
mw AS (SELECT merchant_id, w, sum(amount) AS amount FROM (SELECT merchant_id, amount, {_windows(5)} AS w FROM paid) GROUP BY 1, 2),
mh AS (SELECT *, count(*) OVER prev AS n, sum(amount) OVER prev AS t FROM mw
       WINDOW prev AS (PARTITION BY merchant_id ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
}

_RULE_BODY = {
    "R001": _window_alert(config.R001, "f WHERE n > 10", "user_id", 1, {
        "user_id": "user_id", "transaction_count": "n", "threshold": "'10'",
        "window": "'1 minute tumbling event-time window'"}),
    "R002": _window_alert(config.R002, "a WHERE t > 20000", "user_id", 5, {
        "user_id": "user_id", "total_amount": "CAST(t AS DECIMAL(30,2))::VARCHAR", "threshold": "'20000.00'",
        "window": "'5 minute sliding event-time window'"}),
    "R003": _window_alert(config.R003, "dev", "device_id", 10, {
        "device_id": "device_id", "distinct_user_count": "n", "threshold": "'5'", "sample_user_ids": "users",
        "window": "'10 minute sliding event-time window'"}),
    "R004": _window_alert(config.R004, "crd", "card_id", 10, {
        "card_id": "card_id", "distinct_user_count": "n", "threshold": "'3'", "sample_user_ids": "users",
        "window": "'10 minute sliding event-time window'"}),
    "R005": _event_alert(config.R005, "runs WHERE transaction_status = 'FAILED' AND n >= 5", {
        "user_id": "user_id", "consecutive_failed_count": "CAST(n AS BIGINT)", "threshold": "'5'"}),
    "R006": _event_alert(config.R006, "ont WHERE is_black_device", {
        "device_id": "device_id", "is_black_device": "'true'", "source": "'event_flag'"}),
    "R007": _event_alert(config.R007, "hist WHERE n >= 5 AND t > 0 AND amount * n > 5 * t", {
        "user_id": "user_id", "current_amount": "CAST(amount AS DECIMAL(30,2))::VARCHAR",
        "historical_avg_amount": _fixed2("t", "n"), "history_count": "n", "multiplier": "'5.0'"}),
    "R008": _window_alert(config.R008, "mh WHERE n >= 3 AND t > 0 AND amount * n > 3 * t", "merchant_id", 5, {
        "merchant_id": "merchant_id", "current_window_amount": "CAST(amount AS DECIMAL(30,2))::VARCHAR",
        "historical_avg_window_amount": _fixed2("t", "n"), "history_window_count": "n", "multiplier": "'3.0'"}),
}
_CTES = [c for c in _RULE_CTES.values() if c]
_ALL_ALERTS = "\nUNION ALL\n".join(_RULE_BODY[r] for r in RULE_IDS)
_ALERTS = [*_CTES, f"\nalerts AS ({_ALL_ALERTS})"]

for _name, _id in {
    "r001_user_frequency": "R001", "r002_user_amount": "R002", "r003_device_users": "R003",
    "r004_card_users": "R004", "r005_consecutive_failure": "R005", "r006_black_device": "R006",
    "r007_user_amount_spike": "R007", "r008_merchant_spike": "R008",
}.items():
    ORACLE[_name] = _sql(_RULE_BODY[_id], *[c for c in [_RULE_CTES[_id]] if c])
ORACLE["risk_alerts"] = _sql("SELECT * FROM alerts", *_ALERTS)
_STORED = [*_ALERTS, "\nal AS (SELECT * FROM alerts)"]

ORACLE["merchant_window_amount"] = _sql(
    "SELECT merchant_id, CAST(amount AS DOUBLE) AS amount, w * 60000 AS window_start, (w + 5) * 60000 AS window_end FROM mw",
    _RULE_CTES["R008"])

# --- state that is forgotten: the clock runs so many seconds per arrival number -------------
def _clock(seconds: int) -> str:
    return f"(1704067200000000 + arrival_seq * {seconds} * 1000000)"


_HOUR = 3_600_000_000
ORACLE["r005_consecutive_failure_ttl"] = _sql(
    _RULE_BODY["R005"].replace("n >= 5", "n >= 2").replace("'5'", "'2'"), f"""
timed AS (SELECT *, {_clock(20)} - lag({_clock(20)}) OVER (PARTITION BY user_id ORDER BY arrival_seq) AS pause FROM ont),
isl AS (SELECT *, sum((transaction_status <> 'FAILED' OR coalesce(pause, 0) > {6 * _HOUR})::INT)
        OVER (PARTITION BY user_id ORDER BY arrival_seq) AS g FROM timed),
runs AS (SELECT *, sum((transaction_status = 'FAILED')::INT) OVER (PARTITION BY user_id, g ORDER BY arrival_seq) AS n FROM isl)""")
ORACLE["r007_user_amount_spike_ttl"] = _sql(_RULE_BODY["R007"], f"""
timed AS (SELECT *, {_clock(1500)} - lag({_clock(1500)}) OVER (PARTITION BY user_id ORDER BY arrival_seq) AS pause FROM paid),
parts AS (SELECT *, sum((coalesce(pause, 0) > {30 * 24 * _HOUR})::INT) OVER (PARTITION BY user_id ORDER BY arrival_seq) AS g FROM timed),
hist AS (SELECT *, count(*) OVER prev AS n, sum(amount) OVER prev AS t FROM parts
         WINDOW prev AS (PARTITION BY user_id, g ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
ORACLE["r008_merchant_spike_ttl"] = _sql(_RULE_BODY["R008"], f"""
slow AS (SELECT merchant_id, amount, (1704067200000000 + (us - 1704067200000000) * 115200) // 60000000 AS m FROM paid),
mw AS (SELECT merchant_id, w, sum(amount) AS amount FROM (SELECT merchant_id, amount, {_windows(5)} AS w FROM slow) GROUP BY 1, 2),
gaps AS (SELECT *, (w - lag(w) OVER (PARTITION BY merchant_id ORDER BY w) > {14 * 24 * 60})::INT AS pause FROM mw),
parts AS (SELECT *, sum(coalesce(pause, 0)) OVER (PARTITION BY merchant_id ORDER BY w) AS g FROM gaps),
mh AS (SELECT *, count(*) OVER prev AS n, sum(amount) OVER prev AS t FROM parts
       WINDOW prev AS (PARTITION BY merchant_id, g ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
ORACLE["dedup_event_id_24h"] = _sql(
    "SELECT event_id, arrival_seq, user_id, clock AS clock_us FROM seen JOIN taken USING (event_id, clock)", f"""
seen AS (SELECT CASE WHEN arrival_seq % 3 = 0 THEN 'evt-hot' ELSE 'evt-' || (arrival_seq % 997) END AS event_id,
  arrival_seq, user_id, {_clock(60)} AS clock FROM arr)""", f"""
nexts AS (SELECT event_id, clock, (SELECT min(b.clock) FROM seen b
  WHERE b.event_id = a.event_id AND b.clock > a.clock + {24 * _HOUR}) AS following FROM seen a)""", """
taken AS (SELECT event_id, min(clock) AS clock FROM seen GROUP BY 1
  UNION ALL SELECT n.event_id, n.following FROM taken JOIN nexts n USING (event_id, clock) WHERE n.following IS NOT NULL)""",
    base=_SRC).replace("WITH ", "WITH RECURSIVE ", 1)

ORACLE["alert_id"] = _sql(
    f"SELECT arrival_seq, event_id, {_uuid('''concat_ws('|','R006',event_id)''')} AS event_alert_id, "
    f"{_uuid('''concat_ws('|','R008','商户',merchant_id)''')} AS key_alert_id FROM arr", base=_SRC)
ORACLE["alert_event_time"] = _sql(
    "SELECT alert_id, rule_id, alert_time AS alert_event_time FROM alerts", *_ALERTS)

# --- sinks ---------------------------------------------------------------------
ORACLE["sink_jsonl"] = _sql("SELECT * FROM alerts", *_ALERTS)
ORACLE["sink_alert_table"] = _sql(
    "SELECT * REPLACE (CASE WHEN window_start IS NULL THEN alert_time END AS event_time), alert_time AS created_at FROM alerts",
    *_ALERTS)
_HEX = "('0x' || substr(alert_id, 1, 1))::INT"
_RUN2 = "replace(evidence, '}', ',\"run\":\"2\"}')"
_OTHER = ", ".join(c for c in _ALERT_COLUMNS if c not in ("alert_time", "evidence", "reason"))
ORACLE["sink_alert_upsert"] = _sql(
    f"""SELECT {_OTHER}, CASE WHEN {_HEX} < 8 THEN reason ELSE 'changed' END AS reason,
    CASE WHEN {_HEX} >= 4 THEN alert_time + 3600000 ELSE alert_time END AS alert_time,
    CASE WHEN {_HEX} >= 4 THEN {_RUN2} ELSE evidence END AS evidence FROM al""", *_STORED)
ORACLE["sink_alert_merge"] = ORACLE["sink_alert_upsert"]
ORACLE["sink_alert_dedup_latest"] = _sql(
    "SELECT alert_id, rule_id, alert_time + 3600000 AS alert_time, 'changed' AS reason FROM al", *_STORED)
ORACLE["check_alert_uniqueness"] = _sql(
    "SELECT rule_id, coalesce(user_id, '') AS user_id, coalesce(device_id, '') AS device_id, coalesce(card_id, '') AS card_id, "
    "coalesce(merchant_id, '') AS merchant_id, window_start, window_end, CAST(2 AS BIGINT) AS copies FROM al WHERE window_start IS NOT NULL", *_STORED)
_START5, _END5 = "w * 60000", "(w + 5) * 60000"
_MERCHANT_METRIC_ID = _uuid(
    f"concat_ws('|','merchant_realtime_amount_5m',merchant_id,({_START5})::VARCHAR,({_END5})::VARCHAR)")
ORACLE["sink_table_mapping"] = _sql(
    f"""SELECT {_MERCHANT_METRIC_ID} AS metric_id, 'merchant_realtime_amount_5m' AS metric_name,
    '{{"merchant_id":"' || merchant_id || '"}}' AS dimensions, CAST(amount AS DOUBLE) AS value,
    CAST(0 AS BIGINT) AS count_value, {_START5} AS window_start, {_END5} AS window_end, {_END5} AS emit_time,
    {_END5} AS created_at FROM mw""", _RULE_CTES["R008"])
ORACLE["late_store"] = _sql(
    """SELECT event_id, transaction_id, user_id, merchant_id, us // 1000 AS event_time,
    process_us // 1000 AS process_time,
    concat_ws('|', amount::VARCHAR, """ + ", ".join(f"{c}::VARCHAR" for c in TRANSACTION_FIELDS if c != "amount") + """) AS raw_event,
    process_us // 1000 AS created_at FROM ded WHERE is_late""")


def _replay() -> str:
    """Window rules over all events where late ones touch a window, and over on-time ones elsewhere."""
    keys = {"R001": ("user_id", 1), "R002": ("user_id", 5), "R003": ("device_id", 10), "R004": ("card_id", 10)}
    ctes = ", ".join(_RULE_CTES[r] for r in keys)
    fired = "\nUNION ALL\n".join(_RULE_BODY[r] for r in keys)
    touched = "\nUNION\n".join(
        f"SELECT '{r}' AS rule, {key} AS k, {_windows(n)} * 60000 AS s FROM every WHERE is_late"
        for r, (key, n) in keys.items()
    )
    hit = """EXISTS (SELECT 1 FROM touched WHERE rule = rule_id AND s = window_start
        AND k = coalesce(user_id, device_id, card_id))"""
    pick = "SELECT alert_id, rule_id, window_start, evidence"
    return _sql(
        f"{pick} FROM after WHERE {hit} UNION ALL {pick} FROM before WHERE NOT {hit}",
        "\nevery AS (SELECT *, us // 60000000 AS m FROM ded)",
        f"\ntouched AS ({touched})",
        f"\nbefore AS (WITH {ctes} {fired})",
        "\nafter AS (WITH ont AS (SELECT * FROM every), "
        f"paid AS (SELECT * FROM ont WHERE transaction_status = 'SUCCESS'), {ctes} {fired})",
    )


ORACLE["late_replay"] = _replay()
# nothing is late: every first arrival counts
_ALL_ON_TIME = _SRC + """,
marked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival_seq) AS nth FROM arr),
ont AS (SELECT *, us // 60000000 AS m FROM marked WHERE nth = 1),
paid AS (SELECT * FROM ont WHERE transaction_status = 'SUCCESS')"""
_TWO = _RULE_BODY["R005"].replace("n >= 5", "n >= 2").replace("'5'", "'2'")
ORACLE["late_replay_users"] = _sql(
    f"SELECT alert_id, rule_id, event_id, user_id, evidence FROM ({_TWO} UNION ALL {_RULE_BODY['R007']})",
    _RULE_CTES["R005"], _RULE_CTES["R007"], base=_ALL_ON_TIME)
ORACLE["late_replay_all"] = _sql(
    "SELECT alert_id, rule_id, event_id, window_start, evidence FROM alerts", *_ALERTS, base=_ALL_ON_TIME)
ORACLE["publish_keyed"] = _sql(
    """SELECT CASE WHEN arrival_seq % 5 <> 0 THEN user_id WHEN arrival_seq % 7 <> 0 THEN device_id ELSE event_id END AS key,
    event_id, '2026-01-01T00:00:00Z' AS process_time FROM arr""", base=_SRC)

# --- raw text: the same defects by event number ----------------------------------
_RAW = _SRC + """,
raw AS (
  SELECT *, CASE WHEN no % 83 = 0 THEN 'malformed_json' WHEN no % 89 = 0 THEN 'missing_required_field'
      WHEN no % 79 = 0 THEN 'missing_enum_field' WHEN no % 67 = 0 THEN 'bad_amount'
      WHEN no % 73 = 0 THEN 'negative_amount' WHEN no % 71 = 0 THEN 'bad_event_time' END AS reject_reason
  FROM arr)"""
ORACLE["source_jsonl"] = _sql(
    """SELECT event_id, transaction_id, CASE WHEN no % 89 = 0 THEN '  ' ELSE user_id END AS user_id, account_id, card_id,
    merchant_id, device_id, ip, province, city, currency, payment_method, transaction_type, transaction_status,
    CASE WHEN no % 71 = 0 THEN substr(event_time, 1, 10) ELSE event_time END AS event_time, process_time,
    CASE WHEN no % 79 <> 0 THEN channel END AS channel, app_version, is_black_device::VARCHAR AS is_black_device,
    is_black_card::VARCHAR AS is_black_card, risk_label,
    CAST(CASE WHEN no % 67 = 0 THEN NULL WHEN no % 73 = 0 THEN -amount - 1 ELSE amount END AS DOUBLE) AS amount
    FROM arr WHERE no % 83 <> 0 AND no % 19 <> 0 AND no % 23 <> 0""", base=_SRC)
ORACLE["source_dir_filter"] = _sql(
    "SELECT CASE WHEN no % 83 <> 0 THEN event_id END AS event_id, count(*) AS n FROM arr GROUP BY 1", base=_SRC)
ORACLE["parse_transactions"] = _sql(
    """SELECT arrival_seq, event_id, transaction_id, user_id, account_id, card_id, merchant_id, device_id, ip,
    province, city, CAST(amount AS DOUBLE) AS amount, currency, payment_method, transaction_type, transaction_status,
    event_time, process_time, channel, app_version, is_black_device, is_black_card, risk_label, us // 1000 AS event_ts
    FROM raw WHERE reject_reason IS NULL""", base=_RAW)
for _name, _why in {
    "validate_required": "'missing_required_field'", "validate_enums_present": "'missing_enum_field'",
    "validate_amount": "'negative_amount', 'bad_amount'",
}.items():
    ORACLE[_name] = _sql(
        f"SELECT no AS event_no, arrival_seq, reject_reason FROM raw WHERE reject_reason IN ({_why})", base=_RAW)
ORACLE["dead_letter"] = _sql(
    """SELECT 'payment_transaction_events' AS topic, CASE WHEN reject_reason <> 'malformed_json' THEN event_id END AS event_id,
    CASE WHEN reject_reason = 'malformed_json' THEN CAST(40 AS INT) END AS raw_length, reject_reason AS error_message,
    process_us // 1000 AS created_at FROM raw WHERE reject_reason IS NOT NULL""", base=_RAW)
ORACLE["event_time_parse"] = _sql(
    """SELECT arrival_seq, CASE WHEN no % 83 = 0 THEN NULL WHEN no % 71 = 0 THEN substr(event_time, 1, 10) ELSE event_time END AS event_time,
    CASE WHEN no % 83 <> 0 AND no % 71 <> 0 THEN us // 1000 END AS event_ts FROM raw""", base=_RAW)
ORACLE["q_dead_letter_by_minute"] = _sql(
    """SELECT process_us // 60000000 * 60000 AS minute_bucket, count(*) AS dead_letter_count FROM raw
    WHERE reject_reason IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 60""", base=_RAW)

_TEXT_AMOUNT = "(no % 3 = 0 OR no % 67 = 0)"
_V_TX = f"""
v AS (
  SELECT no AS event_no, arrival_seq, '$' AS field, 'type' AS rule FROM arr WHERE no % 83 = 0
  UNION ALL SELECT no, arrival_seq, 'event_id', 'minLength' FROM arr WHERE no % 83 <> 0 AND length(event_id) < 8
  UNION ALL SELECT no, arrival_seq, 'amount', 'type' FROM arr WHERE no % 83 <> 0 AND {_TEXT_AMOUNT}
  UNION ALL SELECT no, arrival_seq, 'amount', 'minimum' FROM arr WHERE no % 83 <> 0 AND NOT {_TEXT_AMOUNT} AND no % 73 = 0
  UNION ALL SELECT no, arrival_seq, 'channel', 'required' FROM arr WHERE no % 83 <> 0 AND no % 79 = 0
  UNION ALL SELECT no, arrival_seq, 'unknown_field', 'additionalProperties' FROM arr WHERE no % 83 <> 0 AND no % 10 = 0)"""
_V_USER = """
vu AS (
  SELECT event_id AS event_no, 'event_id' AS field, 'minLength' AS rule FROM events WHERE length('uevt-' || event_id) < 8
  UNION ALL SELECT event_id, 'device_id', 'required' FROM events WHERE event_id % 31 = 0
  UNION ALL SELECT event_id, 'event_type', 'enum' FROM events WHERE event_type = 'error'
  UNION ALL SELECT event_id, 'extra', 'additionalProperties' FROM events WHERE event_id % 37 = 0)"""
ORACLE["schema_violations_transaction"] = _sql("SELECT * FROM v", _V_TX, base=_SRC)
ORACLE["schema_violations_user_event"] = _sql("SELECT * FROM vu", _V_USER, base=_SRC)
ORACLE["schema_discriminate"] = _sql(
    """SELECT is_transaction, is_user_event, is_transaction <> is_user_event AS is_valid, count(*) AS n FROM (
      SELECT NOT EXISTS (SELECT 1 FROM v WHERE v.arrival_seq = arr.arrival_seq) AS is_transaction, false AS is_user_event FROM arr
      UNION ALL
      SELECT false, NOT EXISTS (SELECT 1 FROM vu WHERE vu.event_no = events.event_id) FROM events) GROUP BY 1, 2, 3""",
    _V_TX, _V_USER, base=_SRC)

# --- preparation -------------------------------------------------------------------
_PREPARED = ("event_id, user_id, arrival_seq, us // 1000 AS event_ts, CAST(amount AS DOUBLE) AS amount, process_time")
ORACLE["watermark_60s"] = _sql(
    "SELECT event_id, arrival_seq, us // 1000 AS event_ts, wm // 1000 AS watermark_ts FROM marked")
ORACLE["dedup_event_id"] = _sql(f"SELECT {_PREPARED} FROM ded")
ORACLE["route_late"] = _sql("SELECT event_id, arrival_seq, us // 1000 AS event_ts, is_late FROM ded")
ORACLE["late_events"] = _sql(f"SELECT {_PREPARED} FROM ded WHERE is_late")
ORACLE["on_time_events"] = _sql(f"SELECT {_PREPARED} FROM ont")
ORACLE["successful_payments"] = _sql(f"SELECT {_PREPARED}, transaction_status FROM paid")


# --- metrics -------------------------------------------------------------------------
def _metric(name: str, source: str, minutes: int, value: str, count: str, key: str = "", dims: str = "'{}'") -> str:
    start, end = "w * 60000", f"(w + {minutes}) * 60000"
    part = f"{key}," if key else ""
    ident = _uuid(f"concat_ws('|','{name}',{part}({start})::VARCHAR,({end})::VARCHAR)")
    return (
        f"SELECT {ident} AS metric_id, '{name}' AS metric_name, {dims} AS dimensions, CAST({value} AS DOUBLE) AS value, "
        f"CAST({count} AS BIGINT) AS \"count\", {start} AS window_start, {end} AS window_end, {end} AS emit_time FROM {source}"
    )


_M_COUNT = _metric("transaction_count_1m", "(SELECT m AS w, count(*) AS n FROM ont GROUP BY 1)", 1, "n", "n")
_M_AMOUNT = _metric(
    "transaction_amount_5m",
    f"(SELECT w, sum(amount) AS t FROM (SELECT amount, {_windows(5)} AS w FROM paid) GROUP BY 1)", 5, "t", "0")
_M_RATE = _metric(
    "channel_success_rate_5m",
    f"""(SELECT channel, w, count(*) AS n, count(*) FILTER (WHERE transaction_status = 'SUCCESS') AS ok
        FROM (SELECT channel, transaction_status, {_windows(5)} AS w FROM ont) GROUP BY 1, 2)""",
    5, "CAST(ok AS DOUBLE) / n", "n", "channel",
    """'{"channel":"' || channel || '","success":"' || ok || '","total":"' || n || '"}'""")
_M_MERCHANT = _metric(
    "merchant_realtime_amount_5m", "mw", 5, "amount", "0", "merchant_id", """'{"merchant_id":"' || merchant_id || '"}'""")
_MINUTE = "alert_time // 60000 AS w"
_M_ALERTS = _metric("risk_alert_count_1m", f"(SELECT {_MINUTE}, count(*) AS n FROM alerts GROUP BY 1)", 1, "n", "n")
_M_HIGH = _metric(
    "high_risk_alert_count_1m",
    f"(SELECT {_MINUTE}, count(*) AS n FROM alerts WHERE risk_level = 'HIGH' GROUP BY 1)", 1, "n", "n")
ORACLE["metric_transaction_count_1m"] = _sql(_M_COUNT)
ORACLE["metric_transaction_amount_5m"] = _sql(_M_AMOUNT)
ORACLE["metric_channel_success_rate_5m"] = _sql(_M_RATE)
ORACLE["metric_merchant_amount_5m"] = _sql(_M_MERCHANT, _RULE_CTES["R008"])
ORACLE["metric_risk_alert_count_1m"] = _sql(_M_ALERTS, *_ALERTS)
ORACLE["metric_high_risk_alert_count_1m"] = _sql(_M_HIGH, *_ALERTS)
_ALL_METRICS = "\nUNION ALL\n".join([_M_COUNT, _M_AMOUNT, _M_RATE, _M_MERCHANT, _M_ALERTS, _M_HIGH])
ORACLE["realtime_metrics"] = _sql(_ALL_METRICS, *_ALERTS)
ORACLE["metric_id"] = _sql(f"SELECT metric_id, metric_name, window_start, window_end FROM ({_ALL_METRICS})", *_ALERTS)

ORACLE["metric_replay"] = _sql(_ALL_METRICS, *_ALERTS, base=_ALL_ON_TIME)

# --- serving -----------------------------------------------------------------------------
ORACLE["q_alert_volume_by_minute"] = _sql(
    "SELECT alert_time // 60000 * 60000 AS minute_bucket, count(*) AS alert_count FROM alerts GROUP BY 1 ORDER BY 1 DESC LIMIT 60",
    *_ALERTS)
ORACLE["q_alerts_by_level_1h"] = _sql(
    """SELECT risk_level, count(*) AS alert_count FROM alerts
    WHERE alert_time >= (SELECT max(alert_time) FROM alerts) - 3600000 GROUP BY 1""", *_ALERTS)
ORACLE["q_top_users_by_alerts"] = _sql(
    """SELECT user_id, count(*) AS alert_count, max(alert_time) AS last_alert_time FROM alerts WHERE user_id IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", *_ALERTS)
ORACLE["q_merchant_peak_amount"] = _sql(
    """SELECT merchant_id, CAST(max(amount) AS DOUBLE) AS latest_5m_amount, max((w + 5) * 60000) AS last_window_end
    FROM mw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", _RULE_CTES["R008"])
ORACLE["q_channel_success_rate_30m"] = _sql(
    """SELECT json_extract_string(dimensions, '$.channel') AS channel, round(avg(value), 9) AS avg_success_rate FROM rates
    WHERE window_end >= (SELECT max(window_end) FROM rates) - 1800000 GROUP BY 1""", f"\nrates AS ({_M_RATE})")
ORACLE["q_late_by_minute"] = _sql(
    """SELECT process_us // 60000000 * 60000 AS minute_bucket, count(*) AS late_event_count FROM ded WHERE is_late
    GROUP BY 1 ORDER BY 1 DESC LIMIT 60""")

# --- dashboard ------------------------------------------------------------------------------
_SCORE = """
scored AS (SELECT *, CAST(round(least(least(99.0::DOUBLE, 18.0::DOUBLE + log10(greatest(CAST(amount AS DOUBLE), 1.0)) * 10.0)
    + CASE WHEN is_black_device THEN 18.0 ELSE 0.0 END::DOUBLE + CASE WHEN is_black_card THEN 10.0 ELSE 0.0 END::DOUBLE
    + CASE WHEN risk_label <> 'NORMAL' THEN 12.0 ELSE 0.0 END::DOUBLE
    + CASE WHEN transaction_status = 'FAILED' THEN 7.0 ELSE 0.0 END::DOUBLE, 100.0::DOUBLE), 2) AS DECIMAL(5,2)) AS risk FROM ont)"""
ORACLE["risk_score"] = _sql(
    "SELECT event_id, CAST(amount AS DOUBLE) AS amount, risk_label, CAST(risk AS DOUBLE) AS risk_score FROM scored", _SCORE)
for _key in ("channel", "risk_label"):
    ORACLE[f"group_count_{_key}"] = _sql(f"SELECT {_key} AS name, count(*) AS value FROM ont GROUP BY 1")
for _key in ("risk_level", "rule_id"):
    ORACLE[f"group_count_{_key}"] = _sql(f"SELECT {_key} AS name, count(*) AS value FROM alerts GROUP BY 1", *_ALERTS)
for _name, _key in (("city", "city"), ("merchant", "merchant_id")):
    ORACLE[f"top_amount_{_name}"] = _sql(
        f"SELECT name, CAST(t AS DOUBLE) AS value FROM (SELECT {_key} AS name, sum(amount) AS t FROM ont GROUP BY 1) ORDER BY t DESC, name LIMIT 10")
# mean risk in hundredths, rounded half up in integers
_MEAN = "CAST((2 * sum(CAST(risk * 100 AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100"
_BINS = f"""
ranked AS (SELECT *, row_number() OVER (ORDER BY us, arrival_seq) AS rn FROM scored),
series AS (SELECT (rn - 1) // greatest((SELECT CAST(ceil(count(*) / 36.0) AS BIGINT) FROM ont), 1) AS chunk,
    strftime(make_timestamp(max(us)), '%H:%M') AS "time", count(*) AS "count", sum(amount) AS amount,
    count(*) FILTER (WHERE transaction_status = 'FAILED') AS failed, {_MEAN} AS risk FROM ranked GROUP BY 1)"""
ORACLE["time_series_equal_bins"] = _sql(
    'SELECT CAST(chunk AS INT) AS chunk, "time", "count", CAST(amount AS DOUBLE) AS amount, failed, risk FROM series', _SCORE, _BINS)
_POINTS = """
pts AS (SELECT *, row_number() OVER (ORDER BY arrival_seq) - 1 AS i, greatest(count(*) OVER () // 800, 1) AS step FROM scored),
scatter AS (SELECT CAST(extract(hour FROM make_timestamp(us)) AS INT) AS hour,
    round(log10(greatest(CAST(amount AS DOUBLE), 1.0)), 4) AS log_amount,
    CAST(risk AS DOUBLE) AS risk, channel, risk_label, transaction_id AS id FROM pts WHERE i % step = 0 AND i // step < 800)"""
ORACLE["risk_scatter"] = _sql("SELECT * FROM scatter", _SCORE, _POINTS)
ORACLE["filter_scatter"] = _sql(
    "SELECT * FROM scatter WHERE channel = 'POS' AND risk_label = 'NORMAL' AND log_amount >= 3.5", _SCORE, _POINTS)
ORACLE["channel_label_heatmap"] = _sql(
    """SELECT channel, risk_label, value, CAST(dense_rank() OVER (ORDER BY channel) - 1 AS INT) AS x,
    CAST(dense_rank() OVER (ORDER BY risk_label) - 1 AS INT) AS y
    FROM (SELECT channel, risk_label, count(*) AS value FROM ont GROUP BY 1, 2)""")
ORACLE["flow_links"] = _sql(
    """SELECT CAST(mt.i AS INT) AS position, ct.name AS source, mt.name AS target, CAST(mt.t AS DOUBLE) AS value
    FROM mt JOIN ct ON mt.i % (SELECT count(*) FROM ct) = ct.i""",
    """
mt AS (SELECT *, row_number() OVER (ORDER BY t DESC, name) - 1 AS i FROM
  (SELECT merchant_id AS name, sum(amount) AS t FROM ont GROUP BY 1) QUALIFY i < 12),
ct AS (SELECT *, row_number() OVER (ORDER BY t DESC, name) - 1 AS i FROM
  (SELECT city AS name, sum(amount) AS t FROM ont GROUP BY 1) QUALIFY i < 12)""")
ORACLE["recent_alerts"] = _sql(
    "SELECT alert_id, rule_id, alert_time FROM alerts ORDER BY alert_time DESC, alert_id DESC LIMIT 30", *_ALERTS)
ORACLE["recent_metrics"] = _sql(
    f"SELECT metric_id, metric_name, value, emit_time FROM ({_ALL_METRICS}) ORDER BY emit_time DESC, metric_id DESC LIMIT 30", *_ALERTS)
ORACLE["filter_alerts"] = _sql(
    "SELECT alert_id, user_id, alert_time FROM alerts WHERE rule_id = 'R002' ORDER BY alert_time DESC, alert_id DESC LIMIT 16",
    *_ALERTS)


# --- anti-money-laundering conversion -------------------------------------------------------------
def _int(expr: str, modulo: int) -> str:
    return f"(CAST('0x' || substr(sha256({expr}), 1, 8) AS BIGINT) % {modulo})"


def _hash(expr: str, n: int) -> str:
    return f"substr(sha256({expr}), 1, {n})"


_AML = f"""
amlsrc AS (
  SELECT CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderkey::VARCHAR END AS record_key,
    strftime(o_orderdate, '%Y-%m-%d') || 'T00:08:00Z' AS "timestamp", 'Bank ' || c_nationkey AS from_bank,
    o_custkey::VARCHAR AS from_account, {_list(AML_COUNTRIES)}[c_nationkey % {len(AML_COUNTRIES)} + 1] AS from_country,
    'Bank ' || (o_orderkey % 50) AS to_bank, (o_orderkey % 1000)::VARCHAR AS to_account, 'US' AS to_country,
    CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR AS amount_received,
    CASE WHEN c_nationkey % 2 = 0 THEN 'US Dollar' ELSE 'Euro' END AS receiving_currency,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR END AS amount_paid,
    CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN c_nationkey % 2 = 0 THEN 'US Dollar' ELSE 'Euro' END AS payment_currency,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'Cheque' WHEN '3-MEDIUM' THEN 'Cash'
      WHEN '4-NOT SPECIFIED' THEN 'Reinvestment' ELSE 'Withdrawal' END AS payment_format,
    CASE WHEN o_orderkey % 101 = 0 THEN ' True ' ELSE 'False' END AS is_laundering,
    CASE WHEN o_orderkey % 53 = 0 THEN 'yes' ELSE 'no' END AS predicted_alert,
    CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(CAST(o_orderkey % 1000 / 1000.0 AS DECIMAL(4,3)) AS VARCHAR) END AS model_score,
    'False' AS is_dashboard_sample
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
_RAW_COLUMNS = (
    "record_key timestamp from_bank from_account from_country to_bank to_account to_country amount_received "
    "receiving_currency amount_paid payment_currency payment_format is_laundering predicted_alert model_score "
    "is_dashboard_sample"
).split()
_WHOLE_ROW = "concat_ws('|', " + ", ".join(f'"{c}"' for c in _RAW_COLUMNS) + ")"
_PLACES = "CASE upper(from_country) " + " ".join(
    f"WHEN '{code}' THEN ['{p}', '{c}']" for code, (p, c) in COUNTRY_LOCATION.items()
) + " ELSE ['Global', CASE WHEN from_country = '' THEN 'Unknown' ELSE from_country END] END"
_METHOD = """CASE WHEN upper(payment_format) LIKE '%CARD%' OR upper(payment_format) LIKE '%CREDIT%' THEN 'CREDIT_CARD'
    WHEN upper(payment_format) LIKE '%CHEQUE%' THEN 'BANK_CARD' WHEN upper(payment_format) LIKE '%CASH%' THEN 'BALANCE'
    ELSE 'BANK_CARD' END"""
_TYPE = """CASE WHEN upper(payment_format) LIKE '%REINVEST%' THEN 'TRANSFER'
    WHEN upper(payment_format) LIKE '%WITHDRAW%' THEN 'WITHDRAW' ELSE 'PAY' END"""
_AML_EVENTS = _AML + f""",
amlb AS (SELECT *, CASE WHEN record_key = '' THEN {_WHOLE_ROW} ELSE record_key END AS rk,
    lower(trim(is_laundering)) IN ('true','1','yes','y') AS laundering,
    lower(trim(predicted_alert)) IN ('true','1','yes','y') AS predicted,
    coalesce(TRY_CAST(model_score AS DOUBLE), 0.0) AS score,
    CAST(CASE WHEN amount_paid = '' THEN amount_received ELSE amount_paid END AS DECIMAL(18,2)) AS amt,
    epoch_us(CAST(replace("timestamp", 'Z', '') AS TIMESTAMP)) AS us FROM amlsrc),
aml AS (SELECT 'evt-aml-' || {_hash('rk', 24)} AS event_id, 'txn-aml-' || {_hash('rk', 24)} AS transaction_id,
    'user-' || {_hash('from_account', 10)} AS user_id, 'acct-' || from_account AS account_id,
    'card-' || {_hash('from_account || from_bank', 12)} AS card_id,
    'merchant-' || {_hash('to_bank || to_account', 12)} AS merchant_id,
    'device-' || {_hash('from_account || from_country', 12)} AS device_id,
    '10.' || ({_int('from_account', 240)} + 1) || '.' || ({_int('to_account', 240)} + 1) || '.' || ({_int('rk', 240)} + 1) AS ip,
    ({_PLACES})[1] AS province, ({_PLACES})[2] AS city, CAST(amt AS DOUBLE) AS amount,
    replace(CASE WHEN payment_currency <> '' THEN payment_currency ELSE receiving_currency END, 'US Dollar', 'USD') AS currency,
    {_METHOD} AS payment_method, {_TYPE} AS transaction_type,
    CASE WHEN {_int('rk', 1000)} < 4 THEN 'FAILED' ELSE 'SUCCESS' END AS transaction_status,
    {_iso('us')} AS event_time, {_iso(f"us + {_int('rk', 3600)} * 1000000")} AS process_time,
    {_list(CHANNEL_ORDER)}[{_int('rk', 5)} + 1] AS channel,
    ({_int('from_account', 2)} + 6) || '.' || {_int('to_account', 10)} || '.' || {_int('rk', 10)} AS app_version,
    laundering OR score >= 0.97 AS is_black_device, laundering AND amt >= 50000 AS is_black_card,
    CASE WHEN laundering THEN 'AML_LAUNDERING' WHEN predicted THEN 'MODEL_ALERT' WHEN score >= 0.85 THEN 'HIGH_MODEL_SCORE'
      ELSE 'NORMAL' END AS risk_label,
    from_account, to_account, to_bank
  FROM amlb)"""
_TX = (
    "event_id, transaction_id, user_id, account_id, card_id, merchant_id, device_id, ip, province, city, amount, currency, "
    "payment_method, transaction_type, transaction_status, event_time, process_time, channel, app_version, is_black_device, "
    "is_black_card, risk_label"
)


def _aml(columns: str) -> str:
    return f"WITH {_AML.strip()}\nSELECT from_account, to_account, to_bank, {columns} FROM amlsrc"


ORACLE["source_aml_csv"] = f"WITH {_AML.strip()}\nSELECT * FROM amlsrc"
ORACLE["source_aml_csv_part"] = f"WITH {_AML.strip()}\nSELECT * FROM amlsrc ORDER BY ALL LIMIT 5000 OFFSET 100"
ORACLE["stable_hash"] = _aml(f"{_hash('from_account', 16)} AS hash16, {_hash('to_bank', 24)} AS hash24")
ORACLE["stable_int"] = _aml(f"{_int('from_account', 240)} AS mod240, {_int('to_account', 1000)} AS mod1000")
ORACLE["parse_bool"] = _aml(
    "is_laundering, predicted_alert, trim(is_laundering) = 'True' AS laundering, predicted_alert = 'yes' AS predicted")
ORACLE["parse_float"] = _aml(
    "model_score, coalesce(TRY_CAST(model_score AS DOUBLE), 0.0) AS score, coalesce(TRY_CAST(amount_paid AS DOUBLE), 0.0) AS paid")
ORACLE["iso_timestamp"] = _aml(
    """strftime(CAST(replace("timestamp", 'Z', '') AS TIMESTAMP) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS from_offset,
    '2026-01-01T00:00:00Z' AS from_blank""")
ORACLE["payment_method"] = _aml(f"payment_format, {_METHOD} AS payment_method")
ORACLE["transaction_type"] = _aml(f"payment_format, {_TYPE} AS transaction_type")
ORACLE["country_location"] = _aml(f"from_country, ({_PLACES})[1] AS province, ({_PLACES})[2] AS city")
ORACLE["risk_label"] = f"WITH {_AML_EVENTS.strip()}\nSELECT from_account, to_account, to_bank, risk_label FROM aml"
ORACLE["status_flags_channel"] = (
    f"WITH {_AML_EVENTS.strip()}\nSELECT event_id, transaction_status, is_black_device, is_black_card, channel, "
    "app_version, ip, process_time FROM aml")
ORACLE["map_aml_to_transaction"] = f"WITH {_AML_EVENTS.strip()}\nSELECT {_TX} FROM aml"
ORACLE["table_dwd_transactions"] = (
    f"WITH {_AML_EVENTS.strip()}\nSELECT channel, risk_label, count(*) AS n, "
    "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM aml GROUP BY 1, 2")
_CONV = """SELECT count(*) AS converted_rows, CAST(0 AS BIGINT) AS skipped_rows,
    count(*) FILTER (WHERE risk_label = 'AML_LAUNDERING') AS laundering_rows,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount, max(amount) AS max_amount FROM aml"""
ORACLE["convert_metadata"] = f"WITH {_AML_EVENTS.strip()}\n{_CONV}"
_REST = _AML_EVENTS.strip().replace("FROM amlsrc)", "FROM (SELECT * FROM amlsrc ORDER BY ALL OFFSET 100))")
ORACLE["convert_file"] = f"WITH {_REST}\n" + _CONV.replace("CAST(0 AS BIGINT)", "CAST(100 AS BIGINT)")
ORACLE["overview"] = _sql(
    f"""SELECT (SELECT count(*) FROM ont) AS event_sample_count, (SELECT CAST(sum(amount) AS DOUBLE) FROM ont) AS sample_amount,
    (SELECT {_MEAN} FROM scored) AS avg_risk_score, (SELECT count(*) FROM alerts) AS alert_count,
    (SELECT count(*) FROM alerts WHERE risk_level = 'HIGH') AS high_alert_count,
    (SELECT count(*) FROM ded WHERE is_late) AS late_event_count, converted_rows AS enterprise_converted_rows,
    CAST(0 AS BIGINT) AS enterprise_source_size_bytes, max_amount FROM conv""", _SCORE, *_ALERTS, _AML_EVENTS, f"\nconv AS ({_CONV})")
ORACLE["insight_facts"] = _sql(
    f"""SELECT (SELECT {_MEAN} FROM scored) AS avg_risk_score,
    (SELECT "time" FROM series ORDER BY amount DESC, chunk LIMIT 1) AS peak_time,
    (SELECT CAST(max(amount) AS DOUBLE) FROM series) AS peak_amount,
    (SELECT channel FROM ont GROUP BY 1 ORDER BY count(*) DESC, channel LIMIT 1) AS top_channel,
    (SELECT count(*) FROM ont GROUP BY channel ORDER BY count(*) DESC, channel LIMIT 1) AS top_channel_count,
    (SELECT count(*) FROM alerts WHERE risk_level = 'HIGH') AS high_alert_count,
    round(CAST(laundering_rows AS DOUBLE) / converted_rows * 100, 9) AS aml_label_density_pct FROM conv""",
    _SCORE, _BINS, *_ALERTS, _AML_EVENTS, f"\nconv AS ({_CONV})")

# --- extensions ---------------------------------------------------------------------------------
ORACLE["city_amount_topn_5m"] = _sql(
    f"""SELECT city, CAST(amount AS DOUBLE) AS amount, w * 60000 AS window_start, (w + 5) * 60000 AS window_end, CAST(place AS INT) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY amount DESC, city) AS place FROM
      (SELECT city, w, sum(amount) AS amount FROM (SELECT city, amount, {_windows(5)} AS w FROM paid) GROUP BY 1, 2))
    WHERE place <= 3""")
ORACLE["consecutive_failure_users"] = _sql(
    """SELECT count(DISTINCT user_id) AS users, us // 60000000 * 60000 AS window_start, (us // 60000000 + 1) * 60000 AS window_end
    FROM runs WHERE transaction_status = 'FAILED' AND n >= 5 GROUP BY 2, 3""", _RULE_CTES["R005"])
ORACLE["feature_stream"] = _sql(
    "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE rule_id = '{r}') AS {r}" for r in RULE_IDS)
    + " FROM alerts WHERE user_id IS NOT NULL GROUP BY 1", *_ALERTS)
ORACLE["merchant_amount_two_stage"] = ORACLE["merchant_window_amount"]
ORACLE["rules_from_config"] = _sql(
    "SELECT alert_id, rule_id, evidence, CAST(4 AS INT) AS version FROM ("
    + _RULE_BODY["R001"].replace("n > 10", "n > 12").replace("'10'", "'12'") + " UNION ALL "
    + _RULE_BODY["R002"].replace("t > 20000", "t > 40000").replace("'20000.00'", "'40000.00'") + ")",
    _RULE_CTES["R001"], _RULE_CTES["R002"])


def _by_time() -> str:
    """The rules with their thresholds as functions of the version, three minutes each from the start."""
    def version(ms: str) -> str:
        return f"least(4, ({ms} - 1704067200000) // 180000)"

    def window(minutes: int) -> str:
        return version(f"((w + {minutes}) * 60000 - 1)")

    def noted(body: str, old: str, new: str, shown: str, v: str) -> str:
        # the threshold in the condition, in the evidence, and the version as its last entry
        condition, text = old
        body = body.replace(condition, new).replace(text, shown)
        return body.replace("|| '}'", f"""|| ',"rule_version":"' || {v} || '"}}'""", 1)

    now = version("(us // 1000)")
    whole = lambda v, add: f"CAST({v} + {add} AS BIGINT)"
    tenths = lambda v, a, b: f"CAST(({v} * {a} + {b}) AS DECIMAL(9,1))"
    users = {"R003": ("dev", 3), "R004": ("crd", 2)}
    bodies = [
        noted(_RULE_BODY["R001"], ("n > 10", "'10'"), f"n > {whole(window(1), 8)}", whole(window(1), 8), window(1)),
        noted(_RULE_BODY["R002"], ("t > 20000", "'20000.00'"), f"t > ({window(5)} + 1) * 10000",
              f"(({window(5)} + 1) * 10000) || '.00'", window(5)),
        *[noted(_RULE_BODY[r], (f"FROM {name}", "'5'" if r == "R003" else "'3'"),
                f"FROM (SELECT * FROM {name} WHERE n > {whole(window(10), add)})", whole(window(10), add), window(10))
          for r, (name, add) in users.items()],
        noted(_RULE_BODY["R005"], ("n >= 5", "'5'"), f"n >= {whole(now, 1)}", whole(now, 1), now),
        noted(_RULE_BODY["R006"], ("ont WHERE is_black_device", "'unused'"), f"ont WHERE is_black_device AND {now} % 2 = 0", "", now),
        noted(_RULE_BODY["R007"], ("amount * n > 5 * t", "'5.0'"), f"amount * n > {whole(now, 3)} * t", tenths(now, 1, 3), now),
        noted(_RULE_BODY["R008"], ("amount * n > 3 * t", "'3.0'"), f"amount * n > {tenths(window(5), 0.5, 2)} * t",
              tenths(window(5), 0.5, 2), window(5)),
    ]
    ctes = {**_RULE_CTES, "R003": _users_cte("dev", "device_id", 0), "R004": _users_cte("crd", "card_id", 0)}
    return _sql(
        "SELECT alert_id, rule_id, event_id, window_end, evidence FROM (" + "\nUNION ALL\n".join(bodies) + ")",
        *[c for c in ctes.values() if c])


ORACLE["rules_by_time"] = _by_time()
ORACLE["blacklist_join"] = _sql(
    """SELECT * FROM (SELECT event_id, device_id, card_id,
      is_black_device OR EXISTS (SELECT 1 FROM supplier WHERE s_acctbal < 0 AND 'device-' || s_suppkey = device_id) AS is_black_device,
      is_black_card OR EXISTS (SELECT 1 FROM supplier WHERE s_acctbal < 0 AND 'card-' || s_suppkey = card_id) AS is_black_card
      FROM ont) WHERE is_black_device OR is_black_card""")
_CHANGES = """
changed AS (SELECT list, list || '-' || s_suppkey AS id, listed, 1704067200000000 + second * 1000000 AS t FROM supplier,
  LATERAL (VALUES ('device', true, s_suppkey % 300), ('device', true, s_suppkey % 300 + 50),
    ('device', false, s_suppkey % 300 + 200 + s_suppkey % 2 * 90000), ('card', true, s_suppkey % 400),
    ('card', false, s_suppkey % 400 + 150), ('card', true, s_suppkey % 400 + 300),
    ('card', false, s_suppkey % 400 + 300 - s_suppkey % 3 * 20)) AS v(list, listed, second) WHERE s_acctbal < 2000),
at_once AS (SELECT list, id, t, bool_and(listed) AS listed FROM changed GROUP BY 1, 2, 3)"""


def _on_list(name: str, key: str) -> str:
    """The last change up to the event is an addition."""
    return f"coalesce((SELECT arg_max(listed, t) FROM at_once WHERE list = '{name}' AND id = {key} AND t <= us), false)"


_LISTED = f"""SELECT * FROM (SELECT event_id, device_id, card_id, is_black_device OR {_on_list('device', 'device_id')} AS is_black_device,
    is_black_card OR {_on_list('card', 'card_id')} AS is_black_card FROM ont) WHERE is_black_device OR is_black_card"""
ORACLE["blacklist_by_time"] = _sql(_LISTED, _CHANGES)
_COOLDOWN = """
keyed AS (SELECT alert_id, rule_id, alert_time, window_end, rule_id || '|' || CASE WHEN rule_id = 'R006' THEN device_id
      ELSE coalesce(user_id, device_id, card_id, merchant_id) END AS k FROM alerts),
ordered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY alert_time, alert_id) AS r FROM keyed),
nexts AS (SELECT *, (SELECT min(o.r) FROM ordered o WHERE o.k = ordered.k AND o.alert_time >= ordered.alert_time + 600000) AS nr FROM ordered),
emitted AS (SELECT * FROM nexts WHERE r = 1
  UNION ALL SELECT n.* FROM emitted e JOIN nexts n ON n.k = e.k AND n.r = e.nr)"""
ORACLE["alert_cooldown"] = _sql("SELECT alert_id, rule_id, alert_time FROM emitted", *_ALERTS, _COOLDOWN).replace(
    "WITH ", "WITH RECURSIVE ", 1)

# --- streaming: the rules over all that arrived, windows that the watermark has closed -----------
_STREAM = _RAW + _PREP[len(_SRC):].replace("FROM arr)", "FROM raw WHERE reject_reason IS NULL)")
_CLOSED = "window_end <= (SELECT max(us) // 1000 - 60000 FROM ont)"
_STREAM_COLUMNS = "alert_id, rule_id, user_id, merchant_id, event_id, window_start, window_end, evidence"


def _stream_rule(rule: str) -> str:
    return _sql(
        f"SELECT {_STREAM_COLUMNS} FROM ({_RULE_BODY[rule]}) WHERE window_end IS NULL OR {_CLOSED}",
        _RULE_CTES[rule], base=_STREAM)


ORACLE["stream_user_frequency"] = _stream_rule("R001")
ORACLE["stream_rolled_alerts"] = _sql(
    f"""SELECT alert_id, user_id, window_start, window_end, evidence, count(*) OVER (PARTITION BY window_start) AS alerts_in_minute
    FROM ({_RULE_BODY["R001"]}) WHERE {_CLOSED}""", _RULE_CTES["R001"], base=_STREAM)
ORACLE["stream_user_amount"] = _stream_rule("R002")
ORACLE["stream_device_users"] = _stream_rule("R003")
ORACLE["stream_card_users"] = _stream_rule("R004")
ORACLE["stream_black_device"] = _stream_rule("R006")
ORACLE["stream_consecutive_failure"] = _stream_rule("R005")
ORACLE["stream_user_spike"] = _stream_rule("R007")
ORACLE["stream_merchant_spike"] = _stream_rule("R008")
ORACLE["stream_late_events"] = _sql(
    "SELECT event_id, transaction_id, user_id, process_time FROM ded WHERE is_late", base=_STREAM)
_COUNTED = f"FROM alerts WHERE window_end IS NULL OR {_CLOSED}"
ORACLE["stream_alert_counts"] = _sql(
    f"""SELECT metric_name, minute AS window_start, minute + 60000 AS window_end, count(*) AS n FROM (
      SELECT 'risk_alert_count_1m' AS metric_name, alert_time // 60000 * 60000 AS minute {_COUNTED}
      UNION ALL
      SELECT 'high_risk_alert_count_1m', alert_time // 60000 * 60000 FROM (SELECT * {_COUNTED}) WHERE risk_level = 'HIGH')
    GROUP BY 1, 2""", *_ALERTS, base=_STREAM)


def _stream_metric(metric: str, *ctes: str) -> str:
    return _sql(f"SELECT * EXCLUDE (emit_time) FROM ({metric}) WHERE {_CLOSED}", *ctes, base=_STREAM)


ORACLE["stream_transaction_count"] = _stream_metric(_M_COUNT)
ORACLE["stream_transaction_amount"] = _stream_metric(_M_AMOUNT)
ORACLE["stream_channel_rate"] = _stream_metric(_M_RATE)
ORACLE["stream_merchant_amount"] = _stream_metric(_M_MERCHANT, _RULE_CTES["R008"])
ORACLE["stream_alert_cooldown"] = _sql(
    "SELECT alert_id, rule_id, window_end FROM emitted", *_CTES,
    f"\nalerts AS (SELECT * FROM ({_ALL_ALERTS}) WHERE rule_id IN ('R002', 'R006', 'R007') AND (window_end IS NULL OR {_CLOSED}))",
    _COOLDOWN,
    base=_STREAM).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE["stream_blacklist"] = _sql(_LISTED, _CHANGES, base=_STREAM)
ORACLE["stream_city_topn"] = _sql(
    f"""SELECT * FROM (SELECT city, CAST(amount AS DOUBLE) AS amount, w * 60000 AS window_start, (w + 5) * 60000 AS window_end,
      CAST(row_number() OVER (PARTITION BY w ORDER BY amount DESC, city) AS INT) AS place FROM ca)
    WHERE place <= 3 AND {_CLOSED}""",
    f"\nca AS (SELECT city, w, sum(amount) AS amount FROM (SELECT city, amount, {_windows(5)} AS w FROM paid) GROUP BY 1, 2)", base=_STREAM)
_FIVE = ["R001", "R002", "R005", "R006", "R007"]
ORACLE["stream_features"] = _sql(
    "SELECT user_id, " + ", ".join(f"count(*) FILTER (rule_id = '{r}') AS {r}" if r in _FIVE else f"CAST(0 AS BIGINT) AS {r}" for r in RULE_IDS)
    + f" FROM alerts WHERE user_id IS NOT NULL AND rule_id IN {tuple(_FIVE)} AND (window_end IS NULL OR {_CLOSED}) GROUP BY 1",
    *_ALERTS, base=_STREAM)
