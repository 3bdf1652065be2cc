import random

import pytest
from pyspark.sql import functions as F

from tests.events import as_json, event, frame
from vigilpay.operators import dashboard, prepare, scans, validate


def late_ids(spark, rows):
    return sorted(r.event_id for r in prepare.late_events(frame(spark, rows)).collect())


def test_late_is_strictly_behind(spark):
    rows = [event(1, 100), event(2, 40), event(3, 39.999)]
    assert late_ids(spark, rows) == ["evt-000003"]
    assert late_ids(spark, [event(1, -9999)]) == []


def test_first_copy_wins_and_a_late_one_uses_up_the_id(spark):
    copy = event(1, 5, arrival_seq=9, process_time="2026-05-10T09:00:00Z")
    kept = prepare.dedup(frame(spark, [copy, event(1, 5)])).collect()
    assert [r.process_time for r in kept] == ["2026-05-10T03:00:00Z"]
    rows = [event(1, 500), event(2, 0), event(2, 480, arrival_seq=3)]
    assert late_ids(spark, rows) == ["evt-000002"]
    assert [r.event_id for r in prepare.on_time_events(frame(spark, rows)).collect()] == ["evt-000001"]


@pytest.mark.parametrize("block_bits, group_bits", [(2, 1), (4, 2), (16, 12)])
def test_watermark_in_blocks(spark, block_bits, group_bits):
    rng = random.Random(block_bits)
    rows = [event(n, rng.randint(0, 3000)) for n in rng.sample(range(500), 200)]
    got = prepare.with_watermark(frame(spark, rows), 60, block_bits, group_bits).collect()
    newest, expected = None, {}
    for r in sorted(rows, key=lambda r: r["arrival_seq"]):
        expected[r["event_id"]] = newest
        newest = max(newest or r["event_ts"], r["event_ts"])
    found = {r.event_id: r.watermark_ts and r.watermark_ts.timestamp() + 60 for r in got}
    assert found == {k: v and v.timestamp() for k, v in expected.items()}


def test_ranks_picked(spark):
    rng = random.Random(7)
    values = rng.sample(range(5000), 317)
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    for every, first, limit in [(1, 1, 400), (9, 9, 36), (7, 1, 20), (400, 400, 5)]:
        levels = [F.shiftright("v", 8), F.shiftright("v", 4), F.col("v")]
        got = scans.ranks_picked(rows, levels, every, first, limit).collect()
        wanted = [first + j * every for j in range(limit) if first + j * every <= len(values)]
        ordered = sorted(values)
        assert sorted((r._rank, r._l2) for r in got) == [(w, ordered[w - 1]) for w in wanted]


def test_time_series_with_a_hot_instant(spark):
    # a third of all rows share one instant, and chunks still hold equal counts
    rows = [event(n, 0 if n % 3 == 0 else n) for n in range(100)]
    got = sorted(dashboard.time_series(frame(spark, rows), 9).collect(), key=lambda r: r.chunk)
    assert [r["count"] for r in got] == [12] * 8 + [4]
    assert dashboard.time_series(frame(spark, rows[:2]), 36).count() == 2


REJECTS = [
    (dict(user_id="   "), "missing_required_field"),
    (dict(user_id=None), "missing_required_field"),
    (dict(channel=""), "missing_enum_field"),
    (dict(amount=-0.01), "negative_amount"),
    (dict(amount="NaN"), "bad_amount"),
    (dict(event_time="2026-05-10"), "bad_event_time"),
    (dict(event_time="2026-05-10 02:00:00Z"), "bad_event_time"),
    (dict(amount=0), None),
    (dict(amount="12.5"), None),
    (dict(channel="FAX"), None),
    (dict(extra=1), None),
    (dict(account_id=None, currency=None), None),
]


def test_reject_reasons(spark):
    lines = [as_json(event(1), **change) for change, _ in REJECTS] + ["{oops", "null", "", "[1]"]
    raw = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    got = {r.n: r.reject_reason for r in validate.parse_transactions(raw).collect()}
    expected = [reason for _, reason in REJECTS] + ["malformed_json"] * 4
    assert [got[i] for i in range(len(lines))] == expected


def test_missing_amount_and_flags_have_defaults(spark):
    import json

    body = json.loads(as_json(event(1)))
    for name in ("amount", "is_black_device", "is_black_card"):
        del body[name]
    raw = spark.createDataFrame([(json.dumps(body),)], "value string")
    row = validate.valid_events(validate.parse_transactions(raw)).first()
    assert (row.amount, row.is_black_device, row.is_black_card) == (0, False, False)


def test_contract_is_stricter_than_parsing(spark):
    lines = [as_json(event(1)), as_json(event(1), channel="FAX"), as_json(event(1), currency="USD", amount="1")]
    raw = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    got = {(r.n, r.field, r.rule) for r in validate.schema_violations(raw).collect()}
    assert got == {(1, "channel", "enum"), (2, "currency", "enum"), (2, "amount", "type")}


def test_hot_id_is_cut_before_the_shuffle(spark):
    plan = prepare.dedup(frame(spark, [event(1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
