import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.events import as_json, event, frame
from vigilpay.config import stream_config
from vigilpay.operators import prepare, rules
from vigilpay.streaming import state, tables
from vigilpay.streaming.job import RiskStream, text_source


def scenario():
    """Rows by increment: bursts for every rule, a copy, a late row, then a flush far ahead."""
    n, rows = 0, []

    def add(second, **kw):
        nonlocal n
        n += 1
        rows.append(event(n, second, **kw))

    for i in range(12):
        add(i * 3, user_id="user-hf")
    for i in range(7):
        add(90 + i, user_id="user-failed", transaction_status="FAILED")
    for i in range(7):
        add(180 + i * 15, user_id=f"user-d{i}", device_id="device-shared")
    for i in range(5):
        add(300 + i * 20, user_id=f"user-c{i}", card_id="card-shared")
    first, rows = rows, []
    for i in range(7):
        add(420 + i * 10, user_id="user-large", amount=str(5000 + i * 4500), merchant_id="merchant-2")
    for i in range(3):
        add(500 + i, user_id="user-failed", transaction_status="FAILED")
    for i, amount in enumerate([10, 10, 10, 10, 10, 60]):
        add(520 + i, user_id="user-spike", amount=str(amount))
    add(530, is_black_device=True, device_id="device-black")
    add(10, user_id="user-late", is_black_device=True)  # late
    second, rows = rows, []
    add(900, merchant_id="merchant-1", amount="90000.00", user_id="user-m")
    add(7200, user_id="user-flush")
    return first, second, rows


def read_json(folder):
    """Rows of the batches that are published; what is still written is hidden."""
    found = []
    for base, folders, names in os.walk(folder):
        folders[:] = [f for f in folders if not f.startswith(("_", "."))]
        for name in names:
            if name.endswith(".json"):
                with open(os.path.join(base, name)) as f:
                    found += [json.loads(line) for line in f]
    return found


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    root = tmp_path_factory.mktemp("stream")
    source = root / "source"
    source.mkdir()
    cfg = stream_config(f"{root}")
    first, second, third = scenario()
    job = RiskStream(spark, cfg, text_source(spark, str(source)))
    lines = [
        [as_json(r) for r in first] + ["not json", as_json(first[0], process_time="2026-05-10T04:00:00Z")],
        [as_json(first[1], process_time="2026-05-10T04:00:00Z")] + [as_json(r) for r in second],
        [as_json(r) for r in third],
    ]
    for i, chunk in enumerate(lines):
        (source / f"part-{i}.json").write_text("\n".join(chunk))
        job.catch_up()
    return root, first + second + third


def test_same_alerts_as_batch(spark, streamed):
    root, rows = streamed
    on_time = prepare.on_time_events(frame(spark, rows))
    batch = rules.risk_alerts(on_time)
    # windows the flush row itself opens stay open in the stream
    closed = batch.filter(F.col("window_end").isNull() | (F.col("window_end") < "2026-05-10 03:00:00"))
    expected = {(r.rule_id, r.alert_id) for r in closed.collect()}
    stored = read_json(root / "alerts")
    assert {(r["rule_id"], r["alert_id"]) for r in stored} == expected
    assert len(stored) == len(expected)
    assert {r for r, _ in expected} == {f"R00{i}" for i in range(1, 9)}
    evidence = {r["alert_id"]: r["evidence"] for r in stored}
    assert evidence == {r.alert_id: r.evidence for r in closed.collect()}


def test_late_and_dead_letters(streamed):
    root, _ = streamed
    assert [r["user_id"] for r in read_json(root / "late")] == ["user-late"]
    dead = read_json(root / "dead")
    assert [(d["raw_event"], d["error_message"]) for d in dead] == [("not json", "malformed_json")]


def latest(rows):
    """The newest version of each metric; counts only grow."""
    found = {}
    for r in rows:
        key = (r["metric_name"], r["dimensions"] if isinstance(r["dimensions"], str) else json.dumps(r["dimensions"], sort_keys=True), r["window_start"])
        found[key] = max(found.get(key, 0), r["count"])
    return found


def test_metrics(spark, streamed):
    root, rows = streamed
    stored = read_json(root / "metrics")
    names = {r["metric_name"] for r in stored}
    assert names >= {
        "transaction_count_1m", "transaction_amount_5m", "channel_success_rate_5m",
        "merchant_realtime_amount_5m", "risk_alert_count_1m", "high_risk_alert_count_1m",
    }
    counted = sum(r["count"] for r in stored if r["metric_name"] == "transaction_count_1m")
    assert counted == len(rows) - 2  # neither the late row nor the open last minute


def test_every_stored_alert_is_counted(spark, streamed):
    root, _ = streamed
    counts = latest(read_json(root / "metrics"))
    stored = read_json(root / "alerts")
    for name, chosen in (("risk_alert_count_1m", stored), ("high_risk_alert_count_1m", [r for r in stored if r["risk_level"] == "HIGH"])):
        assert sum(n for (metric, *_), n in counts.items() if metric == name) == len(chosen)


def test_all_stages_run_from_empty_folders(spark, tmp_path):
    """Everything starts at once on nothing, gets its files later, and ends with what the batch job finds."""
    source = tmp_path / "source"
    source.mkdir()
    first, second, third = scenario()
    job = RiskStream(spark, stream_config(f"{tmp_path}/out", trigger_seconds=1), text_source(spark, str(source), max_files=1))
    rows = first + second + third
    batch = rules.risk_alerts(prepare.on_time_events(frame(spark, rows)))
    closed = batch.filter(F.col("window_end").isNull() | (F.col("window_end") < "2026-05-10 03:00:00"))
    expected = {r.alert_id for r in closed.collect()}
    running = job.run()
    try:
        assert len(running) == 16
        for i, chunk in enumerate((first, second, third)):
            (source / f".part-{i}").write_text("\n".join(as_json(r) for r in chunk))
            os.rename(source / f".part-{i}", source / f"part-{i}.json")
            time.sleep(2)
        end = time.time() + 240
        while time.time() < end:
            assert not [q.exception() for q in running if q.exception()]
            found = read_json(tmp_path / "out/alerts") if (tmp_path / "out/alerts").exists() else []
            counts = latest(read_json(tmp_path / "out/metrics")) if (tmp_path / "out/metrics").exists() else {}
            counted = sum(n for (name, *_), n in counts.items() if name == "risk_alert_count_1m")
            if {r["alert_id"] for r in found} == expected and counted == len(expected):
                break
            time.sleep(1)
    finally:
        for query in running:
            query.stop()
    found = read_json(tmp_path / "out/alerts")
    assert sorted(r["alert_id"] for r in found) == sorted(expected)
    assert counted == len(expected)
    assert [r["user_id"] for r in read_json(tmp_path / "out/late")] == ["user-late"]
    # the same checkpoints serve a run that catches up
    job.catch_up(["ingest", "route", "consecutive_failure"])
    assert len(read_json(tmp_path / "out/alerts")) == len(found)


def ingested(spark, folder, batches, clock=None):
    """Late and on-time events of a job whose batches are given as lists of JSON lines."""
    source = folder / "source"
    source.mkdir(parents=True)
    job = RiskStream(spark, stream_config(f"{folder}/out"), text_source(spark, str(source)))
    for i, lines in enumerate(batches):
        if clock is not None:
            job.clock = lambda at=clock[i]: at
        (source / f"part-{i}.json").write_text("\n".join(lines))
        job.catch_up(["ingest", "route"])
    on_time = spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/out/checkpoint/tables/on_time")
    late = read_json(folder / "out/late") if (folder / "out/late").exists() else []
    return sorted((r["event_id"], r["arrival_seq"]) for r in on_time.collect()), sorted(r["event_id"] for r in late)


def test_lateness_does_not_depend_on_the_batches(spark, tmp_path):
    seconds = [0, 100, 39, 40, 41, 200, 139, 140, 90, 260, 199, 200]
    lines = [as_json(event(i, s)) for i, s in enumerate(seconds)]
    want = {f"evt-{i:06d}" for i, s in enumerate(seconds) if i and s < max(seconds[:i]) - 60}
    one = ingested(spark, tmp_path / "one", [lines])
    many = ingested(spark, tmp_path / "many", [lines[i : i + 3] for i in range(0, 12, 3)])
    assert one == many and set(one[1]) == want
    assert [seq for _, seq in sorted(many[0], key=lambda r: r[1])] == [i for i in range(12) if f"evt-{i:06d}" not in want]


def test_ids_are_remembered_for_a_day(spark, tmp_path):
    hour = 3_600_000
    copy = lambda n, i: as_json(event(n, 10 + i, process_time=f"2026-05-10T05:00:0{i}Z"))
    batches = [
        [copy(1, 0), copy(1, 1), copy(2, 0)],  # two copies in one batch: the first arrival
        [copy(1, 2)],  # 23 hours later
        [copy(1, 3), copy(1, 4)],  # 25 hours after the first sight
        [copy(1, 5)],  # 23 hours after that
    ]
    on_time, late = ingested(spark, tmp_path, batches, clock=[0, 23 * hour, 25 * hour, 48 * hour])
    first, second = event(1)["event_id"], event(2)["event_id"]
    assert on_time == [(first, 0), (first, 4), (second, 2)] and late == []


class FakeState:
    def __init__(self, value=None, now=0, timed_out=False):
        self.value, self.now, self.hasTimedOut, self.timeout = value, now, timed_out, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def getCurrentProcessingTimeMs(self):
        return self.now

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def fold_of(build, spark, schema, *args):
    """The function that a stateful operator gives to Spark."""
    kept = {}

    class Rows:
        def __init__(self, schema):
            self.schema = schema

        def groupBy(self, key):
            return self

        def applyInPandasWithState(self, fold, *rest):
            kept["fold"] = fold

    build(Rows(spark.createDataFrame([], schema).schema), *args)
    return kept["fold"]


def test_state_is_forgotten_and_does_not_wrap(spark):
    fold = fold_of(lambda rows: state.amount_history(rows, "user_id", "arrival_seq", 0, 1000), spark, "user_id string, arrival_seq long, cents long")
    big = 10**18 - 1
    given = FakeState(now=5)
    out = pd.concat(fold(("u",), iter([pd.DataFrame({"arrival_seq": range(20), "cents": [big] * 20})]), given))
    assert out["history_cents"].tolist()[-1] == str(19 * big)
    assert given.timeout == 1000 and given.value == (20, str(20 * big), 5)
    # read again after its time to live
    old = FakeState(value=given.value, now=1006)
    out = pd.concat(fold(("u",), iter([pd.DataFrame({"arrival_seq": [30], "cents": [7]})]), old))
    assert out["history_count"].tolist() == [0] and old.value == (1, "7", 1006)
    gone = FakeState(value=old.value, timed_out=True)
    assert list(fold(("u",), iter([]), gone)) == [] and not gone.exists
    failures = fold_of(lambda rows: state.failure_runs(rows, 2, 1000), spark, "user_id string, arrival_seq long, failed boolean")
    run = FakeState(now=0)
    out = pd.concat(failures(("u",), iter([pd.DataFrame({"arrival_seq": [1], "failed": [True]})]), run))
    assert run.exists and len(out) == 0
    run.hasTimedOut = True
    assert list(failures(("u",), iter([]), run)) == [] and not run.exists


def test_a_batch_is_published_once_and_whole(spark, tmp_path):
    path, rows = f"{tmp_path}/table", spark.range(5).selectExpr("id AS n")
    hidden = tmp_path / "table/_writing-000000000000"
    hidden.mkdir(parents=True)
    (hidden / "part-half.parquet").write_text("cut off")  # a batch that failed while it was written
    tables.write_batch(rows, path, 0)
    tables.write_batch(rows.union(rows), path, 0)  # and runs again
    tables.write_batch(rows.limit(0), path, 1)
    assert sorted(p.name for p in (tmp_path / "table").iterdir() if not p.name.startswith(".")) == ["batch-000000000000"]
    seen = []
    query = tables.stream(spark, path, rows.schema).writeStream.foreachBatch(lambda df, i: seen.extend(df.collect())).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.n for r in seen) == list(range(5))


def test_rules_and_lists_are_read_for_every_batch(spark, tmp_path):
    source, table, listed = tmp_path / "source", f"{tmp_path}/rules", f"{tmp_path}/devices"
    source.mkdir()
    job = RiskStream(
        spark, stream_config(f"{tmp_path}/out", rule_table=table, device_list=listed), text_source(spark, str(source))
    )
    batches = [(2.0, "device-1"), (9.0, "device-9")]
    for i, (failures, device) in enumerate(batches):
        spark.createDataFrame([(i, "R005", failures)], "version int, rule_id string, threshold double").write.mode("overwrite").parquet(table)
        spark.createDataFrame([(device,)], "device_id string").write.mode("overwrite").parquet(listed)
        rows = [event(10 * i + k, 10 * i + k, user_id=f"user-{i}", transaction_status="FAILED", device_id=f"device-{10 * i + k}") for k in range(3)]
        (source / f"part-{i}.json").write_text("\n".join(as_json(r) for r in rows))
        job.catch_up(["ingest", "route", "black_device", "consecutive_failure"])
    found = sorted((r["rule_id"], r["event_id"]) for r in read_json(tmp_path / "out/alerts"))
    # two in a row in the first batch, nine asked for in the second; only device-1 was listed in time
    assert found == [("R005", "evt-000001"), ("R005", "evt-000002"), ("R006", "evt-000001")]


def test_a_lost_progress_row_is_an_error(spark, tmp_path):
    job = RiskStream(spark, stream_config(f"{tmp_path}"), None)
    with pytest.raises(RuntimeError, match="no progress of batch 6"):
        job._progress(7)
