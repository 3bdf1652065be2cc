import pytest
from pyspark.sql import functions as F

from tests.events import event, frame
from vigilpay import schemas, session
from vigilpay.config import stream_config
from vigilpay.functions.ids import name_uuid
from vigilpay.functions.scores import risk_score
from vigilpay.operators import alerts, aml, dashboard, extensions as ext, rules
from vigilpay.plans import catalog
from vigilpay.sources import files, kafka

GOLDEN_IDS = {
    "R006|evt-test-001": "77bb3a61-1c30-36c9-bbdb-307478e88a7d",
    "R006|evt-sample-003": "26b202ff-c897-3fdf-859e-274111566021",
    "R001|user_id|user-demo-hf|1778378400000|1778378460000": "e215ec72-bc0e-3528-aceb-ad5e401c2d8f",
    "R004|card_id|card-demo-shared|1778378400000|1778379000000": "0ebd0521-da5f-3ec0-9210-972ca934317e",
}


def test_alert_ids(spark):
    rows = spark.createDataFrame([(k,) for k in GOLDEN_IDS], "k string").select("k", name_uuid(F.col("k")).alias("id"))
    assert {r.k: r.id for r in rows.collect()} == GOLDEN_IDS


AML = dict(
    record_key="sample-record", timestamp="2022-09-01T00:08:00Z", from_bank="Savings Bank of Madison",
    from_account="8000ECA90", from_country="US", to_bank="Savings Bank of Madison", to_account="8000ECA90",
    to_country="US", amount_received="3195403.0", receiving_currency="USD", amount_paid="3195403.0",
    payment_currency="USD", payment_format="Reinvestment", is_laundering="True", predicted_alert="True",
    model_score="0.991", is_dashboard_sample="False",
)


def test_aml_row(spark):
    row = aml.to_transactions(spark.createDataFrame([tuple(AML.values())], schemas.AML_ROW)).first().asDict()
    expected = dict(
        event_id="evt-aml-4a7ccbbe936da1c66a816695", transaction_id="txn-aml-4a7ccbbe936da1c66a816695",
        user_id="user-b8f0b6b397", account_id="acct-8000ECA90", card_id="card-74c5063454fa",
        merchant_id="merchant-2866d73dcc6c", device_id="device-1ee7c6beeeb8", ip="10.36.36.127",
        transaction_status="SUCCESS", channel="H5", app_version="7.5.6", event_time="2022-09-01T00:08:00Z",
        process_time="2022-09-01T00:58:06Z", province="California", city="San Francisco", currency="USD",
        payment_method="BANK_CARD", transaction_type="TRANSFER", risk_label="AML_LAUNDERING",
        is_black_device=True, is_black_card=True,
    )
    assert float(row.pop("amount")) == 3195403.0
    assert row == expected


def test_risk_score(spark):
    cases = [(128.5, False, "NORMAL", 39.09), (0.5, False, None, 18.00), (899.0, False, "NORMAL", 47.54),
             (899.0, True, "ODD", 77.54)]
    rows = spark.createDataFrame(cases, "a double, b boolean, l string, want double")
    scored = rows.select("want", risk_score(F.col("a"), F.col("b"), F.lit(False), F.col("l"), F.lit("SUCCESS")).alias("got"))
    assert all(float(r.got) == r.want for r in scored.collect())


@pytest.mark.parametrize("skip, limit", [(0, 0), (0, 5), (7, 0), (25, 30), (58, 9)])
def test_csv_rows_by_position(spark, tmp_path, skip, limit):
    keys = []
    for part in range(3):
        lines = [",".join(AML)]
        for i in range(20):
            keys.append(f"{part}-{i}")
            lines.append(",".join({**AML, "record_key": keys[-1]}.values()))
        (tmp_path / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    got = {r.record_key for r in files.read_aml_csv(spark, str(tmp_path), skip, limit).collect()}
    assert got == set(keys[skip:skip + limit] if limit else keys[skip:])


def test_json_lines_skip_what_is_not_data(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "part-0").write_text('{"event_id":"a"}\n\n# note\n{broken\n{"event_id":"b"}\n')
    (tmp_path / "README.md").write_text('{"event_id":"c"}\n')
    (tmp_path / "part-1.inprogress").write_text('{"event_id":"d"}\n')
    got = files.read_json_lines(spark, str(tmp_path), schemas.TRANSACTION_TEXT).collect()
    assert sorted(r.event_id for r in got) == ["a", "b"]
    assert files.read_json_lines(spark, str(tmp_path), schemas.TRANSACTION_TEXT, limit=1).count() == 1


def test_json_sink_and_table(spark, tmp_path):
    path = str(tmp_path / "alerts")
    files.write_json_lines(rules.r006_black_device(frame(spark, [event(1, is_black_device=True)])), path)
    row = spark.read.json(path).first()
    assert row.alert_id and row.rule_id == "R006" and isinstance(row.alert_time, int)
    events = str(tmp_path / "events")
    files.write_json_lines(frame(spark, [event(1), event(2)]).select(*schemas.TRANSACTION_FIELDS), events)
    assert files.register_dwd_transactions(spark, "dwd_test", events).count() == 2
    spark.sql("DROP TABLE dwd_test")


def test_upsert_takes_only_evidence_and_time(spark):
    old = rules.r006_black_device(frame(spark, [event(1, is_black_device=True), event(2, is_black_device=True)]))
    new = rules.r006_black_device(frame(spark, [event(2, 9, is_black_device=True), event(3, is_black_device=True)]))
    new = new.withColumn("reason", F.lit("x")).withColumn("evidence", F.create_map(F.lit("k"), F.lit("v")))
    got = {r.event_id: r for r in alerts.upsert(old, new).collect()}
    assert sorted(got) == ["evt-000001", "evt-000002", "evt-000003"]
    assert got["evt-000002"].reason != "x" and got["evt-000002"].evidence == {"k": "v"}
    assert got["evt-000002"].alert_time.second == 9 and got["evt-000003"].reason == "x"


def test_kafka_frames(spark):
    rows = [event(1), event(2, user_id=""), event(3, user_id=None, device_id="")]
    got = kafka.keyed_records(frame(spark, rows), F.lit("now")).collect()
    assert sorted(r.key for r in got) == ["device-2", "evt-000003", "user-1"]
    options = kafka.source_options(stream_config("/unused"))
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "payment_transaction_events"
    records = spark.createDataFrame(
        [(bytearray(b"b"), 5, 2000, 10), (bytearray(b"a"), 900, 3, 9)], "value binary, offset long, partition int, timestamp long"
    )
    # by the time in the log, whatever the partition and its offsets
    assert [r.value for r in kafka.raw_transactions(records).orderBy("arrival_order").collect()] == ["a", "b"]


def test_empty_dashboard(spark):
    nothing = frame(spark, [])
    assert dashboard.time_series(nothing).count() == 0
    assert dashboard.risk_scatter(nothing).count() == 0
    assert dashboard.flow_links(nothing).count() == 0


def test_csv_quotes_and_header_names(spark, tmp_path):
    names = schemas.AML_ROW.names
    moved = [names[3], names[0]] + [n for n in names if n not in (names[3], names[0])]
    values = {n: f"v-{n}" for n in names} | {names[2]: 'Foo ""Bar"" Ltd'}
    text = ",".join(moved) + "\n" + ",".join(f'"{values[n]}"' for n in moved) + "\n"
    (tmp_path / "rows.csv").write_text(text)
    row = files.read_aml_csv(spark, f"{tmp_path}/rows.csv").first().asDict()
    assert row == {n: values[n].replace('""', '"') for n in names}
    short = [n for n in names if n != names[5]]
    (tmp_path / "short.csv").write_text(",".join(short) + "\n" + ",".join("x" for _ in short) + "\n")
    assert files.read_aml_csv(spark, f"{tmp_path}/short.csv").first()[names[5]] is None


def test_csv_skip_and_limit(spark, tmp_path):
    rows = [tuple(f"{n}{i:03d}" for n in schemas.AML_ROW.names) for i in range(300)]
    df = spark.createDataFrame(rows, schemas.AML_ROW)
    files.write_aml_csv(df.orderBy(df.columns[0]), f"{tmp_path}/rows")
    got = files.read_aml_csv(spark, f"{tmp_path}/rows", skip=40, limit=25)
    assert sorted(map(tuple, got.collect())) == rows[40:65]


def test_csv_query_returns_the_whole_file(spark, monkeypatch):
    rows = [tuple(f"{n}{i:03d}" for n in schemas.AML_ROW.names) for i in range(300)]
    monkeypatch.setattr(catalog.adapter, "aml_rows", lambda *_: spark.createDataFrame(rows, schemas.AML_ROW))
    assert sorted(map(tuple, catalog.QUERIES["source_aml_csv"](spark, "").collect())) == rows
    assert sorted(map(tuple, catalog.QUERIES["source_aml_csv_part"](spark, "").collect())) == rows[100:]


def test_aml_numbers(spark):
    texts = ["5d", "nan", "inf", "-Infinity", "1e400", " 12.5 ", "-3", ".5", "1e3", "0x10", "", None, "7."]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(aml.parse_float(F.col("t"))).collect()
    assert [r[0] for r in got] == [0, 0, 0, 0, 0, 12.5, -3, 0.5, 1000, 0, 0, 0, 7]


def test_aml_amounts_that_do_not_fit_are_set_aside(spark):
    base = {n: "1" for n in schemas.AML_ROW.names} | {"timestamp": "2022-09-01T00:08:00Z", "is_laundering": "True"}
    amounts = ["1e20", "49999.996", "50000"]
    rows = [tuple({**base, "record_key": a, "amount_paid": a}[n] for n in schemas.AML_ROW.names) for a in amounts]
    df = spark.createDataFrame(rows, schemas.AML_ROW)
    assert [r.record_key for r in aml.unmappable(df).collect()] == ["1e20"]
    flags = {str(r.amount): r.is_black_card for r in aml.to_transactions(df).collect()}
    assert sorted(aml.to_transactions(df).select("is_black_card").collect()) == [(False,), (True,)]
    assert set(flags) == {"50000.00"}  # both round to it, one is below the limit


def test_rule_table_with_all_rules(spark):
    table = spark.createDataFrame(
        [(1, "R006", 1.0), (2, "R006", 0.0), (1, "R001", 12.0), (3, "R007.min_samples", 9.0), (1, "R999", 4.0)],
        "version int, rule_id string, threshold double",
    )
    cfg = ext.rules_from_config(table)
    assert (cfg.user_txn_count, cfg.user_spike_min_samples, cfg.version) == (12, 9, 3)


def test_cooldown_counts_from_the_emitted_alert(spark):
    from vigilpay.config import R001

    minutes = [0.0, 9.99, 10.0, 15.0, 20.0, 20.5, 29.99, 31.0]
    rows = [(f"a{i}", R001.rule_id, "u", m) for i, m in enumerate(minutes)] + [("b", R001.rule_id, "w", 9.99)]
    alerts = spark.createDataFrame(rows, "alert_id string, rule_id string, user_id string, m double").select(
        "alert_id", "rule_id", "user_id", *[F.lit(None).cast("string").alias(c) for c in ("device_id", "card_id", "merchant_id")],
        F.timestamp_millis((F.col("m") * 60000).cast("bigint")).alias("alert_time"),
    )
    got = sorted(r.alert_id for r in ext.alert_cooldown(alerts).collect())
    assert got == ["a0", "a2", "a4", "a7", "b"]


def test_shared_folder_is_required_off_a_local_master(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_convert_file_counts_what_was_skipped(spark, tmp_path):
    from vigilpay.operators import convert, dashboard
    from vigilpay.schemas import AML_ROW

    rows = spark.createDataFrame([(str(i), "2022-09-01T00:08:00Z", *["1"] * (len(AML_ROW.names) - 2)) for i in range(6)], AML_ROW)
    source = f"{tmp_path}/in"
    files.write_aml_csv(rows.coalesce(1), source)
    size = sum(p.stat().st_size for p in (tmp_path / "in").iterdir())
    for skip, done, skipped in ((0, 6, 0), (4, 2, 4), (9, 0, 6)):
        left = files.read_aml_csv(spark, source, skip=skip)
        row = convert.convert_file(source, f"{tmp_path}/out{skip}", left, skip).first()
        assert (row.converted_rows, row.skipped_rows) == (done, skipped)
        assert 0 < row.source_size_bytes <= size
    whole = convert.convert_file(source, f"{tmp_path}/again", files.read_aml_csv(spark, source))
    events = frame(spark, [event(1)])
    shown = dashboard.overview(events, rules_alerts(spark), events.limit(0), whole).first()
    assert shown.enterprise_source_size_bytes == whole.first().source_size_bytes


def rules_alerts(spark):
    from vigilpay.operators import rules

    return rules.r006_black_device(frame(spark, [event(1, is_black_device=True)]))


def test_first_merge_keeps_the_latest_and_later_ones_touch_their_days(spark, tmp_path):
    from vigilpay.operators import alerts as al, rules

    day = 86_400
    rows = [event(i, i * day, is_black_device=True, device_id=f"d{i}") for i in range(3)]
    found = rules.r006_black_device(frame(spark, rows))
    path = f"{tmp_path}/alerts"
    older = found.withColumn("alert_time", F.col("alert_time") - F.expr("INTERVAL 1 HOUR")).withColumn("reason", F.lit("older"))
    al.merge_into(path, older.unionByName(found))
    stored = spark.read.parquet(path)
    assert stored.count() == 3 and stored.filter("reason = 'older'").count() == 0
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    today = found.filter(F.col("event_id") == rows[2]["event_id"]).withColumn("alert_time", F.col("alert_time") + F.expr("INTERVAL 1 HOUR"))
    al.merge_into(path, today)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    # files of the other two days are the same
    assert len(set(before.items()) & set(after.items())) == 2
    assert spark.read.schema(stored.schema).parquet(path).count() == 3
