"""Every operator as a query over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vigilpay import config, schemas, session
from vigilpay.config import RuleConfig, stream_config
from vigilpay.functions import ids, times
from vigilpay.operators import (
    alerts as al, aml, convert, dashboard as dash, extensions as ext, lists, metrics as mt, prepare, replay, rules,
    scans, serving, validate, versions, windows,
)
from vigilpay.sources import adapter, files, kafka
from vigilpay.streaming import features, job, rolling, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOPIC = "payment_transaction_events"


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(session.configure(spark), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Instants as epoch milliseconds, decimals as doubles, maps as JSON text."""
    def one(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = times.millis(c)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.MapType):
            c = F.to_json(c)
        return c.alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


# --- inputs shared by the queries --------------------------------------------

def arrivals(spark, sf) -> DataFrame:
    return adapter.arrivals(spark, sf)


def on_time(spark, sf) -> DataFrame:
    return prepare.on_time_events(arrivals(spark, sf))


def staged(spark, sf) -> DataFrame:
    """On-time events written once, for queries that read them several times."""
    return session.stage(on_time(spark, sf), "on_time")


def _with_amounts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """On-time events and merchant windows, each worked out once."""
    events = staged(spark, sf)
    return events, session.stage(windows.merchant_window_amount(prepare.successful_payments(events)), "merchant-windows")


def _metrics(spark, sf) -> DataFrame:
    events, amounts = _with_amounts(spark, sf)
    return mt.realtime_metrics(events, session.stage(rules.risk_alerts(events, merchant_windows=amounts), "alerts"), amounts)


def alerts(spark, sf) -> DataFrame:
    return rules.risk_alerts(staged(spark, sf))


def staged_alerts(spark, sf) -> DataFrame:
    return session.stage(alerts(spark, sf), "alerts")


def merchant_windows(spark, sf) -> DataFrame:
    return windows.merchant_window_amount(prepare.successful_payments(on_time(spark, sf)))


def late(spark, sf) -> DataFrame:
    return prepare.late_events(arrivals(spark, sf))


def parsed(spark, sf) -> DataFrame:
    return validate.parse_transactions(adapter.raw_lines(spark, sf))


def aml_events(spark, sf) -> DataFrame:
    return aml.to_transactions(adapter.aml_rows(spark, sf))


def dead(spark, sf) -> DataFrame:
    return validate.dead_letters(parsed(spark, sf), TOPIC, F.col("arrival_ts"))


# --- sources, sinks, tables ----------------------------------------------------

@query("source_jsonl")
def _(spark, sf):
    no = F.col("event_no")
    lines = adapter.raw_lines(spark, sf).withColumn(
        "value",
        F.when(no % 19 == 0, F.concat(F.lit("  # "), "value")).when(no % 23 == 0, "   ").otherwise(F.col("value")),
    )
    rows = files.parse_json_lines(lines, schemas.TRANSACTION_TEXT)
    amount = F.nanvl(F.col("amount").cast("double"), F.lit(None))
    return rows.select(*[c for c in schemas.TRANSACTION_FIELDS if c != "amount"], amount.alias("amount"))


@query("source_dir_filter")
def _(spark, sf):
    """Lines of the data files of a folder, beside files with endings that are never data."""
    path = session.new_dir(spark, "mixed")
    lines = adapter.raw_lines(spark, sf).select("value")
    lines.write.text(f"{path}/good/deep")
    hadoop = spark._jvm.org.apache.hadoop.fs
    for ending in ("md", "crc", "inprogress", "MD"):
        lines.limit(5).coalesce(1).write.text(f"{path}/{ending}")
        place = hadoop.Path(f"{path}/{ending}/part-*")
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(place):
            system.rename(found.getPath(), hadoop.Path(f"{path}/{ending}/notes.{ending}"))
    event_id = F.get_json_object("value", "$.event_id").alias("event_id")
    return files.text_lines(spark, path).groupBy(event_id).agg(F.count(F.lit(1)).alias("n"))


@query("sink_alert_table")
def _(spark, sf):
    """Alerts as the serving table stores them."""
    rows = files.alerts_table(alerts(spark, sf), F.col("alert_time"))
    return rows


@query("source_aml_csv")
def _(spark, sf):
    path = session.new_dir(spark, "aml_csv")
    files.write_aml_csv(adapter.aml_rows(spark, sf), path)
    rows = files.read_aml_csv(spark, path)
    return rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in rows.columns])


@query("source_aml_csv_part")
def _(spark, sf):
    """A part of the file, as a conversion that is picked up in the middle reads it."""
    path = session.new_dir(spark, "aml_csv")
    rows = adapter.aml_rows(spark, sf)
    files.write_aml_csv(files.in_order(rows, *rows.columns), path)
    rows = files.read_aml_csv(spark, path, skip=100, limit=5000)
    return rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in rows.columns])


@query("convert_file")
def _(spark, sf):
    """A conversion that leaves out the first rows, from file to JSON lines, and its summary."""
    path = session.new_dir(spark, "aml_csv")
    rows = adapter.aml_rows(spark, sf)
    files.write_aml_csv(files.in_order(rows, *rows.columns), path)
    kept = files.read_aml_csv(spark, path, skip=100)
    return convert.convert_file(path, session.new_dir(spark, "converted"), kept, 100).drop("source_size_bytes")


@query("table_dwd_transactions")
def _(spark, sf):
    path = session.new_dir(spark, "dwd")
    files.write_json_lines(aml_events(spark, sf), path)
    table = files.register_dwd_transactions(spark, f"dwd_{uuid.uuid4().hex}", path)
    return table.groupBy("channel", "risk_label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )


@query("sink_jsonl")
def _(spark, sf):
    path = session.new_dir(spark, "alerts_json")
    files.write_json_lines(alerts(spark, sf), path)
    return files.read_json_lines(spark, path, schemas.ALERT_JSON)


def _two_runs(spark, sf):
    """Stored alerts and a later run over the same events: new times, changed evidence."""
    first = staged_alerts(spark, sf)
    later = first.withColumn("alert_time", F.col("alert_time") + F.expr("INTERVAL 1 HOUR"))
    later = later.withColumn("reason", F.lit("changed")).withColumn(
        "evidence", F.map_concat("evidence", F.create_map(F.lit("run"), F.lit("2")))
    )
    return first, later


@query("sink_alert_upsert")
def _(spark, sf):
    stored, later = _two_runs(spark, sf)
    some = F.conv(F.substring("alert_id", 1, 1), 16, 10).cast("int")
    # half the alerts are known, and the later run finds others again or anew
    return al.upsert(stored.filter(some < 8), later.filter(some >= 4))


@query("sink_alert_merge")
def _(spark, sf):
    """The same two runs, merged into a stored table day by day, the second one twice."""
    stored, later = _two_runs(spark, sf)
    some = F.conv(F.substring("alert_id", 1, 1), 16, 10).cast("int")
    path = session.new_dir(spark, "alert_table")
    # the first merge has every alert twice, the older one with another text
    older = stored.withColumn("alert_time", F.col("alert_time") - F.expr("INTERVAL 1 HOUR")).withColumn("reason", F.lit("older"))
    al.merge_into(path, stored.unionByName(older).filter(some < 8))
    for _ in range(2):
        al.merge_into(path, later.filter(some >= 4))
    return spark.read.parquet(path).drop("day")


@query("sink_alert_dedup_latest")
def _(spark, sf):
    stored, later = _two_runs(spark, sf)
    return al.latest(stored.unionByName(later)).select("alert_id", "rule_id", "alert_time", "reason")


@query("check_alert_uniqueness")
def _(spark, sf):
    stored, later = _two_runs(spark, sf)
    return al.uniqueness_violations(stored.unionByName(later))


@query("sink_table_mapping")
def _(spark, sf):
    rows = mt.merchant_amount_5m(merchant_windows(spark, sf))
    return files.metrics_table(rows, F.col("emit_time"))


@query("late_store")
def _(spark, sf):
    rows = files.late_table(late(spark, sf), F.try_to_timestamp("process_time"))
    # the stored text, field by field
    field = lambda name: F.get_json_object("raw_event", f"$.{name}")
    names = [n for n in schemas.TRANSACTION_FIELDS if n != "amount"]
    texts = F.concat_ws("|", field("amount").cast("decimal(18,2)").cast("string"), *[field(n) for n in names])
    return rows.withColumn("raw_event", texts)


@query("late_replay")
def _(spark, sf):
    flagged = session.stage(prepare.flag_late(arrivals(spark, sf)), "flagged")
    good = flagged.filter(~F.col("is_late")).drop("is_late")
    behind = flagged.filter("is_late").drop("is_late")
    known = al.union_alerts(
        rules.r001_user_frequency(good), rules.r002_user_amount(good),
        rules.r003_device_users(good), rules.r004_card_users(good),
    )
    return ext.late_replay(good, behind, known).select("alert_id", "rule_id", "window_start", "evidence")


def _late_and_not(spark, sf):
    flagged = session.stage(prepare.flag_late(arrivals(spark, sf)), "flagged")
    return flagged.filter(~F.col("is_late")).drop("is_late"), flagged.filter("is_late").drop("is_late")


@query("late_replay_users")
def _(spark, sf):
    """The two rules that follow a user, taken up where a late event belongs."""
    good, behind = _late_and_not(spark, sf)
    cfg, hot = RuleConfig(consecutive_failures=2), session.stage(_hot_users(spark, sf), "hot-users")
    known = rules.r005_consecutive_failure(good, cfg, hot).unionByName(rules.r007_user_amount_spike(good, cfg, hot))
    known = session.stage(known, "alerts")
    done = replay.replay_payments(good, behind, replay.replay_failures(good, behind, known, cfg, hot), cfg, hot)
    return done.select("alert_id", "rule_id", "event_id", "user_id", "evidence")


def _replayed(spark, sf):
    good, behind = _late_and_not(spark, sf)
    hot = session.stage(_hot_users(spark, sf), "hot-users")
    amounts = session.stage(windows.merchant_window_amount(prepare.successful_payments(good)), "merchant-windows")
    known = session.stage(rules.risk_alerts(good, hot_users=hot, merchant_windows=amounts), "alerts")
    after = session.stage(replay.replay_alerts(good, behind, known, amounts, hot=hot), "alerts-replayed")
    return good, behind, amounts, known, after


@query("late_replay_all")
def _(spark, sf):
    """All alerts as if no event had been late, withdrawn ones gone."""
    return _replayed(spark, sf)[-1].select("alert_id", "rule_id", "event_id", "window_start", "evidence")


@query("metric_replay")
def _(spark, sf):
    """All metrics as if no event had been late, from stored ones and differences."""
    good, behind, amounts, known, after = _replayed(spark, sf)
    stored = session.stage(mt.realtime_metrics(good, known, amounts), "metrics")
    return replay.metric_replay(stored, behind, known, after)


@query("publish_keyed")
def _(spark, sf):
    events = arrivals(spark, sf)
    no = F.col("arrival_seq")
    events = events.withColumn("user_id", F.when(no % 5 == 0, "").otherwise(F.col("user_id")))
    events = events.withColumn("device_id", F.when(no % 7 != 0, F.col("device_id")))
    records = kafka.keyed_records(events, F.lit("2026-01-01T00:00:00Z"))
    value = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return records.select("key", value("event_id"), value("process_time"))


@query("convert_metadata")
def _(spark, sf):
    return aml.conversion_summary(aml_events(spark, sf))


# --- parse and validate ----------------------------------------------------------

@query("parse_transactions")
def _(spark, sf):
    return validate.valid_events(parsed(spark, sf)).select(
        "arrival_seq", *schemas.TRANSACTION_FIELDS, "event_ts"
    )


def _rejected(*reasons):
    def run(spark, sf):
        return parsed(spark, sf).filter(F.col("reject_reason").isin(*reasons)).select(
            "event_no", "arrival_seq", "reject_reason"
        )

    return run


query("validate_required")(_rejected("missing_required_field"))
query("validate_enums_present")(_rejected("missing_enum_field"))
query("validate_amount")(_rejected("negative_amount", "bad_amount"))


@query("dead_letter")
def _(spark, sf):
    rows = dead(spark, sf)
    return rows.select(
        "topic", F.get_json_object("raw_event", "$.event_id").alias("event_id"),
        F.length("raw_event").alias("raw_length"), "error_message", "created_at",
    ).withColumn("raw_length", F.when(F.col("error_message") == "malformed_json", F.col("raw_length")))


@query("event_time_parse")
def _(spark, sf):
    text = F.get_json_object("value", "$.event_time")
    return adapter.raw_lines(spark, sf).select(
        "arrival_seq", text.alias("event_time"), times.parse_instant(text).alias("event_ts")
    )


def user_event_lines(spark, sf):
    kinds = {"click": "LOGIN", "view": "LOGOUT", "signup": "BIND_CARD", "purchase": "CHANGE_DEVICE"}
    pairs = [F.lit(x) for kv in kinds.items() for x in kv]
    no, user = F.col("event_id"), F.col("user_id")
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    return adapter.read_table(spark, sf, "events").select(
        no.alias("event_no"),
        F.to_json(F.struct(
            text("uevt-", no).alias("event_id"), text("user-", user).alias("user_id"),
            F.when(no % 31 != 0, text("device-", no % 100)).alias("device_id"),
            F.lit("172.16.0.1").alias("ip"),
            F.coalesce(F.element_at(F.create_map(*pairs), F.col("event_type")), F.lit("ERROR")).alias("event_type"),
            F.lit("2026-05-10T02:00:00Z").alias("event_time"),
            F.lit("Shanghai").alias("province"), F.lit("Shanghai").alias("city"),
            F.lit("APP").alias("channel"),
            F.when(no % 37 == 0, 1).alias("extra"),
        )).alias("value"),
    )


@query("schema_violations_transaction")
def _(spark, sf):
    lines = adapter.raw_lines(spark, sf).select("event_no", "arrival_seq", "value")
    return validate.schema_violations(lines).drop("value")


@query("schema_violations_user_event")
def _(spark, sf):
    return validate.schema_violations(user_event_lines(spark, sf), "user").drop("value")


@query("schema_discriminate")
def _(spark, sf):
    both = adapter.raw_lines(spark, sf).select("event_no", "value").unionByName(user_event_lines(spark, sf))
    return (
        validate.schema_discriminate(both)
        .groupBy("is_transaction", "is_user_event", "is_valid").agg(F.count(F.lit(1)).alias("n"))
    )


# --- preparation -------------------------------------------------------------------

@query("watermark_60s")
def _(spark, sf):
    narrow = arrivals(spark, sf).select("event_id", "arrival_seq", "event_ts")
    return prepare.with_watermark(narrow)


_PREPARED = ["event_id", "user_id", "arrival_seq", "event_ts", "amount", "process_time"]


@query("dedup_event_id")
def _(spark, sf):
    return prepare.dedup(arrivals(spark, sf)).select(*_PREPARED)


@query("route_late")
def _(spark, sf):
    return prepare.flag_late(arrivals(spark, sf)).select("event_id", "arrival_seq", "event_ts", "is_late")


@query("late_events")
def _(spark, sf):
    return late(spark, sf).select(*_PREPARED)


@query("on_time_events")
def _(spark, sf):
    return on_time(spark, sf).select(*_PREPARED)


@query("successful_payments")
def _(spark, sf):
    return prepare.successful_payments(on_time(spark, sf)).select(*_PREPARED, "transaction_status")


# --- rules ---------------------------------------------------------------------------

query("r001_user_frequency")(lambda s, d: rules.r001_user_frequency(on_time(s, d)))
query("r002_user_amount")(lambda s, d: rules.r002_user_amount(on_time(s, d)))
query("r003_device_users")(lambda s, d: rules.r003_device_users(on_time(s, d)))
query("r004_card_users")(lambda s, d: rules.r004_card_users(on_time(s, d)))
query("r006_black_device")(lambda s, d: rules.r006_black_device(on_time(s, d)))


def _hot_users(spark, sf):
    # counted on raw arrivals: an upper bound that needs no preparation
    return scans.hot_keys(arrivals(spark, sf), "user_id")


query("r005_consecutive_failure")(
    lambda s, d: rules.r005_consecutive_failure(on_time(s, d), hot=_hot_users(s, d))
)
query("r007_user_amount_spike")(
    lambda s, d: rules.r007_user_amount_spike(on_time(s, d), hot=_hot_users(s, d))
)
query("r008_merchant_spike")(lambda s, d: rules.r008_merchant_spike(merchant_windows(s, d)))
query("merchant_window_amount")(merchant_windows)
query("risk_alerts")(alerts)


# --- state that is forgotten ------------------------------------------------------------

def _clocked(events: DataFrame, seconds: int) -> DataFrame:
    """Arrivals so many seconds apart by the clock; in the table itself all come within minutes."""
    return events.withColumn("clock_us", F.col("arrival_seq") * F.lit(seconds * 1_000_000) + F.lit(adapter.EPOCH_US))


@query("r005_consecutive_failure_ttl")
def _(spark, sf):
    """Two failures in a row, no more than six hours apart."""
    events = _clocked(on_time(spark, sf), 20)
    cfg = RuleConfig(consecutive_failures=2)
    return rules.r005_consecutive_failure(events, cfg, _hot_users(spark, sf), config.FAILURE_TTL_US)


@query("r007_user_amount_spike_ttl")
def _(spark, sf):
    """Histories that end where a user pays nothing for more than thirty days."""
    events = _clocked(on_time(spark, sf), 1500)
    return rules.r007_user_amount_spike(events, hot=_hot_users(spark, sf), ttl_us=config.USER_MEAN_TTL_US)


@query("r008_merchant_spike_ttl")
def _(spark, sf):
    """Events of minutes as if of years, so that merchants are silent for more than fourteen days."""
    us = F.unix_micros("event_ts")
    events = on_time(spark, sf).withColumn("event_ts", F.timestamp_micros((us - adapter.EPOCH_US) * 115_200 + adapter.EPOCH_US))
    found = windows.merchant_window_amount(prepare.successful_payments(events))
    return rules.r008_merchant_spike(found, ttl_us=config.MERCHANT_MEAN_TTL_US)


@query("dedup_event_id_24h")
def _(spark, sf):
    """Ids that come again over weeks, one of them on a third of all arrivals."""
    seq = F.col("arrival_seq")
    again = F.when(seq % 3 == 0, "evt-hot").otherwise(F.concat(F.lit("evt-"), (seq % 997).cast("string")))
    events = _clocked(arrivals(spark, sf).withColumn("event_id", again), 60)
    return prepare.dedup(events, config.DEDUP_TTL_US).select("event_id", "arrival_seq", "user_id", "clock_us")


@query("alert_id")
def _(spark, sf):
    return arrivals(spark, sf).select(
        "arrival_seq", "event_id", ids.stable_id(F.lit("R006"), F.col("event_id")).alias("event_alert_id"),
        ids.stable_id(F.lit("R008"), F.lit("商户"), F.col("merchant_id")).alias("key_alert_id"),
    )


@query("alert_event_time")
def _(spark, sf):
    return alerts(spark, sf).select("alert_id", "rule_id", al.alert_event_time().alias("alert_event_time"))


# --- metrics ---------------------------------------------------------------------------

query("metric_transaction_count_1m")(lambda s, d: mt.transaction_count_1m(on_time(s, d)))
query("metric_transaction_amount_5m")(lambda s, d: mt.transaction_amount_5m(on_time(s, d)))
query("metric_channel_success_rate_5m")(lambda s, d: mt.channel_success_rate_5m(on_time(s, d)))
query("metric_merchant_amount_5m")(lambda s, d: mt.merchant_amount_5m(merchant_windows(s, d)))
query("metric_risk_alert_count_1m")(lambda s, d: mt.risk_alert_count_1m(alerts(s, d)))
query("metric_high_risk_alert_count_1m")(lambda s, d: mt.high_risk_alert_count_1m(alerts(s, d)))


query("realtime_metrics")(_metrics)


@query("metric_id")
def _(spark, sf):
    return _metrics(spark, sf).select("metric_id", "metric_name", "window_start", "window_end")


# --- serving -----------------------------------------------------------------------------

def _newest(rows: DataFrame, time: str):
    return rows.agg(F.max(time).alias("as_of")).scalar()


query("q_alert_volume_by_minute")(lambda s, d: serving.alert_volume_by_minute(alerts(s, d)))
query("q_top_users_by_alerts")(lambda s, d: serving.top_users_by_alerts(alerts(s, d)))
query("q_merchant_peak_amount")(
    lambda s, d: serving.merchant_peak_amount(mt.merchant_amount_5m(merchant_windows(s, d)))
)


@query("q_alerts_by_level_1h")
def _(spark, sf):
    rows = staged_alerts(spark, sf)
    return serving.alerts_by_level_1h(rows, _newest(rows, "alert_time"))


@query("q_channel_success_rate_30m")
def _(spark, sf):
    rows = session.stage(mt.channel_success_rate_5m(on_time(spark, sf)), "rates")
    # means of ratios: rounded, as their sum depends on the order of rows
    found = serving.channel_success_rate_30m(rows, _newest(rows, "window_end"))
    return found.withColumn("avg_success_rate", F.round("avg_success_rate", 9))


@query("q_late_by_minute")
def _(spark, sf):
    return serving.late_by_minute(files.late_table(late(spark, sf), F.try_to_timestamp("process_time")))


query("q_dead_letter_by_minute")(lambda s, d: serving.dead_letter_by_minute(dead(s, d)))


# --- dashboard ------------------------------------------------------------------------------

@query("risk_score")
def _(spark, sf):
    return dash.with_risk_score(on_time(spark, sf)).select("event_id", "amount", "risk_label", "risk_score")


query("group_count_channel")(lambda s, d: dash.group_count(on_time(s, d), "channel"))
query("group_count_risk_label")(lambda s, d: dash.group_count(on_time(s, d), "risk_label"))
query("group_count_risk_level")(lambda s, d: dash.group_count(alerts(s, d), "risk_level"))
query("group_count_rule_id")(lambda s, d: dash.group_count(alerts(s, d), "rule_id"))
query("top_amount_city")(lambda s, d: dash.top_amount(on_time(s, d), "city"))
query("top_amount_merchant")(lambda s, d: dash.top_amount(on_time(s, d), "merchant_id"))
query("time_series_equal_bins")(lambda s, d: dash.time_series(staged(s, d)))
query("risk_scatter")(lambda s, d: dash.risk_scatter(staged(s, d)))
query("channel_label_heatmap")(lambda s, d: dash.channel_label_heatmap(on_time(s, d)))
query("flow_links")(lambda s, d: dash.flow_links(on_time(s, d)))


def _conversion(spark, sf):
    return aml.conversion_summary(aml_events(spark, sf))


@query("overview")
def _(spark, sf):
    flagged = session.stage(prepare.flag_late(arrivals(spark, sf)), "flagged")
    good = flagged.filter(~F.col("is_late")).drop("is_late")
    return dash.overview(good, rules.risk_alerts(good), flagged.filter("is_late"), _conversion(spark, sf))


@query("insight_facts")
def _(spark, sf):
    events = staged(spark, sf)
    facts = dash.insight_facts(
        events, rules.risk_alerts(events), _conversion(spark, sf), dash.time_series(events)
    )
    return facts.withColumn("aml_label_density_pct", F.round("aml_label_density_pct", 9))


@query("recent_alerts")
def _(spark, sf):
    return dash.recent(alerts(spark, sf), "alert_time", "alert_id").select("alert_id", "rule_id", "alert_time")


@query("recent_metrics")
def _(spark, sf):
    return dash.recent(_metrics(spark, sf), "emit_time", "metric_id").select("metric_id", "metric_name", "value", "emit_time")


@query("filter_scatter")
def _(spark, sf):
    return dash.filter_scatter(dash.risk_scatter(staged(spark, sf)), "POS", "NORMAL", 35)


@query("filter_alerts")
def _(spark, sf):
    return dash.filter_alerts(alerts(spark, sf), "R002").select("alert_id", "user_id", "alert_time")


# --- anti-money-laundering conversion ----------------------------------------------------------

def _aml_columns(build):
    return lambda s, d: adapter.aml_rows(s, d).select(
        "from_account", "to_account", "to_bank", *build()
    )


query("stable_hash")(_aml_columns(lambda: [
    ids.stable_hash(F.col("from_account")).alias("hash16"), ids.stable_hash(F.col("to_bank"), 24).alias("hash24"),
]))
query("stable_int")(_aml_columns(lambda: [
    ids.stable_int(F.col("from_account"), 240).alias("mod240"), ids.stable_int(F.col("to_account"), 1000).alias("mod1000"),
]))
query("parse_bool")(_aml_columns(lambda: [
    "is_laundering", "predicted_alert", aml.parse_bool(F.col("is_laundering")).alias("laundering"),
    aml.parse_bool(F.col("predicted_alert")).alias("predicted"),
]))
query("parse_float")(_aml_columns(lambda: [
    "model_score", aml.parse_float(F.col("model_score")).alias("score"),
    aml.parse_float(F.col("amount_paid")).alias("paid"),
]))
query("iso_timestamp")(_aml_columns(lambda: [
    aml.iso_timestamp(F.regexp_replace("timestamp", "Z$", "+02:00")).alias("from_offset"),
    aml.iso_timestamp(F.lit(""), "2026-01-01T00:00:00Z").alias("from_blank"),
]))
query("payment_method")(_aml_columns(lambda: ["payment_format", aml.payment_method(F.col("payment_format")).alias("payment_method")]))
query("transaction_type")(_aml_columns(lambda: ["payment_format", aml.transaction_type(F.col("payment_format")).alias("transaction_type")]))


def _location():
    province, city = aml.country_location(F.col("from_country"))
    return ["from_country", province.alias("province"), city.alias("city")]


query("country_location")(_aml_columns(_location))
query("risk_label")(_aml_columns(lambda: [aml.risk_label(
    aml.parse_bool(F.col("is_laundering")), aml.parse_bool(F.col("predicted_alert")),
    aml.parse_float(F.col("model_score")),
).alias("risk_label")]))
query("status_flags_channel")(lambda s, d: aml_events(s, d).select(
    "event_id", "transaction_status", "is_black_device", "is_black_card", "channel", "app_version",
    "ip", "process_time",
))
query("map_aml_to_transaction")(aml_events)


# --- extensions -----------------------------------------------------------------------------------

query("city_amount_topn_5m")(lambda s, d: ext.city_amount_topn_5m(on_time(s, d)))
query("consecutive_failure_users")(lambda s, d: ext.consecutive_failure_users(
    rules.r005_consecutive_failure(on_time(s, d), hot=_hot_users(s, d))
))
query("feature_stream")(lambda s, d: ext.feature_stream(alerts(s, d)))
query("merchant_amount_two_stage")(lambda s, d: ext.merchant_amount_two_stage(on_time(s, d)))


@query("rules_from_config")
def _(spark, sf):
    # versions and thresholds from the region keys: the newest raises both
    region = adapter.read_table(spark, sf, "region")
    version = F.col("r_regionkey").cast("int").alias("version")
    table = region.select(version, F.lit("R001").alias("rule_id"), (F.col("r_regionkey") + 8.0).alias("threshold"))
    table = table.unionByName(region.select(
        version, F.lit("R002").alias("rule_id"), (F.col("r_regionkey") * 10000.0).alias("threshold")
    ))
    cfg = ext.rules_from_config(table)
    events = on_time(spark, sf)
    found = rules.r001_user_frequency(events, cfg).unionByName(rules.r002_user_amount(events, cfg))
    return found.select("alert_id", "rule_id", "evidence").withColumn("version", F.lit(cfg.version))


def _rule_versions(spark, sf) -> DataFrame:
    """Five versions of each rule, three minutes each, from the region keys; the device rule is off in every other one."""
    key = F.col("r_regionkey").cast("double")
    per_rule = {
        "R001": key + 8, "R002": (key + 1) * 10000, "R003": key + 3, "R004": key + 2, "R005": key + 1,
        "R006": key * 0, "R007": key + 3, "R008": key * 0.5 + 2,
    }
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rule_id"), t.alias("threshold")) for r, t in per_rule.items()]))
    start = F.timestamp_micros(F.lit(adapter.EPOCH_US) + F.col("r_regionkey").cast("bigint") * 180_000_000)
    table = adapter.read_table(spark, sf, "region").select(F.col("r_regionkey").alias("version"), start.alias("valid_from"), rows.alias("r"))
    on = (F.col("r.rule_id") != "R006") | (F.col("version") % 2 == 0)
    return table.select("r.rule_id", "version", "r.threshold", "valid_from", on.alias("enabled"))


@query("rules_by_time")
def _(spark, sf):
    """All eight rules, each row judged by the version that was valid at its time."""
    return versions.alerts_by_version(staged(spark, sf), _rule_versions(spark, sf), hot=_hot_users(spark, sf)).select(
        "alert_id", "rule_id", "event_id", "window_end", "evidence"
    )


@query("blacklist_join")
def _(spark, sf):
    suppliers = adapter.read_table(spark, sf, "supplier")
    bad = suppliers.filter(F.col("s_acctbal") < 0)
    key = lambda prefix: F.concat(F.lit(prefix), F.col("s_suppkey").cast("string"))
    devices = bad.select(key("device-").alias("device_id"))
    cards = bad.select(key("card-").alias("card_id"))
    return ext.blacklist_join(on_time(spark, sf), devices, cards).select(
        "event_id", "device_id", "card_id", "is_black_device", "is_black_card"
    )


def _list_changes(spark, sf) -> DataFrame:
    """Suppliers with debts are listed as devices and cards, at times of their own, and every other one later removed."""
    key, start = F.col("s_suppkey"), F.lit(adapter.EPOCH_US)
    rows = adapter.read_table(spark, sf, "supplier").filter("s_acctbal < 2000")
    change = lambda name, listed, second: F.struct(
        F.lit(name).alias("list"), F.concat(F.lit(f"{name}-"), key.cast("string")).alias("id"), F.lit(listed).alias("listed"),
        F.timestamp_micros(start + second * 1_000_000).alias("at"),
    )
    changes = F.array(
        change("device", True, key % 300), change("device", True, key % 300 + 50), change("device", False, key % 300 + 200 + key % 2 * 90_000),
        change("card", True, key % 400), change("card", False, key % 400 + 150), change("card", True, key % 400 + 300),
        change("card", False, key % 400 + 300 - key % 3 * 20),
    )
    return rows.select(F.explode(changes).alias("c")).select("c.*")


@query("blacklist_by_time")
def _(spark, sf):
    return lists.listed_events(on_time(spark, sf), _list_changes(spark, sf)).select(
        "event_id", "device_id", "card_id", "is_black_device", "is_black_card"
    )


@query("alert_cooldown")
def _(spark, sf):
    return ext.alert_cooldown(staged_alerts(spark, sf)).select("alert_id", "rule_id", "alert_time")


# --- streaming -----------------------------------------------------------------------------------------

_BATCHES = 6
_PREPARING = ["ingest", "route"]


#: Rows of a source file: as many at most, and not fewer only to give every core a file.  A file is read by one task.
_FILE_ROWS, _LEAST_FILE_ROWS = 200_000, 5_000
#: Events for which the state gets one more partition.
_STATE_ROWS = 100_000


def _state_partitions(spark, events: int) -> int:
    """As many as the events ask for, one per core at least, and no more than the session has."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-events // _STATE_ROWS)))


def _batch_files(events: int, cores: int) -> int:
    """Source files of one micro-batch."""
    rows = -(-events // _BATCHES)
    return max(1, -(-rows // _FILE_ROWS), min(cores, rows // _LEAST_FILE_ROWS))


def _published(spark, held: str, source: str, steps: int):
    """Move the files of a folder, which hold ranges of arrivals, to the source in some steps, as old as their order says."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{held}/part-*")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted(system.globStatus(place), key=lambda f: f.getPath().getName())
    newest = max(f.getModificationTime() for f in files)
    system.mkdirs(hadoop.Path(source))
    for step in range(steps):
        for i in range(len(files) * step // steps, len(files) * (step + 1) // steps):
            path = files[i].getPath()
            system.setTimes(path, newest + 1000 * (i - len(files)), -1)
            system.rename(path, hadoop.Path(f"{source}/{path.getName()}"))
        yield step


def _streamed(spark, sf, *runs: list[str], steps: int = 1, rolls: bool = False, **options):
    """The job over raw text that arrives in several micro-batches.

    ``runs`` name the stages of each run; with more ``steps`` the text comes bit
    by bit, and all runs follow each, with a roll of the outputs if asked for.
    """
    root = session.new_dir(spark, "stream")
    # files of consecutive arrivals, as many to a micro-batch as its size asks for
    events = adapter.arrivals(spark, sf).count()
    per_batch = _batch_files(events, spark.sparkContext.defaultParallelism)
    lines = adapter.raw_lines(spark, sf, ranges=_BATCHES * per_batch).select("value", "arrival_seq")
    lines.write.parquet(f"{root}/held")
    cfg = stream_config(root, **{"max_files_per_trigger": 16, "state_partitions": _state_partitions(spark, events), **options})
    stream = job.RiskStream(spark, cfg, job.numbered_source(spark, f"{root}/source", max_files=per_batch))
    for _ in _published(spark, f"{root}/held", f"{root}/source", steps):
        for names in runs:
            stream.catch_up(names)
        if rolls:
            stream.roll()
    return cfg


def _stream_alerts(spark, cfg, name):
    found = tables.read_output(spark, f"{cfg.alert_output}/{name}", schemas.ALERT_JSON, "json")
    return found.select("alert_id", "rule_id", "user_id", "merchant_id", "event_id", "window_start", "window_end", "evidence")


def _stream_rule(stage, *before):
    return lambda spark, sf: _stream_alerts(spark, _streamed(spark, sf, [*_PREPARING, *before, stage]), stage)


query("stream_user_frequency")(_stream_rule("user_frequency"))
query("stream_user_amount")(_stream_rule("user_amount"))
query("stream_device_users")(_stream_rule("device_users"))
query("stream_card_users")(_stream_rule("card_users"))
query("stream_black_device")(_stream_rule("black_device"))
query("stream_consecutive_failure")(_stream_rule("consecutive_failure"))
query("stream_user_spike")(_stream_rule("user_spike"))
query("stream_merchant_spike")(_stream_rule("merchant_spike", "merchant_amount"))


def _stream_metric(stage):
    def run(spark, sf):
        cfg = _streamed(spark, sf, [*_PREPARING, stage])
        rows = tables.read_output(spark, f"{cfg.metric_output}/{stage}", schemas.METRIC_JSON, "json")
        return rows.drop("emit_time")

    return run


query("stream_transaction_count")(_stream_metric("transaction_count"))
query("stream_transaction_amount")(_stream_metric("transaction_amount"))
query("stream_channel_rate")(_stream_metric("channel_rate"))
query("stream_merchant_amount")(_stream_metric("merchant_amount"))


@query("stream_alert_cooldown")
def _(spark, sf):
    """Cooled alerts of three rules, over several runs of rules and cool-down."""
    stages = [*_PREPARING, "user_amount", "black_device", "user_spike"]
    cfg = _streamed(spark, sf, stages, ["alert_cooldown"], steps=3, cooldown_minutes=10)
    rows = tables.read_output(spark, f"{cfg.alert_output}-cooled", schemas.ALERT_JSON, "json")
    return rows.select("alert_id", "rule_id", "window_end")


@query("stream_city_topn")
def _(spark, sf):
    cfg = _streamed(spark, sf, [*_PREPARING, "city_topn"], city_topn=3)
    best = "city string, amount decimal(38,2), window_start timestamp, window_end timestamp, place int"
    return tables.read_output(spark, f"{cfg.metric_output}-city-topn", best)


@query("stream_blacklist")
def _(spark, sf):
    """Events on the lists of their time, the change log read anew for every micro-batch."""
    changes = session.new_dir(spark, "list-changes")
    _list_changes(spark, sf).write.parquet(changes)
    cfg = _streamed(spark, sf, [*_PREPARING, "listed_events"], list_changes=changes)
    listed = "event_id string, device_id string, card_id string, is_black_device boolean, is_black_card boolean"
    return tables.read_output(spark, f"{cfg.alert_output}-listed", listed)


@query("stream_features")
def _(spark, sf):
    """Rule hits per user, counted as alerts arrive in two steps."""
    stages = [*_PREPARING, "user_frequency", "user_amount", "consecutive_failure", "black_device", "user_spike"]
    cfg = _streamed(spark, sf, stages, ["user_features"], steps=2, user_features=True)
    return features.features(spark, f"{cfg.alert_output}-features")


@query("stream_rolled_alerts")
def _(spark, sf):
    """Alerts of a stream whose outputs are rolled, and whose rolled batches go, after each of three steps."""
    now = dict(roll_seconds=0, keep_seconds=0)
    cfg = _streamed(spark, sf, [*_PREPARING, "user_frequency", "alert_count"], steps=3, rolls=True, **now)
    rows = rolling.read_output(spark, f"{cfg.alert_output}/user_frequency", schemas.ALERT_JSON)
    counts = rolling.read_output(spark, f"{cfg.metric_output}/alert_count", schemas.METRIC_JSON)
    # the count of a minute is written again when it grows
    counted = counts.groupBy("window_start").agg(F.max("count").alias("alerts_in_minute"))
    # the only rule that ran has windows of one minute
    return rows.select("alert_id", "user_id", "window_start", "window_end", "evidence").join(counted, "window_start", "left")


@query("stream_late_events")
def _(spark, sf):
    cfg = _streamed(spark, sf, _PREPARING)
    rows = tables.read_output(spark, cfg.late_output, schemas.TRANSACTION_TEXT, "json")
    return rows.select("event_id", "transaction_id", "user_id", "process_time")


@query("stream_alert_counts")
def _(spark, sf):
    """Alert counts, with the window rules two runs behind the event rules and the counts."""
    counts, quick = ["alert_count", "high_alert_count"], ["black_device", "consecutive_failure", "user_spike"]
    slow = [n for n in job.ALERT_QUERIES if n not in quick] + ["merchant_amount"]
    cfg = _streamed(spark, sf, [*_PREPARING, *quick, *counts], slow, counts)
    rows = [
        tables.read_output(spark, f"{cfg.metric_output}/{name}", schemas.METRIC_JSON, "json").select(
            "metric_name", "window_start", "window_end", "count"
        )
        for name in counts
    ]
    # a count is written again when it grows
    return rows[0].unionByName(rows[1]).groupBy("metric_name", "window_start", "window_end").agg(F.max("count").alias("n"))
