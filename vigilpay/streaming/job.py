"""The streaming job: raw events in; alerts, metrics, late events and dead letters out.

Queries are chained through tables, because a late row needs an output of its
own and because state per key cannot follow a streaming aggregation:

    source -> ingest -> parsed -> route -> on_time -> window rules, metrics
                 |                  |         `-----> rules with state per user
             dead letters         late            merchant windows -> merchant rule
                                                  all alerts -> alert metrics

Arrivals are numbered as they are ingested, and whether one is late is decided
there, against the largest event time of all earlier arrivals.  A row of state
per micro-batch carries both on, so the cut into micro-batches changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from vigilpay import config, schemas
from vigilpay.config import StreamConfig
from vigilpay.functions.scores import same_text
from vigilpay.operators import alerts as al, extensions as ext, lists, metrics as mt, prepare, rules, validate
from vigilpay.sources import files, kafka
from vigilpay.streaming import features, rolling, shared, sights, state, tables

_EVENT = schemas.EVENT
#: First arrivals of a micro-batch.  Money as text and instants as numbers, as pandas keeps those.
_PARSED = T.StructType(
    [T.StructField(f.name, {"amount": T.StringType(), "event_ts": T.LongType()}.get(f.name, f.dataType)) for f in _EVENT.fields]
    + [T.StructField("is_late", T.BooleanType()), T.StructField("ingest_ms", T.LongType())]
)
#: On-time events with the clock of their arrival.
_ON_TIME = T.StructType(_EVENT.fields + [T.StructField("ingest_ms", T.LongType())])
_NO_EMPTY_BATCHES = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
#: A micro-batch as one job for each of its outputs.  Planned stage by stage, and with
#: broadcasts, it would be a chain of some fifteen small jobs, which take longer than its rows.
_PLANNED_ONCE = {
    "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    # the parser's stage is one method, too long for the JVM to compile; taken apart it is compiled
    "spark.sql.codegen.wholeStage": "false",
    # what is kept is read a few times and dropped; choosing an encoding for every column takes longer
    "spark.sql.inMemoryColumnarStorage.compressed": "false",
}
#: How long a query that waits for the one before it does not look for new batches.
_POLLING = {"spark.sql.streaming.pollingDelay": "200ms"}
#: Stages from here on follow all alerts, those below follow the events.
_ALERT_LEVEL = 4
#: Arrivals of a micro-batch are far fewer than those of a table; blocks of 4,096 of them keep all tasks busy.
_BLOCK_BITS = 12
_PROGRESS = "next_seq bigint, newest_us bigint"
_MERCHANT_WINDOW = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("cents", T.LongType()),
    ]
)
ALERT_QUERIES = [
    "user_frequency", "user_amount", "device_users", "card_users",
    "consecutive_failure", "black_device", "user_spike", "merchant_spike",
]


@dataclass
class Stage:
    """One streaming query: a streaming frame and what to do with each micro-batch."""

    name: str
    frame: Callable[[], DataFrame]
    sink: Callable[[DataFrame, int], None]
    level: int = 2  # stages of a level read only tables of lower levels
    mode: str = "append"
    timers: bool = False  # has state that is forgotten by the clock
    state: bool = True  # keeps state between micro-batches
    planned_once: bool = False  # no key of its shuffles is hot, so its plan need not follow their sizes


class RiskStream:
    """Builds and starts the queries of the job."""

    def __init__(self, spark: SparkSession, cfg: StreamConfig, source: Callable[[], DataFrame] | None = None):
        self.spark, self.cfg = spark, cfg
        self.source = source or (lambda: kafka.transactions(spark, cfg))
        self.work = f"{cfg.checkpoint_dir}/tables"
        self.clock: Callable[[], int] = lambda: time.time_ns() // 1_000_000

    # --- tables ---------------------------------------------------------------

    def _table(self, name: str) -> str:
        return f"{self.work}/{name}"

    def on_time(self) -> DataFrame:
        """On-time events with the watermark windows close by.

        Rows were already separated by lateness, against a watermark never
        behind this one, so no row is dropped here.
        """
        delay = f"{self.cfg.watermark_seconds} seconds"
        return self._stream("on_time", _ON_TIME).withWatermark("event_ts", delay)

    def _stream(self, name: str, schema: T.StructType) -> DataFrame:
        """Whole batches of an inner table: cut, a part would be late behind the watermark or the state of the part before."""
        return tables.stream(self.spark, self._table(name), schema, max_files=None)

    def alerts(self) -> DataFrame:
        """Identity, level and minute of all alerts.

        Rules run at their own pace, so there is no event time that all of them
        have passed: alert counts follow every alert, however late it comes.
        """
        parts = [
            tables.stream(
                self.spark, f"{self.cfg.alert_output}/{name}", schemas.ALERT_JSON, "json", self.cfg.max_files_per_trigger
            )
            for name in ALERT_QUERIES
        ]
        timed = al.union_alerts(*parts).withColumn("window_end", F.timestamp_millis("window_end"))
        return timed.select("risk_level", al.alert_event_time().alias("event_ts"))

    def _cooled(self) -> DataFrame:
        """Alerts of all rules without those too near to an emitted one of the same rule and key.

        A rule's alerts are in order of time from one of its micro-batches to the
        next, not inside of one, so those are read whole.
        """
        parts = [
            tables.stream(self.spark, f"{self.cfg.alert_output}/{name}", schemas.ALERT_JSON, "json", max_files=None)
            for name in ALERT_QUERIES
        ]
        rows = al.union_alerts(*parts)
        time = F.coalesce(
            F.timestamp_millis("window_end") - F.expr("INTERVAL '0.001' SECOND"), F.try_to_timestamp(F.col("event_time"))
        )
        body = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
        rows = rows.select(ext.follows_key().alias("key"), F.unix_micros(time).alias("at"), "alert_id", body.alias("alert"))
        return state.cooled(rows, self.cfg.cooldown_minutes * 60_000_000, buckets=state.BUCKETS)

    def _all_alerts(self) -> DataFrame:
        parts = [
            tables.stream(
                self.spark, f"{self.cfg.alert_output}/{name}", schemas.ALERT_JSON, "json", self.cfg.max_files_per_trigger
            )
            for name in ALERT_QUERIES
        ]
        return al.union_alerts(*parts).select("user_id", "rule_id")

    def _write_features(self, batch: DataFrame, batch_id: int) -> None:
        features.add(batch, f"{self.cfg.alert_output}-features", batch_id)

    def _write_topn(self, rows: DataFrame, batch_id: int) -> None:
        # a window closes in one micro-batch, with all its cities
        order = Window.partitionBy("window_start", "window_end").orderBy(F.desc("amount"), "city")
        best = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= self.cfg.city_topn)
        tables.write_batch(best, f"{self.cfg.metric_output}-city-topn", batch_id, stateful=True)

    def _write_listed(self, batch: DataFrame, batch_id: int) -> None:
        found = self._listed(batch).filter("is_black_device OR is_black_card")
        rows = found.select("event_id", "device_id", "card_id", "is_black_device", "is_black_card")
        tables.write_batch(rows, f"{self.cfg.alert_output}-listed", batch_id)

    def _write_cooled(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.from_json("alert", schemas.ALERT_JSON).alias("a")).select("a.*")
        tables.write_batch(rows, self.cfg.cooled_output or f"{self.cfg.alert_output}-cooled", batch_id, "json", stateful=True)

    # --- rules and lists that change while the job runs ---------------------------

    def rules_now(self) -> config.RuleConfig:
        """The thresholds of this moment: those of the rule table if there is one."""
        if not self.cfg.rule_table:
            return self.cfg.rules
        return ext.rules_from_config(self.spark.read.parquet(self.cfg.rule_table))

    def _least(self, fixed: int) -> int:
        """What state must let through; with a rule table, the sink decides."""
        return 1 if self.cfg.rule_table else fixed

    def _mean_multiple(self, fixed: Decimal) -> float:
        """How many times the mean a row must reach to be looked at by the sink; with a rule table, any."""
        return 0.0 if self.cfg.rule_table else float(fixed)

    def _listed(self, events: DataFrame) -> DataFrame:
        if self.cfg.list_changes:
            events = lists.listed_at(events, self.spark.read.parquet(self.cfg.list_changes))
        if not self.cfg.device_list:
            return events
        listed = self.spark.read.parquet(self.cfg.device_list)
        return ext.blacklist_join(events, devices=listed).select(*events.columns)

    # --- sinks ------------------------------------------------------------------

    def _write_alerts(self, name: str, build: Callable[[DataFrame], DataFrame]):
        path = f"{self.cfg.alert_output}/{name}"

        def sink(batch: DataFrame, batch_id: int) -> None:
            found = build(batch).withColumn("alert_time", F.current_timestamp())
            tables.write_batch(files.json_view(found), path, batch_id, "json", stateful=True)

        return sink

    def _write_metrics(self, name: str, build: Callable[[DataFrame], DataFrame]):
        path = f"{self.cfg.metric_output}/{name}"

        def sink(batch: DataFrame, batch_id: int) -> None:
            rows = build(batch).withColumn("emit_time", F.current_timestamp())
            tables.write_batch(files.json_view(rows), path, batch_id, "json", stateful=True)

        return sink

    # --- ingest and routing --------------------------------------------------------

    def _progress(self, batch_id: int) -> tuple[int, int | None]:
        """The next arrival number and the largest event time so far, as the batch before left them."""
        if batch_id == 0:
            return 0, None
        before = tables.read_batch(self.spark, self._table("progress"), batch_id - 1, _PROGRESS)
        row = before.first() if before is not None else None
        if row is None:
            raise RuntimeError(f"no progress of batch {batch_id - 1} in {self._table('progress')}")
        return row["next_seq"], row["newest_us"]

    @staticmethod
    def _numbered(rows: DataFrame, base: int) -> DataFrame:
        """Rows with dense arrival numbers from ``base``, in the order of ``_id``."""
        in_part = 33  # low bits of an id that count rows of one partition
        parts = rows.groupBy(F.shiftright("_id", in_part).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
        # one row per partition of the batch
        before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = parts.select("_part", (before + F.lit(base)).alias("_base"))
        place = F.col("_id").bitwiseAND(F.lit((1 << in_part) - 1))
        return rows.join(F.broadcast(parts), F.shiftright("_id", in_part) == F.col("_part")).withColumn(
            "arrival_seq", F.col("_base") + place
        )

    def _ingest(self, batch: DataFrame, batch_id: int) -> None:
        """Number and parse; store rejects and the first arrival of every id of the batch, late or not."""
        next_seq, newest_us = self._progress(batch_id)
        numbered = "arrival_seq" in batch.columns
        if not numbered:
            # in the source's order if it tells one
            batch = batch.orderBy("arrival_order") if "arrival_order" in batch.columns else batch
            batch = batch.withColumn("_id", F.monotonically_increasing_id()).persist()
        arrived = batch if numbered else self._numbered(batch, next_seq)
        parsed = validate.parse_transactions(arrived.select("value", "arrival_seq"))
        # only dead letters need the raw text again
        parsed = parsed.withColumn("value", F.when(F.col("reject_reason").isNotNull(), F.col("value"))).persist()
        try:
            rejects = validate.dead_letters(parsed, self.cfg.transaction_topic, F.current_timestamp())
            tables.write_batch(files.json_view(rejects), self.cfg.dead_letter_output, batch_id, "json")
            good = prepare.flag_late(validate.valid_events(parsed).drop("value"), self.cfg.watermark_seconds, block_bits=_BLOCK_BITS, newest_us=newest_us)
            good = good.withColumn("amount", F.col("amount").cast("string")).withColumn(
                "event_ts", F.unix_micros("event_ts")
            ).withColumn("ingest_ms", F.lit(self.clock()).cast("bigint"))
            tables.write_batch(good.select(*_PARSED.names), self._table("parsed"), batch_id)
            after = parsed.agg(
                F.coalesce(F.max("arrival_seq") + 1, F.lit(next_seq)).alias("next_seq"),
                F.greatest(
                    F.max(F.when(F.col("reject_reason").isNull(), F.unix_micros("event_ts"))), F.lit(newest_us).cast("bigint")
                ).alias("newest_us"),
            )
            tables.write_batch(after.coalesce(1), self._table("progress"), batch_id, keep_empty=True)
            # the batch before may still be needed if this one runs again; older ones are not
            tables.drop_batch(self.spark, self._table("progress"), batch_id - 2)
        finally:
            parsed.unpersist()
            if not numbered:
                batch.unpersist()

    def _route(self, batch: DataFrame, batch_id: int) -> None:
        """The first arrival of every id within a day of its first sight, late or not."""
        path = self._table("sights")
        passed = sights.first_sights(batch, path, batch_id).persist()
        try:
            events = passed.withColumn("amount", F.col("amount").cast(schemas.MONEY)).withColumn(
                "event_ts", F.timestamp_micros("event_ts")
            )
            behind = events.filter("is_late").select(*schemas.TRANSACTION_FIELDS)
            tables.write_batch(files.json_view(behind), self.cfg.late_output, batch_id, "json")
            tables.write_batch(events.filter("NOT is_late").select(*_ON_TIME.names), self._table("on_time"), batch_id)
            sights.remember(passed, path, batch_id)
        finally:
            passed.unpersist()

    # --- windows ----------------------------------------------------------------------

    def _windowed(self, keys: list[str], minutes: int, success: bool = False, **measures: tuple[Column, Callable]) -> DataFrame:
        """Windows of ``minutes`` that move by one minute.

        A measure is its column over events and the function that puts panes
        together.  Events are reduced to one-minute panes, and a pane goes into
        the windows that hold it when it closes, so an event changes one row of
        state, not one per window.  Windows close in the batch of their last pane.
        """
        events = self.on_time()
        if success:
            events = prepare.successful_payments(events)
        rows = events.groupBy(F.window("event_ts", "1 minute").alias("w"), *keys).agg(
            *[column.alias(name) for name, (column, _) in measures.items()]
        )
        if minutes > 1:
            rows = rows.select(*keys, *measures, F.window_time("w").alias("pane_time"))
            rows = rows.groupBy(F.window("pane_time", f"{minutes} minutes", "1 minute").alias("w"), *keys).agg(
                *[together(name).alias(name) for name, (_, together) in measures.items()]
            )
        return rows.select(*keys, *measures, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))

    def _shared_key(self, name: str, rule: config.Rule, key: str, live: Callable[[], int], minutes: int = 10) -> Stage:
        """Counts the users of a key in windows that close; who appeared when is kept in tables."""
        path = self._table(name)

        def sink(batch: DataFrame, batch_id: int) -> None:
            threshold = live()
            before, after = shared.add(batch, path, batch_id, key, minutes, self.cfg.watermark_seconds)
            found = shared.closing(batch.sparkSession, path, key, minutes, threshold, before, after)
            if found is not None:
                self._write_alerts(name, lambda counted: rules.shared_key_alerts(counted, rule, key, threshold))(found, batch_id)
            shared.done(batch.sparkSession, path, batch_id, before, after)

        return Stage(name, lambda: self._stream("on_time", _ON_TIME).select(key, "user_id", "event_ts", "arrival_seq"), sink)

    # --- the queries ----------------------------------------------------------------------

    def stages(self) -> list[Stage]:
        now, n = self.rules_now, F.count(F.lit(1))
        amount, events = (F.sum("amount"), F.sum), (n, F.sum)
        ok = (F.count_if(same_text(F.col("transaction_status"), "SUCCESS")), F.sum)
        alerts, metrics = self._write_alerts, self._write_metrics

        def rate(rows):
            dims = al.evidence(channel=F.col("channel"), success=F.col("success_count"), total=F.col("total"))
            return mt.as_metric(rows, mt.CHANNEL_SUCCESS_RATE, F.col("success_count") / F.col("total"), F.col("total"), "channel", dims)

        def merchant_sink(rows: DataFrame, batch_id: int) -> None:
            rows = rows.persist()  # else the state is worked out for each output
            try:
                metrics("merchant_amount", lambda r: mt.merchant_amount_5m(r))(rows, batch_id)
                out = rows.withColumn("cents", state.cents()).select(*_MERCHANT_WINDOW.names)
                tables.write_batch(out, self._table("merchant_windows"), batch_id, stateful=True)
            finally:
                rows.unpersist()

        def minute_metric(name):
            return lambda rows: mt.as_metric(rows, name, F.col("n"), F.col("n"))

        def alert_count(high: bool):
            def frame():
                rows = self.alerts()
                rows = rows.filter(same_text(F.col("risk_level"), "HIGH")) if high else rows
                return rows.groupBy(F.window("event_ts", "1 minute").alias("w")).agg(n.alias("n")).select(
                    "n", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")
                )

            return frame

        return [
            Stage("ingest", self.source, self._ingest, 0, state=False, planned_once=True),
            Stage("route", lambda: self._stream("parsed", _PARSED), self._route, 1, state=False, planned_once=True),
            Stage("user_frequency", lambda: self._windowed(["user_id"], 1, transaction_count=events),
                  alerts("user_frequency", lambda r: rules.frequency_alerts(r, now()))),
            Stage("user_amount", lambda: self._windowed(["user_id"], 5, success=True, total_amount=amount),
                  alerts("user_amount", lambda r: rules.amount_alerts(r, now()))),
            self._shared_key("device_users", config.R003, "device_id", lambda: now().device_users),
            self._shared_key("card_users", config.R004, "card_id", lambda: now().card_users),
            Stage("black_device", self.on_time, alerts("black_device", lambda r: rules.r006_black_device(self._listed(r))), state=False),
            Stage("consecutive_failure", self._failures, alerts("consecutive_failure", lambda r: rules.failure_alerts(r, now())), timers=True),
            Stage("user_spike", self._user_history, alerts("user_spike", lambda r: rules.user_spike_alerts(_history(r), now())), timers=True),
            Stage("merchant_amount", lambda: self._windowed(["merchant_id"], 5, success=True, amount=amount), merchant_sink),
            Stage("merchant_spike", self._merchant_history,
                  alerts("merchant_spike", lambda r: rules.merchant_spike_alerts(_history(r), now())), 3, timers=True),
            Stage("transaction_count", lambda: self._windowed([], 1, n=events),
                  metrics("transaction_count", minute_metric(mt.TRANSACTION_COUNT))),
            Stage("transaction_amount", lambda: self._windowed([], 5, success=True, amount=amount),
                  metrics("transaction_amount", lambda r: mt.as_metric(r, mt.TRANSACTION_AMOUNT, F.col("amount"), F.lit(0)))),
            Stage("channel_rate", lambda: self._windowed(["channel"], 5, total=events, success_count=ok),
                  metrics("channel_rate", rate)),
            Stage("alert_count", alert_count(False), metrics("alert_count", minute_metric(mt.ALERT_COUNT)), 4, "update"),
            Stage("high_alert_count", alert_count(True), metrics("high_alert_count", minute_metric(mt.HIGH_ALERT_COUNT)), 4, "update"),
            *([Stage("city_topn", lambda: self._windowed(["city"], 5, success=True, amount=amount), self._write_topn)] if self.cfg.city_topn else []),
            *([Stage("listed_events", self.on_time, self._write_listed, state=False)] if self.cfg.list_changes else []),
            *([Stage("user_features", self._all_alerts, self._write_features, 4, state=False)] if self.cfg.user_features else []),
            *([Stage("alert_cooldown", self._cooled, self._write_cooled, 4, timers=True)] if self.cfg.cooldown_minutes else []),
        ]

    def _failures(self) -> DataFrame:
        rows = self._stream("on_time", _ON_TIME).withColumn(
            "failed", same_text(F.col("transaction_status"), "FAILED")
        )
        rows = rows.select("user_id", "arrival_seq", "failed", F.col("ingest_ms").alias("clock_ms"), *rules.EVENT_COLUMNS).withColumn("amount", F.col("amount").cast("string"))
        return state.failure_runs(rows, self._least(self.cfg.rules.consecutive_failures), buckets=state.BUCKETS)

    def _user_history(self) -> DataFrame:
        rows = prepare.successful_payments(self._stream("on_time", _ON_TIME))
        rows = rows.select(
            "user_id", "arrival_seq", F.col("ingest_ms").alias("clock_ms"), *rules.EVENT_COLUMNS, state.cents().alias("cents")
        ).drop("amount")
        return state.amount_history(
            rows, "user_id", "arrival_seq", self._least(self.cfg.rules.user_spike_min_samples), state.USER_MEAN_TTL_MS,
            buckets=state.BUCKETS, above=self._mean_multiple(self.cfg.rules.user_spike_multiplier),
        )

    def _merchant_history(self) -> DataFrame:
        # windows follow each other by their ends
        rows = self._stream("merchant_windows", _MERCHANT_WINDOW).withColumn("clock_ms", F.unix_millis("window_end"))
        return state.amount_history(
            rows, "merchant_id", "window_end", self._least(self.cfg.rules.merchant_spike_min_windows), state.MERCHANT_MEAN_TTL_MS,
            buckets=state.BUCKETS, above=self._mean_multiple(self.cfg.rules.merchant_spike_multiplier),
        )

    def start(self, stage: Stage, every: int | None = None, settings: dict[str, str] | None = None) -> StreamingQuery:
        seconds = self.cfg.trigger_seconds if every is None else every
        writer = (
            stage.frame().writeStream.queryName(stage.name).outputMode(stage.mode)
            .option("checkpointLocation", f"{self.cfg.checkpoint_dir}/queries/{stage.name}")
            .foreachBatch(stage.sink).trigger(processingTime=f"{seconds} seconds")
        )
        settings = dict(settings or {})
        if (stage.state or stage.planned_once) and self.cfg.state_partitions:
            settings["spark.sql.shuffle.partitions"] = str(self.cfg.state_partitions)
            settings |= _PLANNED_ONCE if stage.planned_once else {}
        # a query copies the settings when it starts; with a checkpoint the first count of partitions stays
        conf = self.spark.conf
        before = {key: conf.get(key, None) for key in settings}
        try:
            for key, value in settings.items():
                conf.set(key, value)
            return writer.start()
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)

    def run(self) -> list[StreamingQuery]:
        """Start all queries; they run until stopped."""
        return [self.start(stage) for stage in self.stages()]

    def catch_up(self, names: list[str] | None = None) -> None:
        """Process what is there now, then stop; ``names`` picks stages.

        The queries and their checkpoints are those of ``run``.  As there, the
        levels run side by side, so a stage works on a batch while the one before
        it makes the next; each is waited for when those below it have ended.
        Stages that follow alerts start when all alerts are there.  Queries with
        timers have no micro-batches without input here: there would be no end of
        them, and state that is too old is passed over when it is read.
        """
        stages = [s for s in self.stages() if names is None or s.name in names]
        of_events = sorted((s for s in stages if s.level < _ALERT_LEVEL), key=lambda s: s.level)
        for part in (of_events, [s for s in stages if s.level >= _ALERT_LEVEL]):
            started = []
            try:
                for s in part:
                    started.append(self.start(s, every=0, settings=_POLLING | (_NO_EMPTY_BATCHES if s.timers else {})))
                for running in started:
                    running.processAllAvailable()
            finally:
                for running in started:
                    running.stop()

    def outputs(self) -> list[str]:
        """Folders of JSON lines that the job has published so far."""
        cooled = self.cfg.cooled_output or f"{self.cfg.alert_output}-cooled"
        found = [self.cfg.late_output, self.cfg.dead_letter_output, cooled]
        for root in (self.cfg.alert_output, self.cfg.metric_output):
            found += [f"{root}/{name}" for name in tables.folder_names(self.spark, root) if not name.endswith("-rolled")]
        return [path for path in found if tables.exists(self.spark, path)]

    def roll(self) -> int:
        """Roll what is due in all outputs and remove what was rolled long enough ago; the number of batches rolled.

        May run beside the queries, again and again, as one job at a time.
        """
        rolled = 0
        for path in self.outputs():
            rolled += rolling.roll(
                self.spark, path, "json", self.cfg.roll_bytes, self.cfg.roll_seconds, self.cfg.idle_seconds
            )
            rolling.retire(self.spark, path, self.cfg.keep_seconds)
        return rolled


def _history(rows: DataFrame) -> DataFrame:
    return rows.withColumn("amount", state.money("cents").cast(schemas.MONEY)).withColumn(
        "history_total", state.money("history_cents")
    )


def text_source(spark: SparkSession, path: str, max_files: int = 1000) -> Callable[[], DataFrame]:
    """Raw events from text files that appear in a folder, one JSON document per line."""
    return lambda: spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def numbered_source(spark: SparkSession, path: str, max_files: int = 1000) -> Callable[[], DataFrame]:
    """Raw events from parquet files with ``value`` and a number of arrival, ``arrival_seq``."""
    schema = "value string, arrival_seq bigint"
    return lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
