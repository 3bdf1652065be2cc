"""Aggregations behind the risk dashboard, over events, alerts and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from vigilpay.functions.scores import event_risk_score, log_amount, or_default, same_text
from vigilpay.operators import scans

_DEFAULT = {"risk_label": "NORMAL"}


def key_of(name: str):
    return or_default(F.col(name), _DEFAULT.get(name, "UNKNOWN"))


def with_risk_score(events: DataFrame) -> DataFrame:
    return events.withColumn("risk_score", event_risk_score())


def group_count(rows: DataFrame, key: str) -> DataFrame:
    name = or_default(F.col(key), "UNKNOWN").alias("name")
    return (
        rows.groupBy(name).agg(F.count(F.lit(1)).alias("value")).orderBy(F.desc("value"), "name")
    )


def top_amount(events: DataFrame, key: str, limit: int = 10) -> DataFrame:
    name = or_default(F.col(key), "UNKNOWN").alias("name")
    return (
        events.groupBy(name).agg(F.sum("amount").alias("value"))
        .orderBy(F.desc("value"), "name").limit(limit)
    )


def time_series(events: DataFrame, buckets: int = 36) -> DataFrame:
    """Events in event-time order cut into ``buckets`` chunks of equal row count.

    The last row of each chunk is found by ``scans.ranks_picked``, which counts
    instead of sorting; chunks are then plain groups below those rows.
    """
    size = events.agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / buckets), F.lit(1)).alias("chunk")
    ).scalar()
    ts = F.unix_micros("event_ts")
    # no level has more cells in one of the level before than a task can order
    levels = [F.floor(F.unix_seconds("event_ts") / 3600), F.unix_seconds("event_ts"), F.unix_millis("event_ts"), ts,
              F.shiftright("arrival_seq", scans.BLOCK_BITS), F.col("arrival_seq")]
    ends = scans.ranks_picked(events, levels, every=size, first=size, limit=buckets)
    ends = ends.agg(
        F.array_sort(F.collect_list(F.struct(F.col("_l3").alias("us"), F.col("_l5").alias("seq"))))
    ).scalar()
    # Chunk number of a row: how many chunk ends (at most ``buckets``) precede it.
    # Rows after the last full chunk form the last, shorter one.
    here = F.struct(ts.alias("us"), F.col("arrival_seq").alias("seq"))
    chunk = F.aggregate(
        F.col("_ends"), F.lit(0), lambda n, end: n + (end < F.col("_here")).cast("int")
    )
    score = event_risk_score()
    return (
        events.select(
            here.alias("_here"), ends.alias("_ends"), "amount", "event_ts",
            same_text(F.col("transaction_status"), "FAILED").alias("failed"), score.alias("risk"),
        )
        .groupBy(chunk.alias("chunk"))
        .agg(
            F.max("event_ts").alias("last_ts"),
            F.count(F.lit(1)).alias("count"),
            F.sum("amount").alias("amount"),
            F.count_if("failed").alias("failed"),
            F.round(F.avg("risk"), 2).alias("risk"),
        )
        .select(
            "chunk", F.date_format("last_ts", "HH:mm").alias("time"), "count", "amount", "failed", "risk"
        )
    )


def risk_scatter(events: DataFrame, limit: int = 800) -> DataFrame:
    """Every k-th event in arrival order, k chosen to give about ``limit`` points."""
    step = events.agg(
        F.greatest(F.floor(F.count(F.lit(1)) / limit), F.lit(1)).alias("step")
    ).scalar()
    seq = F.col("arrival_seq")
    bits = scans.BLOCK_BITS
    levels = [F.shiftright(seq, bits + scans.GROUP_BITS), F.shiftright(seq, bits), seq]
    picked = scans.ranks_picked(events, levels, every=step, first=1, limit=limit)
    picked = picked.select(F.col("_l2").alias("arrival_seq"), "_rank")
    index = F.concat(F.lit("event-"), ((F.col("_rank") - 1) / step).cast("bigint").cast("string"))
    # the picked numbers: at most ``limit`` rows
    return events.join(F.broadcast(picked), "arrival_seq").select(
        F.hour("event_ts").alias("hour"),
        F.round(log_amount(F.col("amount")), 4).alias("log_amount"),
        event_risk_score().alias("risk"),
        key_of("channel").alias("channel"),
        key_of("risk_label").alias("risk_label"),
        F.coalesce(
            F.nullif("transaction_id", F.lit("")), F.nullif("event_id", F.lit("")), index
        ).alias("id"),
    )


def channel_label_heatmap(events: DataFrame) -> DataFrame:
    """Counts per channel and label, with the position of each on its sorted axis."""
    cells = events.groupBy(
        key_of("channel").alias("channel"), key_of("risk_label").alias("risk_label")
    ).agg(F.count(F.lit(1)).alias("value"))
    # windows over the few cells, not over events
    axis = lambda name: F.dense_rank().over(Window.orderBy(name)) - 1
    return cells.withColumn("x", axis("channel")).withColumn("y", axis("risk_label"))


def flow_links(events: DataFrame, limit: int = 12) -> DataFrame:
    """The i-th largest merchant beside the i-th largest city, cities repeating."""
    place = F.row_number().over(Window.orderBy(F.desc("value"), "name")) - 1
    # both sides hold at most ``limit`` rows from here on
    merchants = top_amount(events, "merchant_id", limit).withColumn("position", place)
    cities = top_amount(events, "city", limit).withColumn("place", place)
    cities = cities.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    turns = cities.select(
        F.col("name").alias("source"),
        F.explode(
            F.sequence(F.col("place").cast("int"), F.lit(limit - 1), F.col("n").cast("int"))
        ).alias("position"),
    )
    return merchants.join(turns, "position", "left").select(
        "position", F.coalesce("source", F.lit("Global")).alias("source"),
        F.col("name").alias("target"), "value",
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames side by side."""
    names = [c for f in frames for c in f.columns]
    parts = [f.select(*[F.col(c) if c in f.columns else F.lit(None).alias(c) for c in names]) for f in frames]
    return reduce(DataFrame.union, parts).agg(*[F.max(c).alias(c) for c in names])


def _event_facts(events: DataFrame) -> DataFrame:
    return with_risk_score(events).agg(
        F.count(F.lit(1)).alias("event_sample_count"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("sample_amount"),
        F.coalesce(F.round(F.avg("risk_score"), 2), F.lit(0)).alias("avg_risk_score"),
    )


def _alert_facts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.count_if(same_text(F.col("risk_level"), "HIGH")).alias("high_alert_count"),
    )


def overview(events: DataFrame, alerts: DataFrame, late: DataFrame, conversion: DataFrame) -> DataFrame:
    """Headline numbers; ``conversion`` is the summary of ``aml.conversion_summary`` or ``aml.convert_file``."""
    size = F.col("source_size_bytes") if "source_size_bytes" in conversion.columns else F.lit(0).cast("bigint")
    return one_row(
        _event_facts(events),
        _alert_facts(alerts),
        late.agg(F.count(F.lit(1)).alias("late_event_count")),
        conversion.select(
            F.col("converted_rows").alias("enterprise_converted_rows"), size.alias("enterprise_source_size_bytes"), "max_amount"
        ),
    )


def insight_facts(
    events: DataFrame, alerts: DataFrame, conversion: DataFrame, series: DataFrame
) -> DataFrame:
    peak = series.orderBy(F.desc("amount"), "chunk").limit(1).select(
        F.col("time").alias("peak_time"), F.col("amount").alias("peak_amount")
    )
    channel = group_count(events, "channel").limit(1).select(
        F.col("name").alias("top_channel"), F.col("value").alias("top_channel_count")
    )
    density = conversion.select(
        F.when(
            F.col("converted_rows") > 0,
            F.col("laundering_rows") / F.col("converted_rows") * 100,
        ).alias("aml_label_density_pct")
    )
    return one_row(
        _event_facts(events).select("avg_risk_score"),
        peak, channel, _alert_facts(alerts).select("high_alert_count"), density,
    )


def recent(rows: DataFrame, time: str, ident: str, limit: int = 30) -> DataFrame:
    return rows.orderBy(F.desc(time), F.desc(ident)).limit(limit)


def filter_scatter(
    points: DataFrame, channel: str = "ALL", risk: str = "ALL", amount_pct: float = 0
) -> DataFrame:
    if channel != "ALL":
        points = points.filter(F.col("channel") == channel)
    if risk != "ALL":
        points = points.filter(F.col("risk_label") == risk)
    return points.filter(F.col("log_amount") >= amount_pct / 100 * 10)


def filter_alerts(alerts: DataFrame, rule_id: str = "ALL", limit: int = 16) -> DataFrame:
    """The newest alerts of one rule, or of all."""
    if rule_id != "ALL":
        alerts = alerts.filter(F.col("rule_id") == rule_id)
    return recent(alerts, "alert_time", "alert_id", limit)
