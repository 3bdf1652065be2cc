"""Kafka source and sink frames.  The connector jar is the cluster's to provide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from vigilpay.config import StreamConfig


def source_options(cfg: StreamConfig) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "subscribe": cfg.transaction_topic,
        "startingOffsets": cfg.starting_offsets,
        "maxOffsetsPerTrigger": str(cfg.max_offsets_per_trigger),
        "failOnDataLoss": "true",
        "kafka.group.id": "risk-monitor",
    }


def reader(spark: SparkSession, cfg: StreamConfig) -> DataStreamReader:
    return spark.readStream.format("kafka").options(**source_options(cfg))


def raw_transactions(records: DataFrame) -> DataFrame:
    """Kafka records to ``value`` text with the order of arrival.

    Offsets order one partition only; records of different partitions are put
    in order by their time in the log.
    """
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.struct("timestamp", "partition", "offset").alias("arrival_order"),
    )


def transactions(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    return raw_transactions(reader(spark, cfg).load())


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def keyed_records(events: DataFrame, process_time: Column | None = None) -> DataFrame:
    """``key`` and ``value`` to publish: keyed by user, else device, else event id.

    With ``process_time`` given, events are stamped with it.
    """
    if process_time is not None:
        events = events.withColumn("process_time", process_time)
    return events.select(
        F.coalesce(_filled("user_id"), _filled("device_id"), F.col("event_id")).alias("key"),
        F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def publish(records: DataFrame, cfg: StreamConfig) -> None:
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
        .option("topic", cfg.transaction_topic)
        .save()
    )
