"""Driver tables as payment events, so every operator can run on them.

Event times are compressed 2,880 times, some arrivals are delayed and some
events arrive twice; integer microseconds keep all engines in agreement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigilpay.functions.times import iso_text
from vigilpay.schemas import CHANNELS, PAYMENT_METHODS, TRANSACTION_FIELDS, TRANSACTION_TYPES

EPOCH_US = 1_704_067_200_000_000
COMPRESSION = 2880
DELAY_EVERY, DELAY_ARRIVALS = 97, 1000
COPY_EVERY, COPY_AFTER = 11, 3

PROVINCES, CITIES = 5, 7
AML_COUNTRIES = ["US", "CN", "SG", "UK", "DE", "FR", "JP", "KR", "AU", "CA", "BR", ""]


def _pick(values: list[str], index: Column) -> Column:
    """The element of a fixed list at ``index`` (from zero)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrivals(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """The ``events`` table as typed payment events, copies and delays included.

    With ``ranges``, in as many partitions of consecutive arrivals, dealt out
    while the rows are narrow.
    """
    src = read_table(spark, sf_dir, "events")
    event_id, user = F.col("event_id"), F.col("user_id")
    # microseconds of a zone-less timestamp, independent of the session zone
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    k = F.get_json_object("props", "$.k").cast("int")
    # Up to three arrivals fall on one place: a delayed event, a copy and an event
    # on time.  Four numbers per place keep them apart, in order of event id.
    first = F.when(event_id % DELAY_EVERY == 0, (event_id + DELAY_ARRIVALS) * 4).otherwise(
        event_id * 4 + 2
    )
    copy = (event_id + COPY_AFTER) * 4 + 1
    seqs = F.when(event_id % COPY_EVERY == 0, F.array(first, copy)).otherwise(F.array(first))
    src = src.select("*", F.posexplode(seqs).alias("copy", "arrival_seq"))
    # ranges are found by a pass of its own over the rows, so fields are taken out of the text after it
    src = src.repartitionByRange(ranges, "arrival_seq") if ranges else src
    src = src.select(
        event_id, user, "event_type", "value", k.alias("k"), micros.alias("_us"), "copy", "arrival_seq"
    ).withColumn("us", F.expr(f"{EPOCH_US} + (_us - {EPOCH_US}) div {COMPRESSION}"))
    amount = (F.col("value") * 100).cast("decimal(18,2)")
    black = F.col("k") % 25 == 0
    event_ts = F.timestamp_micros("us")
    process_ts = F.timestamp_micros(F.col("us") + 250_000 + F.col("copy") * 1_000_000)
    label = (
        F.when(black, "BLACK_DEVICE").when(amount > 20000, "LARGE_AMOUNT").otherwise("NORMAL")
    )
    tag = lambda prefix, value: F.concat(F.lit(prefix), value.cast("string"))
    return src.select(
        tag("evt-", event_id).alias("event_id"),
        tag("txn-", event_id).alias("transaction_id"),
        tag("user-", user).alias("user_id"),
        tag("acct-", user).alias("account_id"),
        tag("card-", F.col("k") % 37).alias("card_id"),
        tag("merchant-", F.col("k")).alias("merchant_id"),
        tag("device-", F.col("k")).alias("device_id"),
        tag("10.0.0.", F.col("k")).alias("ip"),
        tag("province-", user % PROVINCES).alias("province"),
        tag("city-", user % CITIES).alias("city"),
        amount.alias("amount"),
        F.lit("CNY").alias("currency"),
        _pick(PAYMENT_METHODS, event_id % 5).alias("payment_method"),
        _pick(TRANSACTION_TYPES, event_id % 4).alias("transaction_type"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("transaction_status"),
        iso_text(event_ts).alias("event_time"),
        iso_text(process_ts).alias("process_time"),
        _pick(CHANNELS, event_id % 5).alias("channel"),
        F.lit("6.0.0").alias("app_version"),
        black.alias("is_black_device"),
        F.lit(False).alias("is_black_card"),
        label.alias("risk_label"),
        event_ts.alias("event_ts"),
        F.col("arrival_seq"),
    )


def aml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with their customers as rows of the anti-money-laundering file, all text."""
    orders = read_table(spark, sf_dir, "orders")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o, nation = F.col("o_orderkey"), F.col("c_nationkey")
    priority = F.col("o_orderpriority")
    payment_format = (
        F.when(priority == "1-URGENT", "Credit Card").when(priority == "2-HIGH", "Cheque")
        .when(priority == "3-MEDIUM", "Cash").when(priority == "4-NOT SPECIFIED", "Reinvestment")
        .otherwise("Withdrawal")
    )
    text = lambda c: c.cast("string")
    price = text(F.col("o_totalprice").cast("decimal(18,2)"))
    currency = F.when(nation % 2 == 0, "US Dollar").otherwise("Euro")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(o % 13 == 0, "").otherwise(text(o)).alias("record_key"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:08:00Z")).alias("timestamp"),
        F.concat(F.lit("Bank "), text(nation)).alias("from_bank"),
        text(F.col("o_custkey")).alias("from_account"),
        _pick(AML_COUNTRIES, nation % len(AML_COUNTRIES)).alias("from_country"),
        F.concat(F.lit("Bank "), text(o % 50)).alias("to_bank"),
        text(o % 1000).alias("to_account"),
        F.lit("US").alias("to_country"),
        price.alias("amount_received"),
        currency.alias("receiving_currency"),
        F.when(o % 7 == 0, "").otherwise(price).alias("amount_paid"),
        F.when(o % 5 == 0, "").otherwise(currency).alias("payment_currency"),
        payment_format.alias("payment_format"),
        F.when(o % 101 == 0, " True ").otherwise("False").alias("is_laundering"),
        F.when(o % 53 == 0, "yes").otherwise("no").alias("predicted_alert"),
        F.when(o % 17 == 0, "n/a").otherwise(
            text((o % 1000 / 1000).cast("decimal(4,3)"))
        ).alias("model_score"),
        F.lit("False").alias("is_dashboard_sample"),
    )


#: defects put into the raw text, by event number: (divisor, reject reason)
DEFECTS = [
    (83, "malformed_json"), (89, "missing_required_field"), (79, "missing_enum_field"),
    (73, "negative_amount"), (71, "bad_event_time"), (67, "bad_amount"),
]


def raw_lines(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """The arrivals as JSON text, ``value``, some of them broken, with ``event_no`` and ``arrival_ts``.

    Amounts are quoted on every third event, one in ten has an unknown field.
    ``ranges`` as in ``arrivals``.
    """
    events = arrivals(spark, sf_dir, ranges).withColumn(
        "event_no", F.expr("cast(substring(event_id, 5) as bigint)")
    )
    no = F.col("event_no")
    hit = {reason: no % n == 0 for n, reason in DEFECTS}
    changed = (
        events.withColumn("user_id", F.when(hit["missing_required_field"], "  ").otherwise(F.col("user_id")))
        .withColumn("channel", F.when(~hit["missing_enum_field"], F.col("channel")))
        .withColumn("event_time_out", F.when(hit["bad_event_time"], F.substring("event_time", 1, 10))
                    .otherwise(F.col("event_time")))
        .withColumn("amount_out", F.when(hit["negative_amount"], -F.col("amount") - 1)
                    .otherwise(F.col("amount")))
    )
    quoted = F.when(hit["bad_amount"], "NaN").when(no % 3 == 0, F.col("amount_out").cast("string"))
    others = [
        c for c in TRANSACTION_FIELDS if c not in ("amount", "event_time")
    ]
    fields = F.struct(
        *others, F.col("event_time_out").alias("event_time"), F.lit("@").alias("amount"),
        F.when(no % 10 == 0, "x").alias("unknown_field"),
    )
    body = F.to_json(fields)
    # put the amount in as a bare number or as text
    number = F.when(quoted.isNull(), F.col("amount_out").cast("string")).otherwise(
        F.concat(F.lit('"'), quoted, F.lit('"'))
    )
    body = F.replace(body, F.lit('"@"'), number)
    value = F.when(hit["malformed_json"], F.substring("_body", 1, 40)).otherwise(
        F.col("_body")
    )
    return changed.withColumn("_body", body).select(
        "event_no", "arrival_seq",
        F.try_to_timestamp(F.col("process_time")).alias("arrival_ts"),
        # built once per row, as if read: filters on the text stop here
        F.explode_outer(F.array(value)).alias("value"),
    )
