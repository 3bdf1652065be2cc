"""Anti-money-laundering rows to payment events: column expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigilpay.functions.ids import stable_hash, stable_int
from vigilpay.functions.times import iso_text
from vigilpay.schemas import MONEY

# --- fixed values: country to (province, city) ------------------------------
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
TRUE_WORDS = ["true", "1", "yes", "y"]
HIGH_SCORE, BLACK_SCORE, BLACK_CARD_AMOUNT, FAILED_PER_MILLE = 0.85, 0.97, 50000, 4
# ---------------------------------------------------------------------------

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
UNSET = "1970-01-01T00:00:00Z"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _first_filled(*names: str) -> Column:
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names])


def parse_bool(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(TRUE_WORDS), F.lit(False))


def parse_float(text: Column) -> Column:
    """A finite number, or 0 for anything that is not one.

    The pattern keeps out what a cast to double would take besides: type
    suffixes as in "5d", "nan" and "inf".
    """
    number = F.when(F.trim(text).rlike(_NUMBER), F.trim(text).try_cast("double"))
    return F.coalesce(F.when(F.abs(number) < F.lit(float("inf")), number), F.lit(0.0))


def iso_timestamp(text: Column, as_of: str = UNSET) -> Column:
    """The instant in UTC as ISO text; blank text becomes ``as_of``."""
    filled = F.coalesce(F.nullif(text, F.lit("")), F.lit(as_of))
    return iso_text(F.try_to_timestamp(filled))


def payment_method(payment_format: Column) -> Column:
    upper = F.upper(F.coalesce(payment_format, F.lit("")))
    return (
        F.when(upper.rlike("CARD|CREDIT"), "CREDIT_CARD")
        .when(upper.rlike("CHECK|CHEQUE"), "BANK_CARD")
        .when(upper.contains("CASH"), "BALANCE")
        .otherwise("BANK_CARD")
    )


def transaction_type(payment_format: Column) -> Column:
    upper = F.upper(F.coalesce(payment_format, F.lit("")))
    return (
        F.when(upper.contains("REINVEST"), "TRANSFER")
        .when(upper.contains("WITHDRAW"), "WITHDRAW")
        .otherwise("PAY")
    )


def country_location(country: Column) -> tuple[Column, Column]:
    """Province and city of a country code."""
    place = lambda p: F.struct(F.lit(p[0]).alias("province"), F.lit(p[1]).alias("city"))
    pairs = [c for code, p in COUNTRY_LOCATION.items() for c in (F.lit(code), place(p))]
    known = F.element_at(F.create_map(*pairs), F.upper(F.coalesce(country, F.lit(""))))
    unknown_city = F.coalesce(F.nullif(country, F.lit("")), F.lit("Unknown"))
    return (
        F.coalesce(known["province"], F.lit("Global")),
        F.coalesce(known["city"], unknown_city),
    )


def risk_label(laundering: Column, predicted: Column, score: Column) -> Column:
    return (
        F.when(laundering, "AML_LAUNDERING").when(predicted, "MODEL_ALERT")
        .when(score >= HIGH_SCORE, "HIGH_MODEL_SCORE").otherwise("NORMAL")
    )


def _with_basics(rows: DataFrame, as_of: str) -> DataFrame:
    """Typed and defaulted inputs of the mapping."""
    whole_row = F.concat_ws("|", *[_text(c) for c in rows.columns])
    time = "timestamp" if "timestamp" in rows.columns else "event_ts"
    # numbers are parsed once per row: filters and columns above stop at the generator
    parsed = F.struct(
        parse_float(F.col("model_score")).alias("_score"),
        parse_float(_first_filled("amount_paid", "amount_received")).alias("_value"),
    )
    numbers = rows.select("*", F.explode(F.array(parsed)).alias("_numbers")).select("*", "_numbers.*").drop("_numbers")
    return (
        numbers.withColumn("_key", F.coalesce(F.nullif(F.col("record_key"), F.lit("")), whole_row))
        .withColumn("_laundering", parse_bool(F.col("is_laundering")))
        .withColumn("_predicted", parse_bool(F.col("predicted_alert")))
        .withColumn("_amount", F.col("_value").try_cast(MONEY))
        .withColumn("_event_time", iso_timestamp(F.col(time), as_of))
    )


def unmappable(rows: DataFrame) -> DataFrame:
    """Rows whose amount does not fit the money type; ``to_transactions`` leaves them out."""
    names = [c for c in rows.columns]
    return _with_basics(rows, UNSET).filter(F.col("_amount").isNull()).select(*names)


def to_transactions(rows: DataFrame, as_of: str = UNSET) -> DataFrame:
    """The published event for every row whose amount fits; ``as_of`` stands in for a blank time."""
    df = _with_basics(rows, as_of).filter(F.col("_amount").isNotNull())
    key, account, to_account = F.col("_key"), _text("from_account"), _text("to_account")
    event_hash = stable_hash(key, 24)
    province, city = country_location(F.col("from_country"))
    tag = lambda prefix, value: F.concat(F.lit(prefix), value)
    number = lambda value: value.cast("string")
    octet = lambda value: number(stable_int(value, 240) + 1)
    process = F.try_to_timestamp(F.col("_event_time")) + F.make_dt_interval(
        secs=stable_int(key, 3600)
    )
    currency = F.coalesce(_first_filled("payment_currency", "receiving_currency"), F.lit("USD"))
    channel = F.element_at(
        F.array(*[F.lit(c) for c in CHANNEL_ORDER]), (stable_int(key, 5) + 1).cast("int")
    )
    return df.select(
        tag("evt-aml-", event_hash).alias("event_id"),
        tag("txn-aml-", event_hash).alias("transaction_id"),
        tag("user-", stable_hash(account, 10)).alias("user_id"),
        tag("acct-", account).alias("account_id"),
        tag("card-", stable_hash(F.concat(account, _text("from_bank")), 12)).alias("card_id"),
        tag("merchant-", stable_hash(F.concat(_text("to_bank"), to_account), 12)).alias("merchant_id"),
        tag("device-", stable_hash(F.concat(account, _text("from_country")), 12)).alias("device_id"),
        F.concat_ws(".", F.lit("10"), octet(account), octet(to_account), octet(key)).alias("ip"),
        province.alias("province"),
        city.alias("city"),
        F.col("_amount").alias("amount"),
        F.replace(currency, F.lit("US Dollar"), F.lit("USD")).alias("currency"),
        payment_method(F.col("payment_format")).alias("payment_method"),
        transaction_type(F.col("payment_format")).alias("transaction_type"),
        F.when(stable_int(key, 1000) < FAILED_PER_MILLE, "FAILED").otherwise("SUCCESS")
        .alias("transaction_status"),
        F.col("_event_time").alias("event_time"),
        iso_text(process).alias("process_time"),
        channel.alias("channel"),
        F.concat_ws(
            ".", number(stable_int(account, 2) + 6), number(stable_int(to_account, 10)),
            number(stable_int(key, 10)),
        ).alias("app_version"),
        (F.col("_laundering") | (F.col("_score") >= BLACK_SCORE)).alias("is_black_device"),
        (F.col("_laundering") & (F.col("_value") >= BLACK_CARD_AMOUNT)).alias("is_black_card"),
        risk_label(F.col("_laundering"), F.col("_predicted"), F.col("_score")).alias("risk_label"),
    )


def conversion_summary(transactions: DataFrame, skipped: int = 0) -> DataFrame:
    """One row about a conversion: rows, laundering rows, total and largest amount."""
    return transactions.agg(
        F.count(F.lit(1)).alias("converted_rows"),
        F.lit(skipped).cast("bigint").alias("skipped_rows"),
        F.count_if(F.col("risk_label") == "AML_LAUNDERING").alias("laundering_rows"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_amount"),
        F.coalesce(F.max("amount"), F.lit(0)).alias("max_amount"),
    )
