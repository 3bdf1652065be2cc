"""Parsing raw JSON events, routing rejects, and checking the published contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vigilpay import schemas
from vigilpay.functions.scores import is_blank
from vigilpay.functions.times import parse_instant

REQUIRED = [
    "event_id", "user_id", "transaction_id", "device_id", "card_id", "merchant_id", "event_time",
]
REQUIRED_ENUMS = ["channel", "transaction_status", "transaction_type"]

#: reject reasons, in the order they are checked
REASONS = [
    "malformed_json", "missing_required_field", "missing_enum_field",
    "bad_amount", "negative_amount", "bad_flag", "bad_event_time",
]

_CORRUPT = "_corrupt"
# A number as JSON or Java would write it; the guard keeps out "NaN" and the like.
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _flag(column: Column) -> Column:
    """A JSON boolean given bare or quoted; missing means false, anything else is null."""
    return F.when(column.isNull(), F.lit(False)).otherwise(column.try_cast("boolean"))


def parse_transactions(raw: DataFrame, value: str = "value") -> DataFrame:
    """Raw JSON text to typed events with ``reject_reason``, null for good rows.

    All fields are read as text and cast afterwards, so a quoted number is
    still a number and one bad field does not void the others.  Unknown fields
    are ignored; a missing amount is 0 and a missing flag false.  Other columns
    of ``raw`` are kept.
    """
    with_corrupt = T.StructType(
        schemas.TRANSACTION_TEXT.fields + [T.StructField(_CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # A projected struct would be parsed again for every filter on its fields;
    # a generator parses each row once.
    columns = raw.columns
    document = F.array(F.from_json(F.col(value), with_corrupt, options))
    names = [f"_{n}" for n in with_corrupt.names]
    parsed = raw.select(*columns, F.inline_outer(document).alias(*names))
    field = lambda name: F.col(f"_{name}")

    malformed = field(_CORRUPT).isNotNull() | ~F.coalesce(
        F.col(value).rlike(r"^\s*\{"), F.lit(False)
    )
    amount = F.when(field("amount").isNull(), F.lit(0)).otherwise(
        F.when(field("amount").rlike(_NUMBER), F.trim(field("amount")).try_cast(schemas.MONEY))
    )
    event_ts = parse_instant(field("event_time"))
    black_device, black_card = _flag(field("is_black_device")), _flag(field("is_black_card"))
    any_blank = lambda names: _any(*[is_blank(field(n)) for n in names])
    checks = [
        malformed, any_blank(REQUIRED), any_blank(REQUIRED_ENUMS),
        amount.isNull(), amount < 0, black_device.isNull() | black_card.isNull(), event_ts.isNull(),
    ]
    reason = F.coalesce(*[F.when(c, F.lit(r)) for c, r in zip(checks, REASONS)])

    typed = {
        "amount": amount.cast(schemas.MONEY),
        "is_black_device": black_device,
        "is_black_card": black_card,
    }
    fields = [typed.get(f, field(f)).alias(f) for f in schemas.TRANSACTION_FIELDS]
    return parsed.select(
        *columns, *fields, event_ts.alias("event_ts"), reason.alias("reject_reason")
    )


def _any(*conditions: Column) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def dead_letters(
    parsed: DataFrame, topic: str, created_at: Column, value: str = "value"
) -> DataFrame:
    """Rejected rows as the original text, with the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        F.lit(topic).alias("topic"),
        F.col(value).alias("raw_event"),
        F.col("reject_reason").alias("error_message"),
        created_at.alias("created_at"),
    )


# --- the published contract, checked only on request ------------------------

def _enums(kind: str) -> dict[str, list[str]]:
    if kind == "transaction":
        return {
            "currency": schemas.CURRENCIES, "payment_method": schemas.PAYMENT_METHODS,
            "transaction_type": schemas.TRANSACTION_TYPES,
            "transaction_status": schemas.TRANSACTION_STATUSES, "channel": schemas.CHANNELS,
        }
    return {"event_type": schemas.USER_EVENT_TYPES, "channel": schemas.CHANNELS}


def _violations(doc: Column, value: Column, kind: str) -> Column:
    """Array of ``(field, rule)`` for one document; an unreadable one breaks ``$``."""
    fields = schemas.TRANSACTION_FIELDS if kind == "transaction" else schemas.USER_EVENT_FIELDS
    expected = {"amount": "number", "is_black_device": "boolean", "is_black_card": "boolean"}
    enums = _enums(kind)

    def broken(cond: Column, name: str, rule: str) -> Column:
        return F.when(cond, F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule")))

    checks = []
    for name in fields:
        item = F.try_variant_get(doc, f"$.{name}", "variant")
        shape = F.schema_of_variant(item)
        text = F.try_variant_get(doc, f"$.{name}", "string")
        present = item.isNotNull()
        want = expected.get(name, "string")
        is_type = {
            "string": shape == "STRING",
            "number": shape.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"),
            "boolean": shape == "BOOLEAN",
        }[want]
        checks.append(broken(~present, name, "required"))
        checks.append(broken(present & ~is_type, name, "type"))
        if name == "event_id":
            short = F.length(text) < schemas.EVENT_ID_MIN_LENGTH
            checks.append(broken(present & is_type & short, name, "minLength"))
        if name == "amount":
            number = F.try_variant_get(doc, "$.amount", "double")
            checks.append(broken(present & is_type & (number < 0), name, "minimum"))
        if name in enums:
            allowed = is_type & text.isin(enums[name])
            checks.append(broken(present & ~allowed, name, "enum"))
    extra = F.array_except(F.json_object_keys(value), F.array(*[F.lit(f) for f in fields]))
    unknown = F.transform(
        extra, lambda k: F.struct(k.alias("field"), F.lit("additionalProperties").alias("rule"))
    )
    found = F.filter(F.array(*checks), lambda c: c.isNotNull())
    readable = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    whole = F.array(F.struct(F.lit("$").alias("field"), F.lit("type").alias("rule")))
    return F.when(readable, F.concat(found, unknown)).otherwise(whole)


def _with_document(raw: DataFrame, value: str) -> DataFrame:
    return raw.withColumn("_doc", F.try_parse_json(F.col(value)))


def schema_violations(raw: DataFrame, kind: str = "transaction", value: str = "value") -> DataFrame:
    """One row per broken rule of the ``transaction`` or ``user`` event contract."""
    found = _violations(F.col("_doc"), F.col(value), kind)
    return (
        _with_document(raw, value)
        .withColumn("_v", F.explode(found))
        .select(*raw.columns, F.col("_v.field").alias("field"), F.col("_v.rule").alias("rule"))
    )


def schema_discriminate(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add which contract a document meets: it must be exactly one of the two."""
    ok = lambda kind: F.size(_violations(F.col("_doc"), F.col(value), kind)) == 0
    flags = _with_document(raw, value).select(
        *raw.columns, ok("transaction").alias("is_transaction"), ok("user").alias("is_user_event")
    )
    return flags.withColumn(
        "is_valid", (F.col("is_transaction").cast("int") + F.col("is_user_event").cast("int")) == 1
    )
