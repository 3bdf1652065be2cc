"""JSON-lines, CSV and table sources, and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from vigilpay import schemas
from vigilpay.functions.times import millis
from vigilpay.operators.validate import is_blank

# --- fixed values: file endings that are never data -------------------------
SKIPPED_ENDINGS = r"(?i)\.(md|crc|inprogress)$"
# ---------------------------------------------------------------------------
_TARGET_FILE_ROWS = 2_000_000
#: Rows that one task sorts for a file of sorted rows.
_SORTED_ROWS = 100_000


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all data files below ``path``."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.filter(~F.col("_metadata.file_name").rlike(SKIPPED_ENDINGS))


def parse_json_lines(
    lines: DataFrame, schema: T.StructType, value: str = "value", limit: int | None = None
) -> DataFrame:
    """Rows of the readable lines; blank lines, ``#`` lines and broken JSON are skipped."""
    corrupt = "_corrupt"
    with_corrupt = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    kept = lines.filter(~is_blank(F.col(value)) & ~F.col(value).rlike(r"^\s*#"))
    parsed = F.from_json(F.col(value), with_corrupt, {"columnNameOfCorruptRecord": corrupt})
    # As a generator the text is parsed once per row, whatever reads the fields
    # (the outer form, as the inner one adds a filter that parses again).
    rows = kept.select(F.inline_outer(F.array(parsed))).filter(F.col(corrupt).isNull()).drop(corrupt)
    return rows if limit is None else rows.limit(limit)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None
) -> DataFrame:
    return parse_json_lines(text_lines(spark, path), schema, limit=limit)


def read_aml_csv(
    spark: SparkSession, path: str, skip: int = 0, limit: int = 0, header: bool = True, escape: str = '"'
) -> DataFrame:
    """The raw anti-money-laundering file as text columns, optionally rows ``skip .. skip+limit``.

    Columns are found by their names in the header (without one, by position);
    one that is missing is null, and files whose headers differ are an error.
    Quotes inside a value are doubled; ``escape`` names another dialect.

    Row positions follow file and offset.  They come from counting the rows of
    each input split, so nothing is sorted or gathered.
    """
    reader = spark.read.option("header", header).option("escape", escape)
    names = schemas.AML_ROW.names
    found = reader.option("inferSchema", False).csv(path).columns if header else names
    layout = T.StructType([T.StructField(n, T.StringType()) for n in found])
    text = lambda n: F.col(f"`{n}`") if n in found else F.lit(None).cast("string").alias(n)
    rows = reader.schema(layout).option("enforceSchema", not header).csv(path)
    if not skip and not limit:
        return rows.select(*[text(n) for n in names])
    placed = rows.select(
        *[text(n) for n in names],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
    )
    # One row per input split.  Within a split ids are consecutive.
    splits = placed.groupBy("_file", "_split").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_n"))
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("_file", earlier(Window.orderBy("_file")).alias("_before_file"))
    in_file = earlier(Window.partitionBy("_file").orderBy("_split"))
    offsets = splits.withColumn("_in_file", in_file).join(files, "_file").select(
        "_file", "_split", (F.col("_before_file") + F.col("_in_file") - F.col("_first")).alias("_shift")
    )
    position = F.col("_id") + F.col("_shift")
    wanted = position >= skip
    if limit:
        wanted = wanted & (position < skip + limit)
    # a row per input split; else the rows would move, and a task would sort a split or more
    return placed.join(F.broadcast(offsets), ["_file", "_split"]).filter(wanted).select(*names)


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in the order of ``columns`` from file to file, in ranges of a bounded number of rows.

    The ranges of ``orderBy`` are as many as the session has, and adaptive
    execution joins them by their packed size, so a task's sort grows with the input.
    """
    ranges = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // _SORTED_ROWS))
    return rows.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)


def write_aml_csv(rows: DataFrame, path: str) -> None:
    """Rows as quoted text with a header, blanks kept."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "", "escape": '"'}
    rows.write.options(header=True, **keep).csv(path)


def register_dwd_transactions(spark: SparkSession, name: str, location: str) -> DataFrame:
    """An external JSON table over converted events."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TRANSACTION.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING json LOCATION '{location}'")
    return spark.table(name)


# --- sinks -------------------------------------------------------------------

def json_view(rows: DataFrame) -> DataFrame:
    """Rows as published JSON: window and emit times in epoch milliseconds, nulls kept."""
    times = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    columns = [millis(F.col(c)).alias(c) if c in times else F.col(c) for c in rows.columns]
    return rows.select(*columns)


def write_json_lines(rows: DataFrame, path: str, mode: str = "append") -> None:
    (
        json_view(rows).write.mode(mode)
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", _TARGET_FILE_ROWS)
        .json(path)
    )


def alerts_table(alerts: DataFrame, created_at=None) -> DataFrame:
    """Alerts as the serving table stores them."""
    created = F.current_timestamp() if created_at is None else created_at
    return alerts.withColumn("event_time", F.try_to_timestamp("event_time")).withColumn(
        "created_at", created
    )


def metrics_table(metrics: DataFrame, created_at=None) -> DataFrame:
    created = F.current_timestamp() if created_at is None else created_at
    return metrics.select(
        "metric_id", "metric_name", "dimensions",
        F.round("value", 6).cast("decimal(20,6)").alias("value"),
        F.col("count").alias("count_value"),
        "window_start", "window_end", "emit_time", created.alias("created_at"),
    )


def late_table(late: DataFrame, created_at=None) -> DataFrame:
    created = F.current_timestamp() if created_at is None else created_at
    fields = schemas.TRANSACTION_FIELDS
    return late.select(
        "event_id", "transaction_id", "user_id", "merchant_id",
        F.col("event_ts").alias("event_time"),
        F.try_to_timestamp("process_time").alias("process_time"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("raw_event"),
        created.alias("created_at"),
    )
