"""Conversion of an anti-money-laundering file to events, from file to file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigilpay import schemas
from vigilpay.operators import aml
from vigilpay.sources import files


def convert_file(source: str, target: str, rows: DataFrame, skip: int = 0, as_of: str = aml.UNSET) -> DataFrame:
    """Write the events of a file as JSON lines and return the summary, with ``source_size_bytes`` of the whole file.

    ``rows`` are those that are left of the file after ``skip`` rows
    (``files.read_aml_csv``); rows skipped are those that were there to skip.
    """
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    files.write_json_lines(aml.to_transactions(rows, as_of), target)
    skipped = min(skip, files.read_aml_csv(spark, source, limit=skip).count()) if skip else 0
    done = files.read_json_lines(spark, target, schemas.TRANSACTION)
    return aml.conversion_summary(done, skipped).withColumn("source_size_bytes", F.lit(size).cast("bigint"))
