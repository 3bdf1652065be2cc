"""Merged alerts of one day in files of one size, whatever their ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilpay import schemas
from vigilpay.operators import alerts as al
from vigilpay.session import new_dir


def test_a_day_is_cut_into_files_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(al, "_FILE_ROWS", 50)
    given = {"alert_id": F.concat(F.lit("a"), F.col("id")), "event_time": F.lit("2024-01-01T00:00:00Z"), "alert_time": F.timestamp_seconds("id")}
    rows = spark.range(1000).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.ALERT.fields])
    path = new_dir(spark, "merged")
    for _ in range(2):
        al.merge_into(path, rows.unionByName(rows))
        stored = spark.read.parquet(path)
        assert stored.count() == 1000 == stored.select("alert_id").distinct().count()
        sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
        assert max(sizes) <= 2 * 50
