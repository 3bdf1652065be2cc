"""Rolling of an output of the stream: many small batch folders become files of a target size.

A stream reads an output batch by batch (``tables.stream``), so its batches are
not touched while they may still be read.  ``roll`` copies the batches since the
last roll into ``<path>-rolled/rolled-<first>-<last>``, written hidden and renamed
when complete.  The name says which batches it stands for: ``read_output`` takes
rolled folders and only those batches that none of them covers, so that it finds
every row once before, during and after a roll, also after one that broke off.
``retire`` removes batches whose rolled folder is older than a retention time,
as a log does; readers must not be further behind than that.  The newest batch
stays, because its query may run it again.

One roll of an output may run at a time.  Only names, times and sizes of folders
reach the driver.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, types as T

from vigilpay.streaming import tables

TARGET_BYTES = 64 << 20
ROLL_SECONDS = 120
IDLE_SECONDS = 30
KEEP_SECONDS = 86_400


def _rolled_path(path: str) -> str:
    return f"{path.rstrip('/')}-rolled"


def _rolled(spark: SparkSession, path: str) -> list[tuple[int, int, int, str]]:
    """First and last batch, time of publication in ms and folder of each roll, in order."""
    system, target = tables._file_system(spark, _rolled_path(path))
    if not system.exists(target):
        return []
    found = []
    for f in system.listStatus(target):
        name = f.getPath().getName()
        if name.startswith("rolled-"):
            low, high = name.removeprefix("rolled-").split("-")
            found.append((int(low), int(high), f.getModificationTime(), f"{_rolled_path(path)}/{name}"))
    return sorted(found)


def _sizes(spark: SparkSession, path: str, batch_ids: list[int]) -> list[tuple[int, int]]:
    """Bytes and time of publication in ms of each batch."""
    sizes = []
    for i in batch_ids:
        system, folder = tables._file_system(spark, tables._folder(path, i))
        sizes.append((system.getContentSummary(folder).getLength(), system.getFileStatus(folder).getModificationTime()))
    return sizes


def roll(
    spark: SparkSession, path: str, fmt: str = "json", target_bytes: int = TARGET_BYTES,
    roll_seconds: int = ROLL_SECONDS, idle_seconds: int = IDLE_SECONDS, now_ms: int | None = None,
) -> int:
    """Roll the batches since the last roll if they are due; how many batches were rolled.

    They are due when they hold ``target_bytes``, when the oldest is
    ``roll_seconds`` old, or when nothing came for ``idle_seconds``.
    """
    # batches are published in their order, so no number up to the newest can still appear
    last = max((high for _, high, _, _ in _rolled(spark, path)), default=-1)
    waiting = [i for i in tables.batch_ids(spark, path) if i > last]
    if not waiting:
        return 0
    now = time.time_ns() // 1_000_000 if now_ms is None else now_ms
    sizes = _sizes(spark, path, waiting)
    total, times = sum(n for n, _ in sizes), [t for _, t in sizes]
    due = total >= target_bytes or now - min(times) >= 1000 * roll_seconds or now - max(times) >= 1000 * idle_seconds
    if not due:
        return 0
    folders = [tables._folder(path, i) for i in waiting]
    # lines of text are copied as they are
    rows = spark.read.text(folders) if fmt == "json" else spark.read.parquet(*folders)
    name = f"{waiting[0]:012d}-{waiting[-1]:012d}"
    hidden = f"{_rolled_path(path)}/_writing-{name}"
    files = rows.coalesce(max(1, -(-total // target_bytes)))
    files.write.mode("overwrite").format("text" if fmt == "json" else fmt).save(hidden)
    system, source = tables._file_system(spark, hidden)
    if not system.rename(source, tables._file_system(spark, f"{_rolled_path(path)}/rolled-{name}")[1]):
        raise OSError(f"could not publish the roll of {path}")
    return len(waiting)


def retire(spark: SparkSession, path: str, keep_seconds: int = KEEP_SECONDS, now_ms: int | None = None) -> int:
    """Remove batches that were rolled at least ``keep_seconds`` ago; how many were removed."""
    now = time.time_ns() // 1_000_000 if now_ms is None else now_ms
    old = [(low, high) for low, high, at, _ in _rolled(spark, path) if now - at >= 1000 * keep_seconds]
    there = tables.batch_ids(spark, path)
    gone = [i for i in there[:-1] if any(low <= i <= high for low, high in old)]
    for i in gone:
        tables.drop_batch(spark, path, i)
    return len(gone)


def read_output(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """All rows of an output, each once, from rolled folders and from batches not rolled yet."""
    # batches are listed first: one that goes meanwhile is in a rolled folder by then
    there = tables.batch_ids(spark, path)
    rolled = _rolled(spark, path)
    open_ids = [i for i in there if not any(low <= i <= high for low, high, _, _ in rolled)]
    folders = [folder for *_, folder in rolled] + [tables._folder(path, i) for i in open_ids]
    if not folders:
        return spark.createDataFrame([], schema)
    # rolled lines of JSON are in text files
    return spark.read.schema(schema).format(fmt).load(folders)
