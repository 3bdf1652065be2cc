"""Tables between the streaming queries: one folder per micro-batch that has rows.

A batch is written into a hidden folder and renamed when it is complete, so a
reader sees all of it or nothing, and a batch that runs again after a failure
finds its folder and leaves it.  Batches without rows make no folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vigilpay.session import drop

#: Files older than this, next to the newest, would be skipped by the file source.
_MAX_FILE_AGE = "36500d"
#: Rows of a file that rows of a query with state are written to.
FILE_ROWS = 250_000


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def _has_rows(spark: SparkSession, folder: str, schema: T.StructType, fmt: str) -> bool:
    if fmt == "json":
        # a row has bytes, and their number is known without a job
        system, target = _file_system(spark, folder)
        return system.getContentSummary(target).getLength() > 0
    return bool(spark.read.schema(schema).format(fmt).load(folder).select(F.lit(1)).take(1))


def _folder(path: str, batch_id: int) -> str:
    # no "name=value": the source would take it for a partition column
    return f"{path}/batch-{batch_id:012d}"


def write_batch(
    df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", keep_empty: bool = False, stateful: bool = False
) -> None:
    """Write a micro-batch into its own folder, once.

    ``stateful``: the rows come from a query with state.  Adaptive execution does
    not join its partitions, so they are joined here, into as many files as the
    rows ask for.  Stages take a table file by file; were there a file for every
    partition of state, a small batch would become many micro-batches.
    """
    spark, folder = df.sparkSession, _folder(path, batch_id)
    if exists(spark, folder):
        return
    hidden = f"{path}/_writing-{batch_id:012d}"
    rows = df.persist() if stateful else df
    try:
        if stateful:
            # counted by all tasks, so that only what is ready is read by few
            n = rows.count()
            if not n and not keep_empty:
                return
            rows = rows.coalesce(max(1, -(-n // FILE_ROWS)))
        writer = rows.write.mode("overwrite")
        if fmt == "json":
            writer = writer.option("ignoreNullFields", "false")
        writer.format(fmt).save(hidden)
    finally:
        if stateful:
            df.unpersist()
    if not stateful and not keep_empty and not _has_rows(spark, hidden, df.schema, fmt):
        drop(spark, hidden)
        return
    system, source = _file_system(spark, hidden)
    if not system.rename(source, _file_system(spark, folder)[1]):
        raise OSError(f"could not publish {folder}")


def _reader(spark: SparkSession, schema: T.StructType | str | None):
    # without a schema a job reads it from a file
    return spark.read if schema is None else spark.read.schema(schema)


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: T.StructType | str | None = None) -> DataFrame | None:
    folder = _folder(path, batch_id)
    return _reader(spark, schema).parquet(folder) if exists(spark, folder) else None


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, hidden ones left out."""
    if not exists(spark, path):
        return []
    system, target = _file_system(spark, path)
    names = [f.getPath().getName() for f in system.listStatus(target)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def read_output(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """Rows of all batches that are there; of an output that has none yet, no rows."""
    system, target = _file_system(spark, path)
    system.mkdirs(target)
    return spark.read.schema(schema).option("recursiveFileLookup", True).format(fmt).load(path)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches that are there."""
    return sorted(int(n.removeprefix("batch-")) for n in folder_names(spark, path) if n.startswith("batch-"))


def read_batches(
    spark: SparkSession, path: str, batch_ids: list[int], schema: T.StructType | str | None = None
) -> DataFrame | None:
    return _reader(spark, schema).parquet(*[_folder(path, i) for i in batch_ids]) if batch_ids else None


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    drop(spark, _folder(path, batch_id))


def stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = 1000
) -> DataFrame:
    """The batches as a stream, in the order they were written.

    With ``max_files`` a batch may be read in parts.  Without it all that is
    there is read, and as batches appear whole, none is ever cut.
    """
    system, target = _file_system(spark, path)
    system.mkdirs(target)
    reader = (
        spark.readStream.schema(schema).format(fmt)
        .option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{fmt}").option("maxFileAge", _MAX_FILE_AGE)
    )
    reader = reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(*schema.names)
