"""Connected components by alternating large-star and small-star steps over links."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from vigilpay.llm.common import drop, new_dir


def _links(df: DataFrame) -> DataFrame:
    return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link what hangs on a node to the smallest node next to it.

    Large: the neighbours above the node; small: the node and its neighbours below.
    """
    near = links.unionByName(links.selectExpr("b AS a", "a AS b")) if large else links
    least = near.groupBy("a").agg(F.min("b").alias("low"))
    # a node's links meet its smallest neighbour in a join, which may be split if the node has very many
    met = near.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    low = F.least("a", "low")
    if large:
        return _links(met.filter("b > a").select(F.col("b").alias("a"), low.alias("b")))
    own = least.select("a", F.col("low").alias("b"))
    return _links(met.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (columns ``a``, ``b``).

    Nodes without links are not returned.  Every round is written to the shared
    folder, which also cuts its lineage, and the round before is removed.
    """
    spark = links.sparkSession
    run = uuid.uuid4().hex[:8]

    def stored(df: DataFrame, turn: int) -> tuple[DataFrame, str]:
        path = new_dir(spark, f"components-{run}-{turn}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        return tuple(row)

    now, path = stored(_links(links), 0)
    seen = mark(now)
    for turn in range(1, rounds + 1):
        if not seen[0]:
            break
        following, new = stored(_star(_star(now, large=True), large=False), turn)
        drop(spark, path)
        now, path, before, seen = following, new, seen, mark(following)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
