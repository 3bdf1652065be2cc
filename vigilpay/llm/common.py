"""What the operators share: word columns, row blocks with ranks, staged tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay.session import drop, new_dir, stage  # noqa: F401  (used by the operators)

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = "[\\x20\\x09-\\x0D]"


def words(text: str | Column = "text") -> Column:
    """The words of a text as an array; none for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), f"{SPACE}+"), "")


def word_count(text: str | Column = "text") -> Column:
    return F.size(words(text)).cast("long")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Join condition on columns that may be null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def counted_ranks(rows: DataFrame, group: list[str], identity: list[str], total: int) -> DataFrame:
    """Equal rows once, with their number ``m`` and the rank ``first`` of the first of them in its group.

    Ranks run from 0 in the order of a hash of ``identity``, so they are the
    same in every run.  A group of any size is ranked in blocks of about
    sqrt(total) rows: a block's place is the sum of the blocks before it, and
    only a block is sorted in one task.  Equal rows are counted before they are
    shuffled, so they never meet as rows.
    """
    blocks = max(1, math.isqrt(total))
    hashed = F.xxhash64(*identity)
    m = rows.groupBy(*group, *identity).agg(F.count(F.lit(1)).alias("m"))
    m = m.withColumn("hash", hashed).withColumn("block", F.pmod("hash", F.lit(blocks)))
    sizes = m.groupBy(*group, "block").agg(F.sum("m").alias("in_block"))
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"g_{c}") for c in group], F.col("block").alias("g_block"),
        F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("start"),
    )
    within = Window.partitionBy(*group, "block").orderBy("hash", *identity).rowsBetween(Window.unboundedPreceding, -1)
    placed = m.withColumn("within", F.coalesce(F.sum("m").over(within), F.lit(0)))
    match = F.col("block") == F.col("g_block")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"g_{c}"))
    return placed.join(starts, match).select(
        *group, *identity, "m", (F.col("start") + F.col("within")).alias("first")
    )


def identified(docs: DataFrame, doc_id: str, text: str, rest: list[str] | None = None) -> DataFrame:
    """Rows with an id, as ``doc_id`` (long), ``text`` and the columns ``rest``.

    Columns that have these names already are not renamed, so that plans which
    read the same rows twice stay equal and share their shuffle.
    """
    own = "doc_id" if doc_id == "doc_id" and docs.schema[doc_id].dataType.typeName() == "long" else F.col(doc_id).cast("long").alias("doc_id")
    return docs.select(own, text if text == "text" else F.col(text).alias("text"), *(rest or [])).filter("doc_id IS NOT NULL")


def pass_through(df: DataFrame, own: list[str]) -> list[str]:
    """Columns of ``df`` that an operator carries along; its own result columns replace those of the same name."""
    return [c for c in df.columns if c not in own]
