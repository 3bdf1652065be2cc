"""Event-time windows on tables, built from one-minute panes.

A sliding window of ``n`` minutes that moves by one minute is the union of
``n`` panes.  Rows are reduced to panes first, with map-side partial
aggregation, and only panes are expanded into windows.  Panes are moved to
their key before the expansion, so the expanded rows never cross the network:
a grouping by ``(key, window)`` is satisfied by a partitioning on ``key``.
The panes of one key are bounded by the minutes the data spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay.functions.times import minute_of, minute_start


def panes(events: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    """One row per ``keys`` and minute."""
    return events.groupBy(*keys, minute_of(F.col("event_ts")).alias("pane")).agg(*measures)


def add_bounds(windows: DataFrame, minutes: int) -> DataFrame:
    """Replace ``first_pane`` by ``window_start`` and ``window_end``."""
    return (
        windows.withColumn("window_start", minute_start(F.col("first_pane")))
        .withColumn("window_end", minute_start(F.col("first_pane") + minutes))
        .drop("first_pane")
    )


def near_total(value: str, key: str, minutes: int) -> Column:
    """Sum of ``value`` over all panes that share some window with a pane.

    No window holding the pane can exceed it when values are not negative.
    """
    order = Window.partitionBy(key).orderBy("pane").rangeBetween(1 - minutes, minutes - 1)
    return F.sum(value).over(order)


def slide(
    pane_rows: DataFrame, keys: list[str], minutes: int, *measures: Column, placed: bool = False
) -> DataFrame:
    """Combine panes into windows of ``minutes``, moving by one minute.

    ``placed`` says the panes already are partitioned by the keys.
    """
    if keys and not placed:
        pane_rows = pane_rows.repartition(*keys)
    expanded = pane_rows.withColumn(
        "first_pane", F.explode(F.sequence(F.col("pane") - (minutes - 1), F.col("pane")))
    )
    return add_bounds(expanded.groupBy(*keys, "first_pane").agg(*measures), minutes)


def merchant_window_amount(success: DataFrame, minutes: int = 5) -> DataFrame:
    """Amount received per merchant and sliding window; input of the spike rule and of a metric."""
    pane_rows = panes(success, ["merchant_id"], F.sum("amount").alias("amount"))
    return slide(pane_rows, ["merchant_id"], minutes, F.sum("amount").alias("amount"))


def appearances(events: DataFrame, key: str) -> DataFrame:
    """Users of a key per minute, with the first arrival of each."""
    return panes(events, [key, "user_id"], F.min("arrival_seq").alias("first_seq")).filter(
        F.col(key).isNotNull() & F.col("pane").isNotNull()
    )


def distinct_user_windows(events: DataFrame, key: str, minutes: int, threshold: int) -> DataFrame:
    """Windows in which ``key`` was used by more than ``threshold`` distinct users, see ``seen_windows``."""
    return seen_windows(appearances(events, key), key, minutes, threshold)


def seen_windows(seen: DataFrame, key: str, minutes: int, threshold: int, starts: Column | None = None) -> DataFrame:
    """Windows with more than ``threshold`` of the users in ``seen`` (``appearances``).

    A user's appearance in pane ``m`` is new to exactly those windows that do
    not reach back to the user's previous pane.  Each appearance therefore adds
    one on an interval of window starts: two delta rows, whatever the window
    length, which aggregate per key and minute before the running sum.

    Adds ``distinct_user_count`` and ``users``, the first ``sample`` users in
    arrival order.  ``starts`` says of which windows, by ``first_pane``.
    """
    # The join below would ask for known keys on one of the two uses of ``seen``
    # only, and only one needs ``first_seq``.  Asking for both in both keeps the
    # two plans alike, so they share one shuffle.
    previous = F.lag("pane").over(Window.partitionBy(key, "user_id").orderBy("pane", "first_seq"))
    opens = F.greatest(F.col("pane") - (minutes - 1), previous + 1)
    deltas = seen.select(key, "pane", opens.alias("opens")).select(
        key,
        F.explode(
            F.array(
                F.struct(F.col("opens").alias("first_pane"), F.lit(1).alias("delta")),
                F.struct((F.col("pane") + 1).alias("first_pane"), F.lit(-1).alias("delta")),
            )
        ).alias("d"),
    ).select(key, "d.*")
    changes = deltas.groupBy(key, "first_pane").agg(F.sum("delta").alias("delta")).filter("delta <> 0")
    order = Window.partitionBy(key).orderBy("first_pane")
    counted = changes.select(
        key,
        "first_pane",
        F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("distinct_user_count"),
        F.lead("first_pane").over(order).alias("next_change"),
    ).filter(F.col("distinct_user_count") > threshold)
    hits = counted.withColumn(
        "first_pane", F.explode(F.sequence(F.col("first_pane"), F.col("next_change") - 1))
    ).drop("next_change")
    hits = hits if starts is None else hits.filter(starts)
    return add_bounds(_with_first_users(seen, hits, key, minutes), minutes)


def _with_first_users(seen: DataFrame, hits: DataFrame, key: str, minutes: int, sample: int = 8) -> DataFrame:
    # The first users of a window are each among the first of some pane of it,
    # so a short list per pane is enough; the list is cut before the shuffle.
    order = Window.partitionBy(key, "pane").orderBy("first_seq", "user_id")
    first_of_pane = (
        seen.withColumn("_nth", F.row_number().over(order))
        .filter(F.col("_nth") <= sample)
        .groupBy(key, "pane")
        .agg(F.collect_list(F.struct("first_seq", "user_id")).alias("firsts"))
    )
    per_pane = hits.select(
        key,
        "first_pane",
        "distinct_user_count",
        F.explode(F.sequence(F.col("first_pane"), F.col("first_pane") + (minutes - 1))).alias("pane"),
    )
    in_order = F.array_sort(F.flatten(F.collect_list("firsts")))
    users = F.slice(F.array_distinct(F.transform(in_order, lambda u: u["user_id"])), 1, sample)
    return (
        per_pane.join(first_of_pane, [key, "pane"])
        .groupBy(key, "first_pane")
        .agg(F.first("distinct_user_count").alias("distinct_user_count"), users.alias("users"))
    )
