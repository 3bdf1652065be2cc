"""Running values over an order, without sorting everything in one task.

Spark evaluates a running window per partition key, so a window over the whole
table, or over a key that holds a large share of it, runs in a single task.
The operators here cut the order into blocks of bounded size, summarise each
block with an ordinary aggregation, carry the summaries forward, and finish
inside the blocks.

They rely on one property of ``arrival_seq``: no two arrivals share a number, so
a range of ``2**b`` numbers holds at most ``2**b`` rows, whatever the key skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay.session import stage

# 65,536 arrivals per block; 4,096 blocks per group of blocks.
BLOCK_BITS = 16
GROUP_BITS = 12
# A key is split once it has more rows than fit comfortably in one sorted task.
HOT_ROWS = 1 << 20
# A key also counts as large only if it holds more than 1/50,000 of all rows.  So
# fewer keys than that are split, all of those that are large, and their list is
# small enough to broadcast.
HOT_KEYS = 50_000
HOT_BLOCK_BITS = 20
# Rows of a key that share a cell of time, if the key's rows are spread evenly over it.
CELL_ROWS = 1 << 16

_START = Window.unboundedPreceding


def _before(order: Window) -> Window:
    return order.rowsBetween(_START, -1)


def prefix_before(
    blocks: DataFrame, block: str, value: str, fold, name: str, group_bits: int = GROUP_BITS
) -> DataFrame:
    """Add ``name``: ``fold`` (``F.max`` or ``F.sum``) of ``value`` over all earlier blocks.

    ``blocks`` has one row per non-empty block.  Two levels keep every window
    short: groups of ``2**group_bits`` blocks, then the blocks of one group.
    """
    grouped = blocks.withColumn("_grp", F.shiftright(block, group_bits))
    groups = grouped.groupBy("_grp").agg(fold(value).alias("_grp_value"))
    # One row per group of blocks: 2**28 arrivals each with the default sizes,
    # so a trillion arrivals make fewer than 4,000 rows in this window.
    groups = groups.select(
        "_grp", fold("_grp_value").over(_before(Window.orderBy("_grp"))).alias("_grp_before")
    )
    inside = fold(value).over(_before(Window.partitionBy("_grp").orderBy(block)))
    joined = grouped.withColumn("_inside", inside).join(groups, "_grp", "left")
    if fold is F.sum:
        total = F.coalesce(F.col("_grp_before"), F.lit(0)) + F.coalesce(F.col("_inside"), F.lit(0))
    else:
        total = F.greatest("_grp_before", "_inside")
    return joined.withColumn(name, total).drop("_grp", "_inside", "_grp_before")


def running_max_before(
    rows: DataFrame,
    value: str,
    name: str,
    seq: str = "arrival_seq",
    block_bits: int = BLOCK_BITS,
    group_bits: int = GROUP_BITS,
) -> DataFrame:
    """Add ``name``: the largest ``value`` among rows of smaller ``seq``.

    One shuffle of ``rows`` by block.  The block carry joins on the same key and
    so moves only its own few rows.
    """
    rows = rows.withColumn("_blk", F.shiftright(seq, block_bits))
    blocks = rows.groupBy("_blk").agg(F.max(value).alias("_blk_max"))
    carry = prefix_before(blocks, "_blk", "_blk_max", F.max, "_carry", group_bits).drop("_blk_max")
    inside = F.max(value).over(_before(Window.partitionBy("_blk").orderBy(seq)))
    return (
        rows.withColumn("_inside", inside)
        .join(carry, "_blk", "left")
        .withColumn(name, F.greatest("_inside", "_carry"))
        .drop("_blk", "_inside", "_carry")
    )


def hot_keys(
    rows: DataFrame, key: str, hot_rows: int = HOT_ROWS, max_keys: int = HOT_KEYS
) -> DataFrame:
    """The keys too large for one task: all with more than ``hot_rows`` rows and ``1 / max_keys`` of the table."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = rows.agg(F.count(F.lit(1)) / max_keys).scalar()
    return counts.filter((F.col("_n") > hot_rows) & (F.col("_n") > share)).select(key)


def split_hot(
    rows: DataFrame, key: str, hot: DataFrame, seq: str = "arrival_seq", bits: int = HOT_BLOCK_BITS
) -> tuple[DataFrame, DataFrame]:
    """Cut the rows of hot keys into stretches of the arrival order, ``_blk``.

    Returns all rows, with a null ``_blk`` unless their key is hot, and the rows
    of hot keys alone, for summarising stretches.  Partitioning a running window
    by ``(key, _blk)`` spreads a hot key over many tasks and leaves every other
    key whole.  The broadcast is bounded, see ``hot_keys``; where no key is hot
    it is empty and the second result costs nothing.
    """
    stretch = F.shiftright(seq, bits)
    marked = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
    everything = rows.join(marked, key, "left").withColumn("_blk", F.when(F.col("_hot"), stretch))
    hot_rows = rows.join(marked, key, "inner").withColumn("_blk", stretch)
    return everything.drop("_hot"), hot_rows.drop("_hot")


def segmented_before(
    stretches: DataFrame, key: str, block: str, reset: str, values: list[str], cut: str | None = None
) -> DataFrame:
    """What every stretch of a key starts with: the sums of ``values`` since the last reset before it.

    A stretch has a flag, whether anything in it resets, and for each value the
    sum after its last reset (over all of it if there is none).  Two neighbours
    combine to (f or g, w if g else v + w), which is associative, so a run may
    reach over any number of stretches.  ``cut`` flags stretches that begin
    anew: they reset and start with nothing.  One row per stretch goes in.
    """
    by_key = Window.partitionBy(key).orderBy(block)
    flag = F.col(reset) if cut is None else F.col(reset) | F.col(cut)
    rows = stretches.withColumn("_run", F.sum(flag.cast("int")).over(by_key.rowsBetween(_START, 0)))
    in_run = Window.partitionBy(key, "_run").orderBy(block).rowsBetween(_START, 0)
    for value in values:
        rows = rows.withColumn(value, F.sum(value).over(in_run))
    before = {value: F.lag(value).over(by_key) for value in values}
    if cut is not None:
        before = {value: F.when(~F.col(cut), column) for value, column in before.items()}
    return rows.select(key, block, *[column.alias(value) for value, column in before.items()])


def gap_above(clock: str, limit_us: int, order: Window) -> Column:
    """Whether more than ``limit_us`` passed since the row before; never at the first row of ``order``."""
    return F.coalesce(F.col(clock) - F.lag(clock).over(order) > F.lit(limit_us), F.lit(False))


def ranks_picked(
    rows: DataFrame, levels: list[Column], every: int | Column, first: int | Column, limit: int
) -> DataFrame:
    """The rows at ranks ``first, first + every, ...`` (one-based, at most ``limit`` of them).

    ``levels`` refine the order from coarse to fine: each level sorts rows
    within one value of the levels before it, and all levels together are
    unique.  Every round counts rows per cell, keeps the cells that hold a
    wanted rank (never more than ``limit``), and looks only into those next.
    No round sorts the table; the broadcast cells are bounded by ``limit``.

    Returns the level columns ``_l0, _l1, ...`` and ``_rank``.
    """
    names = [f"_l{i}" for i in range(len(levels))]
    rows = rows.select(*[level.alias(name) for level, name in zip(levels, names)])
    every_c = every if isinstance(every, Column) else F.lit(every).cast("bigint")
    first_c = first if isinstance(first, Column) else F.lit(first).cast("bigint")
    cells = None
    for depth, name in enumerate(names):
        path = names[:depth]
        inner = rows if cells is None else rows.join(F.broadcast(cells), path, "inner")
        if cells is None:
            inner = inner.withColumn("_below", F.lit(0).cast("bigint"))
        counts = inner.groupBy(*path, name).agg(
            F.count(F.lit(1)).alias("_n"), F.first("_below").alias("_below")
        )
        order = Window.partitionBy(*path).orderBy(name) if path else Window.orderBy(name)
        counts = counts.withColumn(
            "_below", F.col("_below") + F.coalesce(F.sum("_n").over(_before(order)), F.lit(0))
        )
        # wanted rank number j lies at first + j * every, j = 0 .. limit - 1
        above = F.col("_below") + F.col("_n")
        j_low = F.greatest(F.ceil((F.col("_below") + 1 - first_c) / every_c), F.lit(0))
        j_high = F.least(F.floor((above - first_c) / every_c), F.lit(limit - 1))
        cells = counts.filter((above >= first_c) & (j_low <= j_high))
        if depth < len(names) - 1:
            cells = cells.select(*path, name, "_below")
        else:
            cells = cells.select(*names, (F.col("_below") + 1).alias("_rank"))
    return cells


def _next_points(points: DataFrame, spacing: int, cell_rows: int) -> DataFrame:
    """``key``, ``at``, ``prev`` and ``next``: the point before, and the first at least ``spacing`` later.

    Only of keys that span ``spacing``.  A key's time is cut into cells, the more
    the more points it has.  Where a point looks (``spacing`` later) is put into
    the cell it falls in, and meets the points there; if none follows in the
    cell, the answer is the first point of the next cell that has any.
    """
    spans = points.groupBy("key").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count(F.lit(1)).alias("n"))
    # cells so wide that an even key has ``cell_rows`` points in each, but none wider than the spacing
    even = F.expr(f"CAST((hi - lo) DIV greatest(1L, n DIV {cell_rows}L) AS BIGINT)")
    width = F.greatest(F.lit(1).cast("bigint"), F.least(even, F.lit(spacing).cast("bigint"))).alias("width")
    long = spans.filter(F.col("hi") - F.col("lo") >= spacing).select("key", width)
    placed = stage(points.join(long, "key").select("key", "at", "width"), "points")
    cell = lambda t: F.expr(f"CAST(({t} - pmod({t}, width)) DIV width AS BIGINT)")
    own = placed.select("key", cell("at").alias("cell"), F.col("at").alias("t"), F.lit(0).alias("looks"), F.col("at").alias("of"))
    looks = placed.withColumn("t", F.col("at") + F.lit(spacing)).select("key", cell("t").alias("cell"), "t", F.lit(1).alias("looks"), F.col("at").alias("of"))
    both = own.unionByName(looks)
    is_point = F.col("looks") == 0
    cells = both.groupBy("key", "cell").agg(F.min(F.when(is_point, F.col("t"))).alias("first"), F.max(F.when(is_point, F.col("t"))).alias("last"))
    by_key = Window.partitionBy("key")
    cells = cells.select(
        "key", "cell",
        F.last("last", ignorenulls=True).over(_before(by_key.orderBy("cell"))).alias("before"),
        F.last("first", ignorenulls=True).over(_before(by_key.orderBy(F.desc("cell")))).alias("after"),
    )
    inside = Window.partitionBy("key", "cell").orderBy(F.desc("t"), "looks").rowsBetween(_START, 0)
    follows = F.last(F.when(is_point, F.col("t")), ignorenulls=True).over(inside)
    upward = Window.partitionBy("key", "cell", "looks").orderBy("t")
    found = both.withColumn("follows", follows).withColumn("precedes", F.lag("t").over(upward)).join(cells, ["key", "cell"])
    prev, following = F.coalesce("precedes", "before"), F.coalesce("follows", "after")
    return found.groupBy("key", F.col("of").alias("at")).agg(
        F.max(F.when(is_point, prev)).alias("prev"), F.max(F.when(~is_point, following)).alias("next")
    )


def spaced_after_first(points: DataFrame, spacing: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The points taken beyond the first of each key, if none is taken within ``spacing`` after another.

    ``points`` are distinct pairs of ``key`` and ``at`` (a bigint).  Which point
    is taken depends on the one taken before, yet no key is followed row by
    row.  A point that comes ``spacing`` or more after the point before it is
    always taken, so chains begin there, and end before the next of these.  From
    each point to the next that could be taken after it there is one step, and a
    step leaves its stretch of time ``spacing`` wide.  Stretches are joined two
    by two: of the steps only those stay that begin a chain or come in from
    another stretch, and they are lengthened until they leave the new stretch.
    So steps about halve in every round, and log2 of the time in ``spacing``
    rounds handle no more rows than the first few.  The same rounds backwards
    find what the long steps passed over.  A key of any size is spread over all
    tasks.  Cells hold a bounded number of points where a key's points are even
    in time, and never more than there are distinct times in a cell.
    """
    steps = stage(_next_points(points, spacing, cell_rows), "steps")
    low, high = steps.agg(F.min("at"), F.max("at")).first()
    begins = F.col("prev").isNull() | (F.col("at") - F.col("prev") >= spacing)
    again = steps.filter(begins & F.col("prev").isNotNull()).select("key", "at")
    if low is None:
        return again
    inside = steps.filter("next IS NOT NULL").select("key", "at", "next", begins.alias("begins"))
    inside = inside.join(again.withColumnRenamed("at", "next"), ["key", "next"], "left_anti")
    jumps = [stage(inside.select("key", "at", "next", "begins"), "jumps")]

    def stays(level: int) -> Column:
        stretch = lambda t: F.expr(f"({t} - {low}L) DIV {spacing << level}L")
        return stretch("at") == stretch("next")

    while not jumps[-1].isEmpty():
        last, within = jumps[-1], stays(len(jumps))
        entries = last.filter(~within).select("key", F.col("next").alias("at")).distinct()
        own = last.filter("begins").unionByName(last.filter("NOT begins").join(entries, ["key", "at"], "left_semi"))
        ahead = last.select("key", F.col("at").alias("next"), F.col("next").alias("beyond"))
        longer = own.filter(within).join(ahead, ["key", "next"]).select("key", "at", F.col("beyond").alias("next"), "begins")
        jumps.append(stage(own.filter(~within).unionByName(longer), "jumps"))
    taken = None
    for level in range(len(jumps) - 1, 0, -1):
        ahead = jumps[level - 1].filter(stays(level))
        reached = ahead.filter("begins").select("key", F.col("next").alias("at"))
        if taken is not None:
            passed = taken.join(ahead.filter("NOT begins"), ["key", "at"]).select("key", F.col("next").alias("at"))
            reached = reached.unionByName(passed)
        # chains do not meet, so a point is reached once
        reached = stage(reached, "taken")
        taken = reached if taken is None else taken.unionByName(reached)
    return again if taken is None else again.unionByName(taken)
