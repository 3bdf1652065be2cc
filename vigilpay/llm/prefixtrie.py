"""A trie of conversation prefixes by van Emde Boas recursion over the depth.

A range of depths (lo, hi] is cut at its middle.  What the sequences of the range
have in the upper half is named: equal halves under one root get one name, the
smallest conversation among them.  The upper trie is built from the names alone,
each once and with the number of conversations behind it; the lower forests from
what follows below each name.  All ranges of a width are cut in the same step, so a
trie of depth D takes about log2 D steps, and the rows of the steps together grow
as the turns do.  Every depth is the middle of exactly one range, so the names of
all steps are the nodes of the trie.

Totals are grafted on the same ranges.  Upward, a name hands the total of its
range's lower half to the root of the range, narrow ranges first.  Then, wide
ranges first, a name takes the whole totals of the names at the lower end of its
range, which are complete by then.

Equal halves are found by 128 bits of SHA-256 of role and text, combined pair by
pair, so a half of any length is one value; hash equality stands for equality.  No
step holds a conversation's turns, or the members of a node, in one row.

Defined results: rows without a conversation id are left out; a null role or text
is empty; turns of equal number are put in order by that hash, and repeated rows
are turns each; an empty table gives an empty table.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigilpay.llm.common import stage

#: Conversations of the corpus in blocks of as many ids, for the digests of their ids.
ID_BLOCK = 4096
#: Turns that a conversation takes from the one it goes back to: fewer than this.
HEADS = 9
FAMILY = 5


def _hash(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def turns(conversations: DataFrame) -> DataFrame:
    """``c``, ``pos`` (from 1), ``hash`` and ``bytes`` of every turn, in the order of its conversation.

    Places are counted in ranges of the order, so a conversation with a large
    share of all turns is ranked in many tasks, also where its turns are equal.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role keeps role and text apart
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("turn"),
        _hash(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("hash"),
        F.octet_length(text).cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("row"),
    )
    ranged = stage(rows.repartitionByRange("c", "turn", "hash", "row").withColumn("part", F.spark_partition_id()), "turns")
    order = Window.partitionBy("c", "part").orderBy("turn", "hash", "row")
    counts = ranged.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    # a row for each partition that holds turns of the conversation
    before = F.coalesce(F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("c", "part", before.alias("before"))
    placed = ranged.withColumn("within", F.row_number().over(order)).join(starts, ["c", "part"])
    return placed.select("c", (F.col("before") + F.col("within")).cast("bigint").alias("pos"), "hash", "bytes")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first of their five, and the turns of all.

    Conversation c takes the first h turns of c - c % 5, h = crc32(c) % 9, then its
    own after its first h.  Returns (``c``, ``turns``) and (``c``, ``pos``, ``hash``, ``bytes``).
    """
    known = own.groupBy("c").agg(F.count(F.lit(1)).alias("has"))
    heads = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(HEADS))
    first = known.select(F.col("c").alias("base"), F.col("has").alias("base_has"))
    plan = known.select("c", "has", heads.alias("h"), (F.col("c") - F.col("c") % FAMILY).alias("base")).join(first, "base", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("base_has", F.lit(0))))
    after = own.filter(F.col("pos") > F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(HEADS)))
    after = after.join(plan.select("c", "h", "taken"), "c").select("c", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "hash", "bytes")
    begun = own.filter((F.col("c") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("c", "base")
    begun = begun.join(plan.filter("taken > 0").select("c", "base", "taken"), "base").filter("pos <= taken").select("c", "pos", "hash", "bytes")
    lengths = plan.select("c", (F.col("taken") + F.greatest(F.col("has") - F.col("h"), F.lit(0))).alias("turns"))
    return lengths, begun.unionByName(after)


def _halves(sequence: DataFrame, steps: int) -> list[DataFrame]:
    """Hashes of the aligned stretches of 1, 2, 4, ... turns: ``c``, ``idx``, ``hash`` each."""
    levels = [sequence.select("c", (F.col("pos") - 1).alias("idx"), "hash")]
    for _ in range(1, steps):
        side = lambda k: F.max(F.when(F.col("idx") % 2 == k, F.col("hash")))
        pairs = levels[-1].groupBy("c", F.shiftright("idx", 1).alias("up")).agg(side(0).alias("a"), side(1).alias("b"))
        pairs = pairs.filter("a IS NOT NULL AND b IS NOT NULL")
        levels.append(stage(pairs.select("c", F.col("up").alias("idx"), _hash(F.concat("a", "b")).alias("hash")), "halves"))
    return levels


def _named(lengths: DataFrame, sequence: DataFrame, steps: int, root: int | None) -> list[tuple[DataFrame, DataFrame]]:
    """What each step of halving named, wide ranges first; ``root`` is the name of the root of all.

    Two tables a step.  Names: ``lo``, ``root`` (name of the node where the range
    begins), ``name`` (of the node in its middle) and ``w``, the conversations
    behind it.  Sequences: ``lo``, ``root``, ``name``, ``rep``, ``w``, ``until``,
    ``cut``: ``rep`` stands for ``w`` conversations and ends at depth ``until``,
    where it is a named node (``cut``) or the end of a conversation.
    """
    halves = _halves(sequence, steps)
    items = lengths.filter("turns > 0").select(
        F.lit(0).cast("bigint").alias("lo"), F.lit(root).cast("bigint").alias("root"), F.col("c").alias("rep"),
        F.lit(1).cast("bigint").alias("w"),
        F.col("turns").alias("until"), F.lit(False).alias("cut"),
    )
    named = []
    for step in reversed(range(steps)):
        middle = F.col("lo") + (1 << step)
        stretch = halves[step].select(F.col("c").alias("rep"), F.shiftleft("idx", step).alias("lo"), "hash")
        reach = stage(items.filter(F.col("until") >= middle).join(stretch, ["rep", "lo"]), "reach")
        names = reach.groupBy("lo", "root", "hash").agg(F.min("rep").alias("name"), F.sum("w").alias("w"))
        names = stage(names, "names")
        now = stage(reach.join(names.drop("w"), ["lo", "root", "hash"]).drop("hash"), "named")
        named.append((names, now))
        if step:
            upper = names.select("lo", "root", F.col("name").alias("rep"), "w")
            lower = now.filter(F.col("until") > middle)
            items = stage(reduce(DataFrame.unionByName, [
                items.filter(F.col("until") < middle),
                upper.withColumn("until", middle).withColumn("cut", F.lit(True)),
                lower.select(middle.alias("lo"), F.col("name").alias("root"), "rep", "w", "until", "cut"),
            ]), "items")
    return named


def _id_digests(ends: DataFrame) -> DataFrame:
    """``depth``, ``name``, ``ends_sha256``: the hash of the sorted decimal ids of ``c``, joined by commas.

    Ids meet in blocks of their own number range, as one text each.  The texts of
    a node then run through one hash in order, which is how this hash is
    defined; they are streamed and never held.
    """
    blocks = ends.groupBy("depth", "name", F.floor(F.col("c") / ID_BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None

        def batch(rows):
            columns = list(zip(*rows)) if rows else [()] * 3
            kinds = [pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["depth", "name", "ends_sha256"])

        for part in batches:
            done = []
            for depth, name, ids in zip(*[part.column(c).to_pylist() for c in ("depth", "name", "ids")]):
                if (depth, name) != node:
                    if node:
                        done.append((*node, running.hexdigest()))
                    node, running = (depth, name), hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield batch(done)
        yield batch([(*node, running.hexdigest())] if node else [])

    rows = blocks.repartition("depth", "name").sortWithinPartitions("depth", "name", "block").select("depth", "name", "ids")
    return rows.mapInArrow(digests, "depth bigint, name bigint, ends_sha256 string")


def _grafted(nodes: DataFrame, links: list[DataFrame], steps: int) -> DataFrame:
    """``depth``, ``name``, ``n_leaves``, ``saved_tokens``: sums of ``leaf`` and ``saved`` over whole subtrees.

    ``nodes`` have their ``level`` (which step named them; ``steps`` for the root
    of all), the ``root`` of their range and its ``root_depth``; ``links[level]``
    join a name (``depth``, ``name``) to the names at the lower end of its range
    (``end_depth``, ``end``).
    """
    sums = ["leaf", "saved"]
    kind = "decimal(38,0)"  # totals of bytes times members
    nodes = nodes.select("level", "depth", "name", "root", "root_depth", *[F.col(c).cast(kind).alias(c) for c in sums])

    def plus(rows: DataFrame, more: DataFrame) -> DataFrame:
        more = more.groupBy("depth", "name").agg(*[F.sum(c).cast(kind).alias(f"more_{c}") for c in sums])
        joined = rows.join(more, ["depth", "name"], "left")
        return joined.select(
            "level", "depth", "name", "root", "root_depth",
            *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).cast(kind).alias(c) for c in sums],
        )

    # upward: each level holds, for its nodes, the sum over the lower halves of their ranges
    held: list[DataFrame] = []
    for level in range(steps + 1):
        now = nodes.filter(F.col("level") == level)
        if held:
            below = reduce(DataFrame.unionByName, held).select(F.col("root_depth").alias("depth"), F.col("root").alias("name"), *sums)
            now = plus(now, below)
        held.append(stage(now, "graft"))
    # downward: what lies below the lower ends
    whole = [held[steps]]
    for level in reversed(range(steps)):
        ends = reduce(DataFrame.unionByName, whole).select(F.col("depth").alias("end_depth"), F.col("name").alias("end"), *sums)
        below = links[level].join(ends, ["end_depth", "end"]).select("depth", "name", *sums)
        whole.append(stage(plus(held[level], below), "grafted"))
    totals = reduce(DataFrame.unionByName, whole)
    return totals.select("depth", "name", F.col("leaf").cast("bigint").alias("n_leaves"), F.col("saved").cast("bigint").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Takes ``conv_id``, ``turn``, ``role``, ``text``; conversations are rebuilt first (``rebuilt``).
    """
    lengths, sequence = rebuilt(turns(conversations))
    return trie(stage(lengths, "lengths"), stage(sequence, "sequence"))


def trie(lengths: DataFrame, sequence: DataFrame) -> DataFrame:
    """The trie of given sequences: (``c``, ``turns``), and (``c``, ``pos``, ``hash``, ``bytes``) of their turns."""
    longest, root, all_ = lengths.agg(F.max("turns"), F.min("c"), F.count(F.lit(1))).first()
    steps = (longest or 0).bit_length()
    named = _named(lengths, sequence, steps, root)
    none = F.lit(None).cast("bigint")
    at_top = [F.lit(0).cast("bigint").alias("depth"), F.lit(root).cast("bigint").alias("name")]
    top = lengths.filter(F.col("c") == F.lit(root)).select(
        F.lit(steps).alias("level"), *at_top, none.alias("root"), none.alias("root_depth"), F.lit(all_).cast("bigint").alias("n_convs")
    )
    own, links, ends = [top], [None] * steps, []
    for step, (names, now) in zip(reversed(range(steps)), named):
        depth = (F.col("lo") + (1 << step)).alias("depth")
        own.append(names.select(F.lit(step).alias("level"), depth, "name", "root", F.col("lo").alias("root_depth"), F.col("w").alias("n_convs")))
        below = now.filter(F.col("until") > F.col("lo") + (1 << step))
        links[step] = below.filter("cut").filter(F.col("until") == F.col("lo") + (2 << step)).select(
            depth, "name", F.col("until").alias("end_depth"), F.col("rep").alias("end")
        )
        ends.append(now.filter(~F.col("cut") & (F.col("until") == F.col("lo") + (1 << step))).select(depth, "name", F.col("rep").alias("c")))
    nodes = stage(reduce(DataFrame.unionByName, own), "nodes")
    # the parent of a node at an odd depth is the root of its range, of one at an even depth the name it is linked to last
    parents = nodes.filter("level = 0").select("depth", "name", F.col("root").alias("parent"))
    if steps:
        parents = parents.unionByName(links[0].select(F.col("end_depth").alias("depth"), F.col("end").alias("name"), F.col("name").alias("parent")))
    parents = stage(parents, "parents")
    children = parents.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    last = sequence.select(F.col("pos").alias("depth"), F.col("c").alias("name"), "bytes")
    full = nodes.join(parents, ["depth", "name"], "left").join(children, ["depth", "name"], "left").join(last, ["depth", "name"], "left")
    full = full.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    full = full.withColumn("leaf", (F.col("n_children") == 0).cast("int"))
    full = stage(full.withColumn("saved", (F.col("n_convs") - 1).cast("decimal(19,0)") * F.coalesce("bytes", F.lit(0)).cast("decimal(19,0)")), "full")
    totals = _grafted(full, links, steps)
    turnless = lengths.filter("turns = 0").select(*at_top, "c")
    digests = _id_digests(reduce(DataFrame.unionByName, [turnless, *ends]))
    empty = hashlib.sha256(b"").hexdigest()
    result = full.join(totals, ["depth", "name"]).join(digests, ["depth", "name"], "left")
    return result.select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
