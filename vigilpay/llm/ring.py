"""Sharding on a consistent-hash ring with bounded loads, in DataFrame functions only.

Keys and virtual nodes of shards have places among ``CELLS`` cells of a ring.  A
key goes to the first virtual node at or after its cell.  A shard takes no more
rows than its share; keys that find it full continue clockwise to the next
virtual node of a shard with room.  Rows per shard therefore differ by one at
most, and adding a shard mostly moves keys into it.

Only rows per cell (at most ``CELLS`` numbers) reach the driver, which walks the
ring over counts.  Its answer, rank intervals of cells with their shard, has at
most ``CELLS * shards`` rows and is broadcast; rows find theirs by their rank in
the cell.

Defined results: null keys are keys like any other; equal rows stay separate
rows; a null text has size 1 and the checksum of an empty text; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, functions as F

from vigilpay.llm.common import counted_ranks

CELLS = 4096
VIRTUAL_NODES = 64


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order; a taken cell sends a node to the next free one."""
    if shards * virtual_nodes > CELLS:
        raise ValueError(f"at most {CELLS // virtual_nodes} shards with {virtual_nodes} virtual nodes")
    taken: dict[int, int] = {}
    for node in range(virtual_nodes):
        for shard in range(shards):
            cell = int(hashlib.md5(f"{shard}/{node}".encode()).hexdigest()[:8], 16) % CELLS
            while cell in taken:
                cell = (cell + 1) % CELLS
            taken[cell] = shard
    return sorted(taken.items())


def walk(counts: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[dict[str, int]]:
    """Rank intervals [lo, hi) of cells with their shard and the first slot there.

    Each round offers what is left of every cell, in ring order, to one more
    virtual node; the rows that a full shard leaves go on in the next round.
    """
    nodes = ring(shards, virtual_nodes)
    total = sum(counts.values())
    first, at = {}, 0
    for cell in range(CELLS):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        first[cell] = at % len(nodes)
    wanted = [0] * shards
    for cell, n in counts.items():
        wanted[nodes[first[cell]][1]] += n
    room = [total // shards] * shards
    for shard in sorted(range(shards), key=lambda s: (-wanted[s], s))[: total % shards]:
        room[shard] += 1
    filled, done, pieces = [0] * shards, dict.fromkeys(counts, 0), []
    left, turn = sorted(c for c, n in counts.items() if n), 0
    while left:
        rest = []
        for cell in left:
            shard = nodes[(first[cell] + turn) % len(nodes)][1]
            take = min(counts[cell] - done[cell], room[shard] - filled[shard])
            if take:
                pieces.append({"cell": cell, "lo": done[cell], "hi": done[cell] + take, "shard": shard, "base": filled[shard]})
                done[cell] += take
                filled[shard] += take
            if done[cell] < counts[cell]:
                rest.append(cell)
        left, turn = rest, turn + 1
    merged: list[dict[str, int]] = []
    for piece in sorted(pieces, key=lambda p: (p["cell"], p["lo"])):
        last = merged[-1] if merged else None
        if last and (last["cell"], last["hi"], last["shard"], last["base"] + last["hi"] - last["lo"]) == (
            piece["cell"], piece["lo"], piece["shard"], piece["base"]
        ):
            last["hi"] = piece["hi"]
        else:
            merged.append(piece)
    return merged


def shard_rows(keys: DataFrame, key: str, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``keys`` with ``shard`` and ``slot`` (from 0, without gaps, in each shard).

    All columns of ``keys`` take part in telling rows apart and should be narrow.
    """
    spark = keys.sparkSession
    cell = F.pmod(F.xxhash64(key), F.lit(CELLS)).cast("int")
    counts = {r["cell"]: r["n"] for r in keys.select(cell.alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    own = [c for c in keys.columns if c not in ("shard", "slot")]
    rows = keys.select(cell.alias("__cell"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(own)])
    ranked = counted_ranks(rows, ["__cell"], [f"__k{i}" for i in range(len(own))], sum(counts.values()))
    pieces = spark.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(walk(counts, shards, virtual_nodes))),
                             "array<struct<cell:int,lo:bigint,hi:bigint,shard:int,base:bigint>>"))
    )
    each = ranked.select("*", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("m") - 1)).alias("__rank"))
    # the intervals have at most CELLS * shards rows
    found = each.join(
        F.broadcast(pieces),
        (F.col("__cell") == F.col("cell")) & (F.col("__rank") >= F.col("lo")) & (F.col("__rank") < F.col("hi")),
    )
    return found.select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(own)], "shard",
        (F.col("base") + F.col("__rank") - F.col("lo")).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes plus 1), checksum of the text, shard and slot."""
    keys = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shard_rows(keys, "doc_id", shards)
