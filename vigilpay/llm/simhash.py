"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits and two link if at most three differ.  Cut into two
segments of 32 bits, at least one segment differs in one bit at most.  So every
segment is indexed under its 32 variants with one bit blanked out: two segments
that differ in at most one bit share a variant.  Fingerprints that meet under a
variant are compared.

Equal fingerprints are one row before anything else, so copies never meet.
Under a variant with very many fingerprints these are compared in pairs of
blocks, and links inside a set of fingerprints are given as a spanning set, not
as all pairs.

Defined results: a null or empty text has fingerprint 0 and links like any
other; documents with a null id have a fingerprint and the component of their
class; repeated ids keep their rows; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from vigilpay.llm.arrays import chunks, text_bytes
from vigilpay.llm.common import pass_through, stage
from vigilpay.llm.components import components

DISTANCE = 3
SEED = 42
SHINGLE = 3
#: Fingerprints under one variant that are compared in one go; more are compared block by block.
BLOCK = 4096
_LANES = np.uint64(0x0101010101010101)
_SMALL = 64


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of the words in lower case (A-Z only), repeats included."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    begins = [0] + [e + 1 for e in ends]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[b:e], SEED) for b, e in zip(begins, ends[shingle - 1 :])]


def majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits set in over half the hashes of each text; zero for a text without hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    # eight counters of eight bits in a word hold the bits of up to 255 hashes
    parts = -(-counts[full] // 255)
    first = np.cumsum(parts) - parts
    place = np.repeat(starts[full], parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _LANES
        in_part = np.add.reduceat(lanes, place).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = np.add.reduceat(in_part, first, axis=0)
        over = (2 * ones > counts[full][:, None]).astype(np.uint64)
        for lane in range(8):
            out[full] |= over[:, lane] << np.uint64(8 * lane + shift)
    return out


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint_bits") -> DataFrame:
    """``docs`` without the text, with its fingerprint as a signed long."""
    keep = pass_through(docs, [name, text])
    schema = docs.select(*keep).withColumn(name, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            raw, out = memoryview(data), []
            for lo, hi in chunks(offsets):
                each = [shingle_hashes(bytes(raw[offsets[i] : offsets[i + 1]]), shingle) for i in range(lo, hi)]
                counts = np.array([len(x) for x in each], np.int64)
                flat = np.fromiter((h for x in each for h in x), np.uint64, int(counts.sum()))
                out.append(majority(flat, np.cumsum(counts) - counts, counts))
            found = np.concatenate(out) if out else np.zeros(0, np.uint64)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=[*keep, name])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def _compare_small(key: np.ndarray, group: np.ndarray, bits: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within small groups of consecutive rows; a pair links under its first common variant only."""
    found, n, step = [], len(bits), 1
    while step < n:
        same = np.flatnonzero(group[step:] == group[:-step])
        if not len(same):
            break
        a, b = bits[same], bits[same + step]
        apart = a ^ b
        close = np.bitwise_count(apart) <= DISTANCE
        low = apart & np.uint64(0xFFFFFFFF)
        # under which variant this pair meets first: of the lower segment if that allows it
        lower = np.bitwise_count(low) <= 1
        differing = np.where(lower, low, apart >> np.uint64(32))
        at = np.where(differing == 0, 0, np.bitwise_count(np.maximum(differing, np.uint64(1)) - np.uint64(1)))
        first = np.where(lower, at, at + 32)
        ok = close & (first == (key[same] >> 33))
        found.append((a[ok], b[ok]))
        step += 1
    return found


def _compare_large(bits: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning set of the links within one large group."""
    label = np.arange(len(bits))
    while True:
        new = label.copy()
        for lo in range(0, len(bits), 256):
            near = np.bitwise_count(bits[lo : lo + 256, None] ^ bits[None, :]) <= DISTANCE
            new[lo : lo + 256] = np.where(near, label[None, :], len(bits)).min(axis=1)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(bits)))
    return [(bits[other], bits[label[other]])]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within rows of equal (key, part), which arrive sorted."""
    held: list[np.ndarray] = []

    def emit(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(rows)])
        bits = rows[:, 2].view(np.uint64)
        small = np.repeat((sizes > 1) & (sizes <= _SMALL), sizes)
        group = np.repeat(np.arange(len(starts)), sizes)
        pairs = _compare_small(rows[small, 0], group[small], bits[small])
        for at in np.flatnonzero(sizes > _SMALL):
            pairs += _compare_large(bits[starts[at] : starts[at] + sizes[at]])
        a = np.concatenate([np.zeros(0, np.uint64)] + [p[0] for p in pairs]).view(np.int64)
        b = np.concatenate([np.zeros(0, np.uint64)] + [p[1] for p in pairs]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        if not len(rows):
            continue
        held.append(rows)
        last = rows[-1, :2]
        if (rows[0, :2] == last).all():
            continue  # the whole batch belongs to the group that is open
        rows = np.concatenate(held)
        cut = len(rows) - int((rows[::-1, :2] == last).all(axis=1).argmin())
        yield from emit(rows[:cut])
        held = [rows[cut:]]
    if held:
        yield from emit(np.concatenate(held))


def links(distinct: DataFrame, bits: str = "bits") -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints within ``DISTANCE`` bits of one another."""
    segment = lambda s: F.shiftrightunsigned(F.col(bits), 32 * s).bitwiseAND(F.lit(0xFFFFFFFF))
    variant = lambda s, i: F.lit((32 * s + i) << 33).bitwiseOR(
        segment(s).bitwiseAND(F.lit(0xFFFFFFFF & ~(1 << i)))
    )
    keys = F.array(*[variant(s, i) for s in range(2) for i in range(32)])
    index = distinct.select(F.explode(keys).alias("key"), F.col(bits).alias("bits"))
    crowded = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * BLOCK)
    crowded = crowded.select(F.col("key").alias("k"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = index.join(crowded, F.col("key") == F.col("k"), "left")
    own = F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int")
    # a block meets every block once: pair (low, high) has the number low * blocks + high
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: (F.least(own, other) * F.col("blocks") + F.greatest(own, other)).cast("long"),
    )
    parts = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(meets)
    rows = placed.select("key", F.explode(parts).alias("part"), "bits")
    return rows.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(_linked, "a long, b long")


def with_components(prints: DataFrame, bits: str = "fingerprint_bits", doc_id: str = "doc_id") -> DataFrame:
    """Adds ``component_id`` (smallest id reachable by links) to rows that have a fingerprint."""
    classes = prints.groupBy(F.col(bits).alias("bits")).agg(F.min(doc_id).alias("low"))
    classes = stage(classes, "simhash-classes")
    found = components(links(classes))
    named = classes.join(found, F.col("bits") == F.col("node"), "left").select(
        "bits", "low", F.coalesce("component", "bits").alias("component")
    )
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    members = named.join(least, "component").select(F.col("bits").alias("__bits"), "component_id")
    own = pass_through(prints, ["component_id"])
    return prints.join(members, F.col(bits) == F.col("__bits")).select(*own, "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, ``fingerprint`` (hex) and ``component_id``."""
    prints = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    prints = stage(prints, "simhash-prints")
    return with_components(prints).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint_bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The document with the smallest id of every component, with all columns; of equal rows, one.

    Rows are told apart by id and text, so of several rows of one id only those
    whose own text is in the id's component stay.  Documents without an id stay,
    once per text, where their component has no id at all.
    """
    key = F.xxhash64(F.col(text))
    prints = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), key.alias("text_key")))
    groups = with_components(stage(prints, "simhash-prints"))
    keepers = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("__keep"), F.col("text_key").alias("__key")
    )
    same = F.col(doc_id).eqNullSafe(F.col("__keep")) & (key == F.col("__key"))
    kept = docs.join(keepers.distinct(), same, "left_semi")
    order = Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.xxhash64(*docs.columns))
    return kept.withColumn("__copy", F.row_number().over(order)).filter("__copy = 1").select(*docs.columns)
