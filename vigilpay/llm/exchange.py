"""Finding hash values that several documents share, by a compact shuffle.

Tasks reduce what they have read to one row per (hash value, smallest document),
decide what they can decide alone, and ship the rest as blocks of numbers: one
binary row per bucket of hash values.  A bucket is compared in one task and
answers to the documents.  A value that very many documents hold therefore
reaches its bucket once per block read, not once per document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Values a task gathers before it ships them.
FLUSH = 1 << 20
#: Bytes of text whose values make one bucket.  Larger executors can take more.
BUCKET_BYTES = 24 << 20

#: What a probe function yields: document ids, hash values, 32 more bits of them (or None), marks (or None).
Probes = tuple[np.ndarray, np.ndarray, "np.ndarray | None", "np.ndarray | None"]
_SCHEMA = "bucket int, known boolean, ids binary, keys binary, checks binary, marks binary"
_ANSWER = "part int, ids binary, found binary"


def bucket_count(text_bytes: int, least: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return max(least, math.ceil(text_bytes / bucket_bytes))


def key_bits(buckets: int) -> int:
    """Bits of a hash of which the part beyond the bucket number fits 32 bits."""
    return 32 + int(math.log2(buckets))


def pack_ids(ids: np.ndarray) -> bytes:
    return zlib.compress(np.diff(ids, prepend=0).tobytes(), 1)


def unpack_ids(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), np.int64))


def answers_by_part(ids: np.ndarray, found: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Answers to documents in one block per part of the documents; ``found`` has a row per answer."""
    part = np.mod(ids, parts)
    order = np.lexsort((ids, part))
    ids, found = ids[order], found[order]
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[p], cuts[p + 1]
        yield int(p), pack_ids(ids[a:b]), found[a:b].tobytes()


def answer_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["part", "ids", "found"])


def by_document(answers: DataFrame, width: int) -> DataFrame:
    """(doc_id, found) from blocks of answers: all answers to a document, ``width`` numbers each, as one binary."""

    def out(blocks: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([unpack_ids(b[0]) for b in blocks])
        found = np.concatenate([np.frombuffer(b[1], np.uint64) for b in blocks]).reshape(-1, width)
        order = np.argsort(ids, kind="stable")
        ids, found = ids[order], found[order]
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ends = np.r_[starts[1:], len(ids)]
        for lo in range(0, len(starts), 5000):
            values = [found[a:b].tobytes() for a, b in zip(starts[lo : lo + 5000], ends[lo : lo + 5000])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[starts[lo : lo + 5000]], pa.int64()), pa.array(values, pa.binary())], names=["doc_id", "found"]
            )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], None
        for batch in batches:
            for p, ids, found in zip(*(c.to_pylist() for c in batch.columns)):
                if held and p != part:
                    yield from out(held)
                    held = []
                part = p
                held.append((ids, found))
        if held:
            yield from out(held)

    return answers.repartition("part").sortWithinPartitions("part").mapInArrow(gather, "doc_id long, found binary")


def _sorted(ids, keys, checks, marks):
    order = np.argsort(keys, kind="stable") if checks is None else np.lexsort((checks, keys))
    pick = lambda x: None if x is None else x[order]
    ids, keys, checks, marks = ids[order], keys[order], pick(checks), pick(marks)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    if checks is not None:
        new[1:] |= checks[1:] != checks[:-1]
    return ids, keys, checks, marks, np.flatnonzero(new)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "known", "ids", "keys", "checks", "marks"]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _ship(parts: list[Probes], buckets: int, later: bool) -> Iterator[pa.RecordBatch]:
    """Known answers of one block of probes, and what has to be asked."""
    join = lambda i: None if parts[0][i] is None else np.concatenate([p[i] for p in parts])
    ids, keys, checks, marks = (join(i) for i in range(4))
    if not len(keys):
        return
    ids, keys, checks, marks, starts = _sorted(ids, keys, checks, marks)
    sizes = np.diff(np.r_[starts, len(keys)])
    low = np.minimum.reduceat(ids, starts)
    known = ids > np.repeat(low, sizes) if later else np.repeat(np.maximum.reduceat(ids, starts) > low, sizes)
    settled = np.zeros(len(starts), bool) if later else known[starts]
    known = known if later else known & marks
    # a known answer travels with the bucket of its part of the documents
    rows = [(part, True, who, found, None, None) for part, who, found in answers_by_part(ids[known], keys[known], buckets)]
    marked = np.zeros(len(starts), bool) if marks is None else np.maximum.reduceat(marks, starts)
    keys = keys[starts]
    checks = None if checks is None else checks[starts]
    # by bucket, then by document, so that ids compress
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((low, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    wide = checks is not None
    rest = keys if wide else (keys // np.uint64(buckets)).astype(np.uint32)
    for b in np.flatnonzero(np.diff(cuts)):
        at = order[cuts[b] : cuts[b + 1]]
        rows.append((
            int(b), False, pack_ids(low[at]), rest[at].tobytes(),
            checks[at].tobytes() if wide else None,
            np.packbits(np.concatenate([settled[at], marked[at]])).tobytes(),
        ))
    for i in range(0, len(rows), 2000):
        yield _table(rows[i : i + 2000])


def _answer(blocks: list[tuple], bucket: int, buckets: int, later: bool) -> Iterator[tuple[int, bytes, bytes]]:
    """Documents of one bucket with the values that they share."""
    wide = blocks[0][2] is not None
    ids = np.concatenate([unpack_ids(x[0]) for x in blocks])
    if wide:
        keys = np.concatenate([np.frombuffer(x[1], np.uint64) for x in blocks])
        checks = np.concatenate([np.frombuffer(x[2], np.uint32) for x in blocks])
    else:
        keys = np.concatenate([np.frombuffer(x[1], np.uint32) for x in blocks])
        checks = None
    marks = []
    for x in blocks:
        n = len(x[1]) // (8 if wide else 4)
        marks.append(np.unpackbits(np.frombuffer(x[3], np.uint8), count=2 * n).reshape(2, n).T.astype(bool))
    ids, keys, checks, marks, starts = _sorted(ids, keys, checks, np.concatenate(marks))
    sizes = np.diff(np.r_[starts, len(keys)])
    low = np.minimum.reduceat(ids, starts)
    if later:
        reply = ids > np.repeat(low, sizes)
    else:
        # a settled row stands for several documents of its block
        shared = (np.maximum.reduceat(ids, starts) > low) | np.logical_or.reduceat(marks[:, 0], starts)
        reply = np.repeat(shared, sizes) & ~marks[:, 0] & marks[:, 1]
    found = keys[reply]
    if not wide:
        found = found.astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
    yield from answers_by_part(ids[reply], found, buckets)


def shared_values(
    rows: DataFrame, probe: Callable[[pa.RecordBatch], Iterator[Probes]], buckets: int, later: bool
) -> DataFrame:
    """(doc_id, found): the hash values of each document that others hold, as one binary of uint64.

    ``probe`` turns a batch of ``rows`` into probes.  With ``later``, a value is
    answered to every document but the smallest that holds it, and two values
    are equal if their further bits are, too.  Otherwise a value that at least two
    documents hold is answered to those that have marked it; then only
    ``key_bits`` bits of a value count.
    """
    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for part in probe(batch):
                parts.append(part)
                n += len(part[1])
                if n >= FLUSH:
                    yield from _ship(parts, buckets, later)
                    parts, n = [], 0
        if parts:
            yield from _ship(parts, buckets, later)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            known = []
            for b, settled, ids, keys, checks, marks in zip(*(c.to_pylist() for c in batch.columns)):
                if settled:
                    known.append((b, ids, keys))
                    continue
                if held and b != bucket:
                    yield answer_batch(list(_answer(held, bucket, buckets, later)))
                    held = []
                bucket = b
                held.append((ids, keys, checks, marks))
            if known:
                yield answer_batch(known)
        if held:
            yield answer_batch(list(_answer(held, bucket, buckets, later)))

    shipped = rows.mapInArrow(ship, _SCHEMA)
    answers = shipped.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, _ANSWER)
    return by_document(answers, 1)
