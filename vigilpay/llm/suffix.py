"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of 50 bytes over it also begins in a document with a
smaller id.  Every such string has a marker, the smallest hash among its 20-byte
grams, so equal strings have equal markers wherever they occur.  Consecutive
strings with one marker make a segment of text.  Segments whose marker occurs in
one document only are left alone; the others meet in buckets of markers.

In a bucket, segments are laid out as shards, each with its Burrows-Wheeler
transform.  The transforms are merged by refining their interleave: starting
from the order by the first bytes, each round puts the suffixes that are one
byte longer in order by a stable pass over the transform symbols, and the blocks
of equal prefixes split.  A block of one suffix has no common prefix to lengthen
and leaves.  After the round for 50 bytes, the blocks are the repeated
intervals: suffixes with a common prefix of 50 bytes.  The smallest document of
an interval keeps the string.

Equal segments are one before they are shipped and again in the bucket, so
copies never meet as rows.  A bucket holds the markers of a bounded amount of
text; the text is shuffled once, by document.

Defined results: a null text is empty; a text shorter than 50 bytes loses
nothing; documents without an id neither lose bytes nor take them from others;
rows with the same id do not take bytes from one another; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigilpay.llm.arrays import CHUNK_BYTES, _powers, chunks, covered, mix, prefix_sums, ragged, span_hashes, text_bytes
from vigilpay.llm.common import identified
from vigilpay.llm.exchange import (
    FLUSH, Probes, answer_batch, answers_by_part, bucket_count, by_document, key_bits, pack_ids, shared_values, unpack_ids,
)

LENGTH = 50
GRAM = 20
#: Strings of one segment at most; the bits of an answer.
STRINGS = 64
#: Bytes of text whose markers make one bucket.
BUCKET_BYTES = 4 << 20
#: Symbols of one shard.
SHARD = 1 << 18
#: UTF-8 has no such byte.
_END = 0xFF
_FIRST = 8


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first string, number of strings and marker of every segment."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    sums = prefix_sums(data)
    grams = len(data) - GRAM + 1
    low = mix((sums[GRAM:] - sums[:-GRAM]) * _powers(len(sums))[1][:grams])
    width = 1
    span = LENGTH - GRAM + 1
    while 2 * width <= span:  # the smallest of 2, 4, 8 ... grams
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))[:n]
    whole = np.arange(n) + LENGTH <= offsets[1:][doc]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    begins = np.flatnonzero(new)
    ends = np.r_[begins[1:], n]
    # strings that run over the end of a text are the last ones of its last segments
    inside = np.r_[0, np.cumsum(whole, dtype=np.int32)]
    counts = inside[ends] - inside[begins]
    begins, counts = begins[counts > 0], counts[counts > 0]
    if len(counts) and counts.max() > STRINGS:  # one gram over and over
        parts = -(-counts // STRINGS)
        nth = ragged(np.zeros(len(parts), np.int64), parts)
        starts = np.repeat(begins, parts) + nth * STRINGS
        counts = np.minimum(np.repeat(begins + counts, parts) - starts, STRINGS)
        begins = starts
    return doc[begins], begins, counts, mix(low[begins])


def _marker_probe(bits: int):
    def probe(batch: pa.RecordBatch) -> Iterator[Probes]:
        ids = batch.column(0).to_numpy()
        data, offsets = text_bytes(batch.column(1))
        for lo, hi in chunks(offsets, CHUNK_BYTES // 2):
            part = data[offsets[lo] : offsets[hi]]
            doc, _, _, marker = segments(part, offsets[lo : hi + 1] - offsets[lo])
            yield ids[lo:hi][doc], marker >> np.uint64(64 - bits), None, np.ones(len(doc), bool)

    return probe


# --- Burrows-Wheeler transforms of shards and their merge ------------------------------


def _leading(text: np.ndarray) -> np.ndarray:
    """The next eight symbols at each place as one number; after the end come end marks."""
    padded = np.concatenate([text, np.full(_FIRST, _END, np.uint8)])
    keys = np.zeros(len(text), np.uint64)
    for k in range(_FIRST):
        keys = (keys << np.uint64(8)) | padded[k : k + len(text)]
    return keys


def transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array (to 64 symbols), Burrows-Wheeler transform, steps to the suffix one longer, leading symbols."""
    n = len(text)
    keys = _leading(text)
    order = np.argsort(keys, kind="stable").astype(np.int32)
    new = np.ones(n, bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    depth = _FIRST
    while depth < 64 and not new.all():
        # only suffixes in blocks of several are ordered further, by the block of the suffix behind
        heads = np.flatnonzero(new)
        block = np.repeat(heads, np.diff(np.r_[heads, n]))
        rank = np.empty(n, np.int64)
        rank[order] = block
        tied = np.repeat(np.diff(np.r_[heads, n]) > 1, np.diff(np.r_[heads, n]))
        at = np.flatnonzero(tied)
        behind = order[at] + depth
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], n)
        by = np.lexsort((second, block[at]))
        order[at] = order[at][by]
        second = second[by]
        split = np.zeros(len(at), bool)
        split[1:] = (second[1:] != second[:-1]) & (block[at][1:] == block[at][:-1])
        new[at[split]] = True
        depth *= 2
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    before = order - 1  # the first suffix is preceded by the last symbol, an end mark
    return order, text[before], place[before], keys[order]


def repeated_intervals(shards: list[np.ndarray], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the shards laid end to end) of suffixes with a common prefix of ``length``, and their interval.

    Each shard ends with an end mark; prefixes do not run over one.
    """
    parts = [transform(s) for s in shards]
    base = np.cumsum([0] + [len(s) for s in shards]).astype(np.int32)  # a bucket is small
    suffix = np.concatenate([p[0] + b for p, b in zip(parts, base)])
    symbol = np.concatenate([p[1] for p in parts])
    longer = np.concatenate([p[2] + b for p, b in zip(parts, base)])
    keys = np.concatenate([p[3] for p in parts])
    # the interleave by the leading symbols; each shard is a sorted run, so this merges runs
    del parts
    merged = np.argsort(keys, kind="stable").astype(np.int32)
    keys = keys[merged]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    # prefixes with an end mark have no string
    shifts = (np.uint64(8 * k) for k in range(_FIRST))
    marked = np.zeros(len(keys), bool)
    for s in shifts:
        marked |= (keys >> s) & np.uint64(0xFF) == _END
    block = np.cumsum(new, dtype=np.int32)
    merged, block = _several(merged[~marked], block[~marked])
    del keys, marked
    for _ in range(length - _FIRST):
        c = symbol[merged]
        order = np.argsort(c, kind="stable")
        order = order[: np.searchsorted(c[order], _END)]
        c, merged, block = c[order], longer[merged[order]], block[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (block[1:] != block[:-1])
        merged, block = _several(merged, np.cumsum(new, dtype=np.int32))
    return suffix[merged], block


def _several(merged: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without blocks of one suffix."""
    if not len(block):
        return merged, block
    edge = np.ones(len(block) + 1, bool)
    edge[1:-1] = block[1:] != block[:-1]
    alone = edge[1:] & edge[:-1]
    return merged[~alone], block[~alone]


# --- shipping segments and answering them ------------------------------------------------

_SCHEMA = "bucket int, known boolean, ids binary, sizes binary, texts binary"
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["bucket", "known", "ids", "sizes", "texts"]
    )


def _answers(ids: np.ndarray, hashes: np.ndarray, strings: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Answers: pairs of segment hash and the strings in it that go, as bits."""
    return answers_by_part(ids, np.stack([hashes, strings], axis=1), parts)


def _distinct(ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per distinct segment: a row that holds it in its smallest document; and the segment of every row."""
    order = np.lexsort((ids, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    own = np.empty(len(order), np.int64)
    own[order] = np.cumsum(new) - 1
    return order[new], own, order


def _ship(parts: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Segments of a block of documents: later copies are answered, the first of each goes to its bucket."""
    ids, marker, one, two, sizes = (np.concatenate([p[i] for p in parts]) for i in range(5))
    if not len(ids):
        return
    texts = np.concatenate([p[5] for p in parts])
    places = np.cumsum(sizes) - sizes
    first, own, _ = _distinct(ids, one, two)
    later = ids > ids[first][own]
    # a known answer travels with the bucket of its part of the documents
    known = _answers(ids[later], one[later], np.full(int(later.sum()), _FULL), buckets)
    rows = [(part, True, who, None, found) for part, who, found in known]
    bucket = (marker[first] % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((ids[first], bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        at = first[order[cuts[b] : cuts[b + 1]]]
        rows.append((
            int(b), False, pack_ids(ids[at]), sizes[at].astype(np.uint8).tobytes(), texts[ragged(places[at], sizes[at])].tobytes(),
        ))
    for i in range(0, len(rows), 500):
        yield _table(rows[i : i + 500])


def _segment_rows(batch: pa.RecordBatch, bits: int) -> Iterator[tuple]:
    """Segments of documents whose marker is shared: ids, markers, both hashes, sizes, texts."""
    ids, found = batch.column(0).to_numpy(), batch.column(2)
    data, offsets = text_bytes(batch.column(1))
    for lo, hi in chunks(offsets, CHUNK_BYTES // 2):
        part = data[offsets[lo] : offsets[hi]]
        doc, begins, counts, marker = segments(part, offsets[lo : hi + 1] - offsets[lo])
        keys = marker >> np.uint64(64 - bits)
        keep = np.zeros(len(doc), bool)
        cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            a, b = cuts[i], cuts[i + 1]
            if b > a:
                keep[a:b] = np.isin(keys[a:b], np.frombuffer(found[lo + i].as_py(), np.uint64))
        doc, begins, counts, marker = doc[keep], begins[keep], counts[keep], marker[keep]
        sizes = counts + LENGTH - 1
        one = span_hashes(prefix_sums(part), begins, begins + sizes)
        two = span_hashes(prefix_sums(part, 1), begins, begins + sizes)
        yield ids[lo:hi][doc], marker, one, two, sizes, part[ragged(begins, sizes)]


def _answer(blocks: list[tuple], parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Answers for the segments of one bucket."""
    ids = np.concatenate([unpack_ids(b[0]) for b in blocks])
    sizes = np.concatenate([np.frombuffer(b[1], np.uint8) for b in blocks]).astype(np.int64)
    text = np.concatenate([np.frombuffer(b[2], np.uint8) for b in blocks])
    begins = np.cumsum(sizes) - sizes
    one = np.empty(len(ids), np.uint64)
    two = np.empty(len(ids), np.uint64)
    cuts = np.searchsorted(begins, np.arange(0, len(text) + 1, 1 << 22))
    for a, b in zip(cuts, np.r_[cuts[1:], len(ids)]):
        if b > a:
            part = text[begins[a] : begins[b - 1] + sizes[b - 1]]
            at = begins[a:b] - begins[a]
            one[a:b] = span_hashes(prefix_sums(part), at, at + sizes[a:b])
            two[a:b] = span_hashes(prefix_sums(part, 1), at, at + sizes[a:b])
    first, own, _ = _distinct(ids, one, two)
    low = ids[first]  # the smallest document of each distinct segment
    # distinct segments in shards, each segment with an end mark
    length = sizes[first] + 1
    laid = np.cumsum(length) - length
    flat = np.full(int(length.sum()), _END, np.uint8)
    flat[ragged(laid, sizes[first])] = text[ragged(begins[first], sizes[first])]
    edges = np.unique(np.r_[laid[np.searchsorted(laid, np.arange(0, len(flat), SHARD))[:-1]] if len(flat) > SHARD else 0, 0, len(flat)])
    place, block = repeated_intervals([flat[a:b] for a, b in zip(edges, edges[1:])])
    segment = np.searchsorted(laid, place, side="right") - 1
    nth = place - laid[segment]
    # the smallest document of each string, by segment
    strings = sizes[first] - LENGTH + 1
    start = np.cumsum(strings) - strings
    least = np.repeat(low, strings)
    if len(block):
        heads = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        lows = np.minimum.reduceat(low[segment], heads)
        least[start[segment] + nth] = np.repeat(lows, np.diff(np.r_[heads, len(block)]))
    # each row asks for the strings that a smaller document has
    asked = np.minimum.reduceat(least, start)[own] < ids
    ids, own = ids[asked], own[asked]
    if not len(ids):
        return
    n = strings[own]
    gone = least[ragged(start[own], n)] < np.repeat(ids, n)
    bits = np.where(gone, np.uint64(1) << ragged(np.zeros(len(n), np.int64), n).astype(np.uint64), np.uint64(0))
    yield from _answers(ids, one[first][own], np.bitwise_or.reduceat(bits, np.cumsum(n) - n), parts)


def repeated_strings(docs: DataFrame) -> DataFrame:
    """(doc_id, found): for each document, its segments with strings of smaller documents.

    ``docs`` has ``doc_id`` (not null) and ``text``, and nothing else.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(size, int(spark.conf.get("spark.sql.shuffle.partitions")), BUCKET_BYTES)
    bits = key_bits(buckets)
    markers = shared_values(docs, _marker_probe(bits), buckets, later=False)
    markers = markers.select(F.col("doc_id").alias("__id"), F.col("found").alias("__found"))
    near = docs.join(markers, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "__found")

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for part in _segment_rows(batch, bits):
                parts.append(part)
                n += len(part[5])
                if n >= 8 * FLUSH:
                    yield from _ship(parts, buckets)
                    parts, n = [], 0
        if parts:
            yield from _ship(parts, buckets)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            known = []
            for b, settled, ids, sizes, texts in zip(*(c.to_pylist() for c in batch.columns)):
                if settled:
                    known.append((b, ids, texts))
                    continue
                if held and b != bucket:
                    yield answer_batch(list(_answer(held, buckets)))
                    held = []
                bucket = b
                held.append((ids, sizes, texts))
            if known:
                yield answer_batch(known)
        if held:
            yield answer_batch(list(_answer(held, buckets)))

    shipped = near.mapInArrow(ship, _SCHEMA).repartition("bucket").sortWithinPartitions("bucket")
    return by_document(shipped.mapInArrow(answer, "part int, ids binary, found binary"), 2)


def removed_bytes(data: np.ndarray, offsets: np.ndarray, found: list[bytes]) -> np.ndarray:
    """Which bytes of some texts, laid end to end, go, from what was found for the segments of each."""
    both = np.concatenate([np.frombuffer(f, np.uint64).reshape(-1, 2) for f in found])
    # an answer holds for its own document: the document is part of the key
    own = mix(np.arange(1, len(found) + 1, dtype=np.uint64))
    both[:, 0] += np.repeat(own, [len(f) // 16 for f in found])
    both = both[np.argsort(both[:, 0], kind="stable")]
    heads = np.flatnonzero(np.r_[True, both[1:, 0] != both[:-1, 0]])
    keys, strings = both[heads, 0], np.bitwise_or.reduceat(both[:, 1], heads)
    doc, begins, counts, _ = segments(data, offsets)
    hashes = span_hashes(prefix_sums(data), begins, begins + counts + LENGTH - 1) + own[doc]
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == hashes)
    begins, counts, bits = begins[hit], counts[hit], strings[at[hit]]
    starts, nth = ragged(begins, counts), ragged(np.zeros(len(counts), np.int64), counts)
    gone = (np.repeat(bits, counts) >> nth.astype(np.uint64)) & np.uint64(1)
    return covered(len(data), starts[gone.astype(bool)], LENGTH)


def repeat_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans`` and the SHA-256 of the bytes that stay."""
    some = identified(docs, doc_id, text)
    found = repeated_strings(some).select(F.col("doc_id").alias("__id"), F.col("found").alias("__found"))
    judged = some.join(found, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", "__found")
    none = docs.filter(F.col(doc_id).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("binary").alias("__found")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            found, rows = batch.column(2), []
            asked = found.is_valid().to_numpy(zero_copy_only=False)
            for lo, hi in chunks(offsets, CHUNK_BYTES // 2):
                own = [data[offsets[i] : offsets[i + 1]] for i in range(lo, hi)]
                some = [i for i in range(lo, hi) if asked[i]]
                if some:
                    laid = np.concatenate([own[i - lo] for i in some])
                    places = np.cumsum([0] + [len(own[i - lo]) for i in some])
                    all_gone = removed_bytes(laid, places, [found[i].as_py() for i in some])
                    cuts = {i: all_gone[a:b] for i, a, b in zip(some, places, places[1:])}
                for i, text in zip(range(lo, hi), own):
                    if not asked[i]:
                        rows.append((len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                        continue
                    gone = cuts[i]
                    spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
                    rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(text[~gone]).hexdigest()))
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return judged.mapInArrow(run, schema).unionByName(none.mapInArrow(run, schema))
