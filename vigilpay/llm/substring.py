"""Removal of repeated passages: fixed-block anchors, extended to maximal exact repeats.

A window is 13 consecutive words.  Every document is cut into non-overlapping
blocks of 7 words, which are the index; every rolling run of 7 words probes it.
A window holds one whole block of its own document wherever it begins, and if
another document has the window, one of its probes finds that block.  Around the
blocks that were found, the anchors, windows are compared as wholes (96-bit
hashes), and runs of equal windows are the maximal exact repeats.  A word goes if a window over it also begins in a
document with a smaller id.

The text is read twice and shuffled once, by document.  Anchors and windows are
compared through ``exchange``.

Defined results: a null or empty text has no words, nothing removed and the
checksum of nothing; documents without an id neither lose words nor take them
from others; rows with the same id do not take words from one another; an empty
table gives an empty table; other columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from vigilpay.llm.arrays import chunks, covered, prefix_sums, rolling, span_hashes, text_bytes, word_spans
from vigilpay.llm.common import identified, pass_through
from vigilpay.llm.exchange import Probes, bucket_count, key_bits, shared_values

WINDOW = 13


def block_of(window: int) -> int:
    """The longest block of which a window holds a whole one wherever it begins."""
    return (window + 1) // 2


class _Words:
    """Words of some texts as spans and hashes, with the rolling hashes of blocks and windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, second: bool = False):
        self.begins, self.ends, self.first = word_spans(data, offsets)
        self.counts = np.diff(self.first)
        self.window, self.block = window, block_of(window)
        self.hashes = span_hashes(prefix_sums(data), self.begins, self.ends)
        self.second = span_hashes(prefix_sums(data, 1), self.begins, self.ends) if second else None
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.left = self.first[1:][self.doc] - np.arange(len(self.doc)) if len(self.doc) else self.doc

    def anchors(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of rolling blocks, in texts that have a window, and their hashes cut to ``bits``."""
        at = np.flatnonzero((self.left >= self.block) & (self.counts >= self.window)[self.doc])
        return at, rolling(self.hashes, self.block)[at] >> np.uint64(64 - bits)

    def windows(self) -> np.ndarray:
        return np.flatnonzero(self.left >= self.window)


def _texts(batch: pa.RecordBatch, column: int, window: int, second: bool = False):
    data, offsets = text_bytes(batch.column(column))
    for lo, hi in chunks(offsets):
        part = data[offsets[lo] : offsets[hi]]
        yield lo, hi, _Words(part, offsets[lo : hi + 1] - offsets[lo], window, second)


def _anchor_probe(window: int, bits: int):
    def probe(batch: pa.RecordBatch) -> Iterator[Probes]:
        ids = batch.column(0).to_numpy()
        for lo, hi, words in _texts(batch, 1, window):
            at, keys = words.anchors(bits)
            doc = words.doc[at]
            yield ids[lo:hi][doc], keys, None, (at - words.first[doc]) % words.block == 0

    return probe


def _window_probe(window: int, bits: int):
    def probe(batch: pa.RecordBatch) -> Iterator[Probes]:
        ids = batch.column(0).to_numpy()
        found = batch.column(2)
        for lo, hi, words in _texts(batch, 1, window, second=True):
            at, keys = words.anchors(bits)
            own = (at - words.first[words.doc[at]]) % words.block == 0
            at, keys = at[own], keys[own]
            hit = np.zeros(len(words.doc) + 1, np.int64)
            cuts = np.searchsorted(at, words.first)
            for i in range(hi - lo):
                a, b = cuts[i], cuts[i + 1]
                if b > a:
                    hit[at[a:b]] = np.isin(keys[a:b], np.frombuffer(found[lo + i].as_py(), np.uint64))
            # hits before each place; a window is looked at if the block inside it is a hit
            before = np.r_[0, np.cumsum(hit)]
            begins = words.windows()
            begins = begins[before[begins + words.window - words.block + 1] > before[begins]]
            one, two = rolling(words.hashes, window), (rolling(words.second, window) >> np.uint64(32)).astype(np.uint32)
            yield ids[lo:hi][words.doc[begins]], one[begins], two[begins], None

    return probe


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, found): hashes of the windows of each document that a smaller document has too.

    ``docs`` has ``doc_id`` (long, not null) and ``text`` first; other columns
    only go along, so that a later join can share the shuffle.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = key_bits(buckets)
    rest = docs.columns[2:]
    anchors = shared_values(docs.select("doc_id", "text"), _anchor_probe(window, bits), buckets, later=False)
    anchors = anchors.select(F.col("doc_id").alias("__id"), F.col("found").alias("__found"))
    # both joins of the texts are on the document and share one shuffle of them
    near = docs.join(anchors, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "__found", *rest)
    return shared_values(near, _window_probe(window, bits), buckets, later=True)


def _kept(text: bytes, begins: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> list[bytes]:
    return [text[b:e] for b, e in zip(begins[~gone], ends[~gone])]


def _cut(window: int, names: list[str], with_text: bool):
    """Batches of (other columns, text, found) to (other columns, results)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at_text = batch.num_columns - 2
            found = batch.column(at_text + 1)
            data, offsets = text_bytes(batch.column(at_text))
            raw = data.tobytes()
            total, removed, digests, texts = [], [], [], []
            for i in range(batch.num_rows):
                text = raw[offsets[i] : offsets[i + 1]]
                if not found[i].is_valid:
                    words = text.split()
                    total.append(len(words))
                    removed.append(0)
                    texts.append(text if with_text else None)
                else:
                    own = np.frombuffer(text, np.uint8)
                    spans = _Words(own, np.array([0, len(own)]), window)
                    begins = spans.windows()
                    hit = begins[np.isin(rolling(spans.hashes, window)[begins], np.frombuffer(found[i].as_py(), np.uint64))]
                    gone = covered(len(spans.doc), hit, window)
                    words = _kept(text, spans.begins, spans.ends, gone)
                    total.append(len(gone))
                    removed.append(int(gone.sum()))
                    texts.append(_without(text, spans, gone) if with_text else None)
                if not with_text:
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            columns = [batch.column(i) for i in range(at_text)]
            if with_text:
                valid = batch.column(at_text).is_valid().to_pylist()
                columns += [pa.array([t.decode() if v else None for t, v in zip(texts, valid)], pa.string())]
            else:
                columns += [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _without(text: bytes, spans: _Words, gone: np.ndarray) -> bytes:
    """The text without the words that go and the space after each; other space stays as it is."""
    if not gone.any():
        return text
    keep = np.ones(len(text), bool)
    nexts = np.r_[spans.begins[1:], len(text)]
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, spans.begins[gone], 1)
    np.add.at(change, nexts[gone], -1)
    keep &= np.cumsum(change[:-1]) == 0
    return np.frombuffer(text, np.uint8)[keep].tobytes()


def repeat_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed`` and the SHA-256 of the kept words."""
    some = identified(docs, doc_id, text)
    found = repeated_windows(some, window).select(F.col("doc_id").alias("__id"), F.col("found").alias("__found"))
    rows = some.join(found, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", "__found")
    none = docs.filter(F.col(doc_id).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("binary").alias("__found")
    )
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    run = _cut(window, names, with_text=False)
    return rows.mapInArrow(run, schema).unionByName(none.mapInArrow(run, schema))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated words cut out of the text; all rows and columns stay."""
    others = pass_through(docs, [text])
    alias = {c: f"__c{i}" for i, c in enumerate(others)}
    if doc_id == "doc_id" and text == "text":
        alias = {c: c for c in others if c not in ("doc_id", "__found", "__id")}
    carried = docs.select(doc_id, text, *[F.col(c).alias(a) if a != c else c for c, a in alias.items()])
    some = identified(carried, doc_id, text, list(alias.values()))
    found = repeated_windows(some, window).select(F.col("doc_id").alias("__id"), F.col("found").alias("__found"))
    rows = some.join(found, F.col("doc_id") == F.col("__id"), "left")
    back = [F.col(alias[c]).alias(c) if c in alias else F.col("doc_id").cast(docs.schema[c].dataType).alias(c) for c in others]
    rows = rows.select(*back, F.col("text").alias(text), "__found")
    none = docs.filter(F.col(doc_id).isNull()).select(*others, text).withColumn("__found", F.lit(None).cast("binary"))
    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField(text, T.StringType())])
    run = _cut(window, [*others, text], with_text=True)
    return rows.mapInArrow(run, schema).unionByName(none.mapInArrow(run, schema)).select(*docs.columns)
