"""Language-model scoring by cross-entropy difference.

Two bigram models are matched: one vocabulary, one set of bigrams, one
smoothing.  The background model counts every document; the target model counts
every document of the target.  A document's score is the mean over its words of
the target loss less the background loss, in nats; lower is closer to the target.
A probability mixes the bigrams after a word with the word frequencies:
``(c(h, w) + PRIOR * p(w)) / (c(h) + PRIOR)``.

``cross_entropy_difference`` keeps every word and every bigram.  Documents are cut
into blocks of a bounded number of words; a block asks for the counts of its
distinct words and bigrams, one row per bucket of hash values.  A bucket adds up
what the blocks have and answers each of them, so a very common bigram reaches
its bucket once per block, and no model is gathered or broadcast.  Hash equality
stands for equality: 64 bits, and the bucket by other bits.

Defined results: words are runs without white space, in lower case; a document
without words has null losses and score; a null id is scored but is never of the
target; repeated rows count and are scored one by one; an empty table gives an
empty table; a target without documents gives the uniform vocabulary as target.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from vigilpay.llm.arrays import mix
from vigilpay.llm.common import stage
from vigilpay.llm.exchange import bucket_count

PRIOR = 50.0
#: Words of one block; a longer text is a block of its own.
BLOCK = 1 << 21
_LOSSES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _tokens(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


_BLOCK = "block long, bucket int, texts long, target_texts long, tokens long, target_tokens long, ids binary, inside binary, counts binary, words binary, flat binary"
_ASKED = "bucket int, block long, word_keys binary, word_counts binary, pair_keys binary, pair_counts binary"
_ANSWER = "block long, bucket int, distinct long, word_counts binary, pair_counts binary"
_START = np.uint64(0x5D4C3B2A19087F6E)


class _Numbers(dict):
    """Numbers words in the order in which they appear."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _pack(values: np.ndarray) -> bytes:
    """Numbers by byte planes, which compress as most are small."""
    flat = np.ascontiguousarray(values.T).reshape(-1)
    return zlib.compress(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, flat.itemsize).T).tobytes(), 1)


def _unpack(packed: bytes, kind: type, columns: int = 1) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    flat = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
    return flat if columns == 1 else flat.reshape(columns, -1).T


def _rows(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    of = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in kinds.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), of[t]) for c, t in zip(columns, types)], names=list(names))


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: ids, marks of the target, numbers of words, words as hashes, all words as places among them."""
    task, nth = TaskContext.get().partitionId(), 0
    seen, flat, ids, inside, counts = _Numbers(), array("i"), [], [], []

    def out() -> pa.RecordBatch:
        n, marks = np.array(counts, np.int64), np.array(inside, bool)
        valid = np.array([i is not None for i in ids])
        words = np.fromiter((xxhash.xxh64_intdigest(w) for w in seen), np.uint64, len(seen))
        return _rows([(
            task << 32 | nth, -1, int((n > 0).sum()), int((n[marks] > 0).sum()), int(n.sum()), int(n[marks].sum()),
            _pack(np.array([i or 0 for i in ids], np.int64)), _pack(np.stack([valid, marks], axis=1).astype(np.uint8)),
            _pack(n), words.tobytes(), _pack(np.frombuffer(flat, np.int32)),
        )], _BLOCK)

    for batch in _slices(batches):
        for i, text, mark in zip(*(c.to_pylist() for c in batch.columns)):
            words = _tokens(text)
            flat.extend(map(seen.__getitem__, words))
            ids.append(i)
            inside.append(mark)
            counts.append(len(words))
            if len(flat) >= most:
                yield out()
                nth += 1
                seen, flat, ids, inside, counts = _Numbers(), array("i"), [], [], []
    if ids:
        yield out()


def _places(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by bucket, and where each bucket begins in it."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


class _Block:
    """A block with its distinct bigrams, and the order in which it asks for words and bigrams."""

    def __init__(self, words: bytes, flat: bytes, counts: bytes, buckets: int):
        self.words = np.frombuffer(words, np.uint64)
        self.flat, self.counts = _unpack(flat, np.int32).astype(np.int64), _unpack(counts, np.int64)
        self.some = np.flatnonzero(self.counts)
        self.starts = (np.cumsum(self.counts) - self.counts)[self.some]
        width = len(self.words) + 1
        before = np.empty_like(self.flat)
        before[1:] = self.flat[:-1]
        before[self.starts] = width - 1
        self.codes, self.own = np.unique(before * width + self.flat, return_inverse=True)
        self.first, self.second = self.codes // width, self.codes % width
        n, one = np.uint64(buckets), np.append(self.words, _START)[self.first]
        two = self.words[self.second] if len(self.words) else np.zeros(0, np.uint64)
        self.keys = mix(mix(one) + two * np.uint64(0x9E3779B97F4A7C15))
        self.word_order, self.word_cuts = _places((mix(self.words ^ np.uint64(0xA5A5)) % n).astype(np.int64), buckets)
        bucket = mix(mix(one ^ np.uint64(0x3C3C)) + mix(two) * np.uint64(0xC2B2AE3D27D4EB4F))
        self.pair_order, self.pair_cuts = _places((bucket % n).astype(np.int64), buckets)


def _ask(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The words and bigrams of every block with their counts (all, target), by bucket."""
    for batch in batches:
        for at in range(batch.num_rows):
            number, words, flat, counts, marks = (batch.column(c)[at].as_py() for c in range(5))
            b = _Block(words, flat, counts, buckets)
            inside = np.repeat(_unpack(marks, np.uint8, 2)[:, 1], b.counts).astype(np.int64)
            n = np.bincount(b.own, minlength=len(b.codes)).astype(np.int64)
            t = np.bincount(b.own, inside, len(b.codes)).astype(np.int64)
            add = lambda at, values: np.bincount(at, values, len(b.words) + 1)[: len(b.words)].astype(np.int64)
            # a word as the second of a bigram, then as the first
            ones = np.stack([add(b.second, n), add(b.second, t), add(b.first, n), add(b.first, t)], axis=1)
            pairs, rows = np.stack([n, t], axis=1), []
            for k in np.flatnonzero(np.diff(b.word_cuts) + np.diff(b.pair_cuts)):
                w, p = b.word_order[b.word_cuts[k] : b.word_cuts[k + 1]], b.pair_order[b.pair_cuts[k] : b.pair_cuts[k + 1]]
                rows.append((int(k), number, b.words[w].tobytes(), _pack(ones[w]), b.keys[p].tobytes(), _pack(pairs[p])))
            yield _rows(rows, _ASKED)


def _added(keys: list[bytes], counts: list[bytes], columns: int) -> tuple[list[bytes], int]:
    """For every block the sums over all blocks of what it has counted; the number of distinct keys."""
    each = [np.frombuffer(k, np.uint64) for k in keys]
    flat = np.concatenate(each)
    if not len(flat):
        return counts, 0
    order = np.argsort(flat, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
    values = np.concatenate([_unpack(c, np.int64, columns) for c in counts])
    sums = np.add.reduceat(values[order], starts, axis=0)
    values[order] = np.repeat(sums, np.diff(np.r_[starts, len(flat)]), axis=0)
    return [_pack(v) for v in np.split(values, np.cumsum([len(x) for x in each])[:-1])], len(starts)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by bucket."""
    def out(held: list[tuple]) -> pa.RecordBatch:
        bucket, blocks, word_keys, words, pair_keys, pairs = zip(*held)
        words, distinct = _added(word_keys, words, 4)
        pairs, _ = _added(pair_keys, pairs, 2)
        new = [distinct] + [0] * (len(held) - 1)
        return _rows(list(zip(blocks, bucket, new, words, pairs)), _ANSWER)

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                yield out(held)
                held = []
            held.append(row)
    if held:
        yield out(held)


def _judged(block: tuple, answers: list[tuple], buckets: int, totals: list[tuple[int, int]], size: int) -> pa.RecordBatch:
    """Losses of the documents of a block; ``totals`` are tokens and texts, of the target and of all."""
    ids, marks, counts, words, flat = block
    b = _Block(words, flat, counts, buckets)
    ones, pairs = np.empty((len(b.words) + 1, 4)), np.empty((len(b.codes), 2))
    if answers:
        ones[b.word_order] = np.concatenate([_unpack(a[0], np.int64, 4) for a in answers])
        pairs[b.pair_order] = np.concatenate([_unpack(a[1], np.int64, 2) for a in answers])
    sums = np.zeros((2, len(b.counts)))
    for k, column in enumerate((1, 0)):
        tokens, texts = totals[k]
        after = ones[:, 2 + column].copy()
        after[-1] = texts
        prior = PRIOR * (ones[:, column] + 1.0) / (tokens + size)
        losses = -np.log((pairs[:, column] + prior[b.second]) / (after[b.first] + PRIOR))
        if len(b.some):
            sums[k, b.some] = np.add.reduceat(losses[b.own], b.starts)
    empty, mean = b.counts == 0, sums / np.maximum(b.counts, 1)
    valid = _unpack(marks, np.uint8, 2)[:, 0].astype(bool)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(_unpack(ids, np.int64), mask=~valid), pa.array(b.counts),
            *[pa.array(c, pa.float64(), mask=empty) for c in (mean[0], mean[1], mean[0] - mean[1])],
        ],
        names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
    )


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, condition: str) -> DataFrame:
    """Score every document by models of all documents and of all documents whose label meets the condition."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(length, int(spark.conf.get("spark.sql.shuffle.partitions")))
    target = labels.filter(condition).select(F.col("doc_id").cast("long").alias("__target")).filter("__target IS NOT NULL").distinct()
    # merged at every size: the target grows with the documents
    marked = docs.join(target.hint("merge"), F.col("doc_id") == F.col("__target"), "left")
    marked = marked.select("doc_id", "text", F.col("__target").isNotNull().alias("inside"))
    most = BLOCK
    blocks = stage(marked.mapInArrow(lambda rows: _cut(rows, most), _BLOCK), "lm-blocks")
    sums = blocks.agg(*[F.sum(c) for c in ("target_tokens", "target_texts", "tokens", "texts")]).first()
    totals = [(sums[0] or 0, sums[1] or 0), (sums[2] or 0, sums[3] or 0)]
    asked = blocks.select("block", "words", "flat", "counts", "inside").mapInArrow(lambda rows: _ask(rows, buckets), _ASKED)
    answers = stage(asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_answer, _ANSWER), "lm-answers")
    # the word that no document has counts, too
    size = (answers.agg(F.sum("distinct")).first()[0] or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1] >= 0:
                    held.append(row[7:])
                    continue
                if block:
                    yield _judged(block, held, buckets, totals, size)
                block, held = row[2:7], []
        if block:
            yield _judged(block, held, buckets, totals, size)

    none = lambda *names: [F.lit(None).cast("binary").alias(n) for n in names]
    parts = ("ids", "inside", "counts", "words", "flat")
    rows = blocks.select("block", "bucket", *parts, *none("word_counts", "pair_counts")).unionByName(
        answers.select("block", "bucket", *none(*parts), "word_counts", "pair_counts")
    )
    # a block starts with its own row, and its answers follow by bucket
    return rows.repartition(buckets, "block").sortWithinPartitions("block", "bucket").mapInArrow(run, _LOSSES)
