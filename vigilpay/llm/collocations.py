"""Phrase collocations from streams of counts in prefix and in suffix order.

Every word of a piece begins one n-gram of up to four words, padded with nothing at
the end of the piece, so one stream of four-word counts holds the counts of all
orders: the count of a shorter phrase is the sum over the run of n-grams that begin
with it.

1. Tasks turn texts into sorted, combined blocks of such n-grams (a dictionary of
   words and columns of numbers), and cut them at the bounds of ranges of the
   order.  Ranges are merged in prefix order and their runs are summed; only
   phrases counted ``least`` times or more, and those that reach over the edge of a
   range, leave this step.
2. The stream in prefix order is read with the path of prefixes at hand: each
   phrase meets the counts of its first words (left parts) and hands its own count
   up to the phrases it extends to the right.
3. The same in suffix order (words from last to first): right parts, and extensions
   to the left, which bring along what they were extended by on the right.

Nothing is looked up by hash.  A phrase that begins before a range and goes on in
it is read there as context, so a very common word or pair may fill many ranges.
Ranges are chosen on a sample, which moves their bounds and no count.

Defined results: a null text has no words and a null language is ``und``; rows with
null ids count like any other, repeated rows each time; columns of other names are
not read; an empty table, or one without phrases, gives an empty table.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from vigilpay.llm import arrays
from vigilpay.llm.common import stage

ORDER = 4
#: Counted at least this often, and the share of a phrase's count in a longer one that makes it part of that.
LEAST = 30
PART_OF = (100, 80)
SCALE = 2_000_000
TOP = 2000
#: Words that a task gathers before it cuts them into ranges.
FLUSH = 1 << 20
#: Bytes of text whose n-grams make one range.
RANGE_BYTES = 8 << 20
#: Ranges that one step cuts blocks into; more are reached in several steps.
FANOUT = 256
#: Bytes of text from which the bounds of ranges are chosen, and n-grams taken from a chunk at most.
SAMPLE_BYTES, SAMPLE_ROWS = 8 << 20, 4096
#: Phrases of a range in the later steps, and ranges at most; they are streamed, so their size is not bound by memory.
PHRASES, MOST_RANGES = 25_000, 4096

_WORDS = [f"w{i}" for i in range(1, ORDER + 1)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# what bytes are: 0 part of a word, 1 between words, 2 between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_BLOCK = "range int, langs binary, words binary, grams binary"


def _pack(values: list[bytes]) -> bytes:
    """Byte strings as one, compressed, with its size before."""
    raw = np.array([len(values), *map(len, values)], np.uint32).tobytes() + b"".join(values)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> pa.LargeBinaryArray:
    raw = pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    lengths = np.frombuffer(raw, np.uint32, n, 4)
    return _binary(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), np.frombuffer(raw, np.uint8, offset=4 * (n + 1)))


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def _ranked(words: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The distinct words in byte order, and the number (from 1) of each of ``words`` among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    number = np.empty(len(order), np.uint32)
    number[order.to_numpy()] = np.arange(1, len(order) + 1, dtype=np.uint32)
    return coded.dictionary.take(order), number[coded.indices.to_numpy()]


@dataclass
class _Grams:
    """Distinct n-grams in prefix order: a number for the language, one per word (0 for none), and counts."""

    langs: list[bytes]
    words: pa.LargeBinaryArray
    grams: np.ndarray  # (1 + ORDER, n), uint32
    counts: np.ndarray  # int64

    @classmethod
    def of(cls, langs: list[bytes], words: pa.LargeBinaryArray, grams: np.ndarray, counts: np.ndarray) -> "_Grams":
        """Sort and combine."""
        keys = [grams[0].astype(np.uint64) << np.uint64(32) | grams[1], grams[2].astype(np.uint64) << np.uint64(32) | grams[3]]
        order = np.lexsort((grams[4], keys[1], keys[0]))
        grams, counts = grams[:, order], counts[order]
        del keys, order
        starts = np.flatnonzero(np.r_[True, (grams[:, 1:] != grams[:, :-1]).any(axis=0)])
        return cls(langs, words, grams[:, starts], np.add.reduceat(counts, starts))

    @classmethod
    def merged(cls, parts: list["_Grams"]) -> "_Grams":
        langs = sorted({lang for p in parts for lang in p.langs})
        words, numbers = _ranked(pa.concat_arrays([p.words for p in parts]))
        base, columns = 0, []
        for p in parts:
            lang_of = np.array([langs.index(x) for x in p.langs], np.uint32)
            number = np.concatenate([np.zeros(1, np.uint32), numbers[base : base + len(p.words)]])
            base += len(p.words)
            columns.append(np.vstack([lang_of[p.grams[0]][None], number[p.grams[1:]]]))
        return cls.of(langs, words, np.hstack(columns), np.concatenate([p.counts for p in parts]))

    def __len__(self) -> int:
        return len(self.counts)

    def key(self, i: int) -> tuple[bytes, ...]:
        """Language and words of the n-gram at ``i``, empty for none: tuples compare as the stream is ordered."""
        row = self.grams[:, i].tolist()
        return (self.langs[row[0]], *[self.words[w - 1].as_py() if w else b"" for w in row[1:]])

    def blocks(self, bounds: list[tuple], number) -> Iterator[tuple]:
        """Rows of ``_BLOCK`` for the ranges between ``bounds``; ``number`` names a range by its place."""
        places, rows = [], range(len(self))
        for bound in bounds:
            places.append(bisect.bisect_left(rows, bound, lo=places[-1] if places else 0, key=self.key))
        for i, (a, b) in enumerate(zip([0, *places], [*places, len(self)])):
            if a < b:
                grams = self.grams[:, a:b]
                used, own = np.unique(grams[1:], return_inverse=True)
                has_none = int(used[0] == 0)
                words = self.words.take(pa.array(used[has_none:] - 1)).to_pylist()
                own = own.reshape(ORDER, -1).astype(np.uint32) + np.uint32(1 - has_none)
                columns = [grams[0].tobytes(), own.tobytes(), self.counts[a:b].tobytes()]
                yield number(i), _pack(self.langs), _pack(words), _pack(columns)

    @classmethod
    def read(cls, langs: bytes, words: bytes, grams: bytes) -> "_Grams":
        lang, own, counts = _unpack(grams).to_pylist()
        columns = np.vstack([np.frombuffer(lang, np.uint32)[None], np.frombuffer(own, np.uint32).reshape(ORDER, -1)])
        return cls(_unpack(langs).to_pylist(), _unpack(words), columns, np.frombuffer(counts, np.int64))

    def counted(self, least: int) -> Iterator[pa.RecordBatch]:
        """Phrases of all orders with their counts; the first and last of an order may go on in other ranges."""
        for k in range(ORDER + 1):
            at = np.flatnonzero(self.grams[k]) if k else np.arange(len(self))
            if not len(at):
                continue
            path = self.grams[: k + 1, at]
            starts = np.flatnonzero(np.r_[True, (path[:, 1:] != path[:, :-1]).any(axis=0)])
            sums = np.add.reduceat(self.counts[at], starts)
            edge = np.zeros(len(starts), bool)
            edge[[0, -1]] = True
            kept = np.flatnonzero((sums >= least) | edge | (k == 0))
            path, texts = path[:, starts[kept]], []
            for column in path[1:]:
                texts.append(self.words.take(pa.array(column - 1)).cast(pa.large_string()).cast(pa.string()))
            none = pa.nulls(len(kept), pa.string())
            langs = pa.array([x.decode() for x in self.langs]).take(pa.array(path[0]))
            columns = [langs, *texts, *[none] * (ORDER - k), pa.array(sums[kept]), pa.array(edge[kept] | (k == 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", *_WORDS, "f", "edge"])


def _read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Chunks of texts as (languages of words, words, piece of each word)."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        data, offsets = arrays.text_bytes(batch.column(1))
        for lo, hi in arrays.chunks(offsets):
            own = offsets[lo : hi + 1] - offsets[lo]
            chunk = _LOWER[data[offsets[lo] : offsets[hi]]]
            kind = _KIND[chunk]
            inside = kind == 0
            before, after = np.zeros(len(chunk), bool), np.zeros(len(chunk), bool)
            before[1:], after[:-1] = inside[:-1], inside[1:]
            edges = own[(own > 0) & (own < len(chunk))]
            before[edges] = False
            after[edges - 1] = False
            begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
            if not len(begins):
                continue
            text = np.searchsorted(own, begins, side="right") - 1
            pieces = np.cumsum(kind == 2, dtype=np.int64)[begins] + text
            words = _binary(np.concatenate([[0], np.cumsum(ends - begins)]), chunk[inside])
            yield langs[lo:hi], text, words, pieces


def _gathered(held: list[tuple]) -> _Grams:
    """The combined n-grams of some chunks."""
    langs = sorted({lang.encode() for texts, *_ in held for lang in texts})
    number = {lang: i for i, lang in enumerate(langs)}
    lang = np.concatenate([np.array([number[x.encode()] for x in texts], np.uint32)[text] for texts, text, _, _ in held])
    base, pieces = 0, []
    for _, _, _, piece in held:
        pieces.append(piece + base)
        base += int(piece[-1]) + 1
    pieces = np.concatenate(pieces)
    words, numbers = _ranked(pa.concat_arrays([w for _, _, w, _ in held]))
    n = len(numbers)
    grams = np.zeros((1 + ORDER, n), np.uint32)
    grams[0], grams[1] = lang, numbers
    for k in range(1, ORDER):
        if n > k:
            grams[1 + k, : n - k] = np.where(pieces[k:] == pieces[:-k], numbers[k:], 0)
    return _Grams.of(langs, words, grams, np.ones(n, np.int64))


def _streams(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[_Grams]:
    held, size = [], 0
    for chunk in _read_texts(batches):
        held.append(chunk)
        size += len(chunk[1])
        if size >= flush:
            yield _gathered(held)
            held, size = [], 0
    if held:
        yield _gathered(held)


def _block_batch(row: tuple) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=["range", "langs", "words", "grams"])


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _range_bounds(texts: DataFrame, size: int, ranges: int) -> list[tuple]:
    """Bounds of ``ranges`` ranges of n-grams, from a sample of the texts; fewer where n-grams repeat."""

    def some(batches):
        for chunk in _read_texts(batches):
            grams = _gathered([chunk])
            step = max(64, math.ceil(len(chunk[1]) / SAMPLE_ROWS))
            keys = [grams.key(i) for i in np.searchsorted(np.cumsum(grams.counts), np.arange(0, len(chunk[1]), step), side="right")]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.binary()) for i in range(1 + ORDER)], names=["lang", *_WORDS])

    schema = ", ".join(f"{c} binary" for c in ["lang", *_WORDS])
    sample = texts.sample(min(1.0, SAMPLE_BYTES / max(size, 1)), seed=7).mapInArrow(some, schema).collect()
    keys = sorted(tuple(map(bytes, row)) for row in sample)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def counted_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
    range_bytes: int = RANGE_BYTES, flush: int = FLUSH, fanout: int = FANOUT,
) -> DataFrame:
    """``lang``, ``w1`` to ``w4``, ``f``: every phrase of up to four words counted ``least`` times, and per language all words.

    The row without words holds the number of word occurrences of its language.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).filter("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    ranges = max(1, math.ceil(size / range_bytes))
    bounds = _range_bounds(texts, size, ranges) if ranges > 1 else []
    # ranges of ranges: a block is cut into at most ``fanout`` parts at a time, so rows grow as the text does
    widths = [1]
    while widths[-1] * fanout <= len(bounds):
        widths.append(widths[-1] * fanout)
    widths.reverse()

    def cut_texts(batches):
        width = widths[0]
        for grams in _streams(batches, flush):
            for row in grams.blocks(bounds[width - 1 :: width], lambda i: i * width):
                yield _block_batch(row)

    def recut(width: int, outer: int):
        def finer(batches):
            held, size, at = [], 0, None

            def out():
                own = bounds[at + width - 1 : at + outer - 1 : width]
                for row in _Grams.merged(held).blocks(own, lambda i: at + i * width):
                    yield _block_batch(row)

            for number, *packed in _block_rows(batches):
                if held and (number != at or size >= flush):
                    yield from out()
                    held, size = [], 0
                at = number
                held.append(_Grams.read(*packed))
                size += len(held[-1])
            if held:
                yield from out()

        return finer

    def summed(batches):
        held, at = [], None
        for number, *packed in _block_rows(batches):
            if held and number != at:
                yield from _Grams.merged(held).counted(least)
                held = []
            at = number
            held.append(_Grams.read(*packed))
        if held:
            yield from _Grams.merged(held).counted(least)

    blocks = texts.mapInArrow(cut_texts, _BLOCK)
    for outer, width in zip(widths, widths[1:]):
        parts = math.ceil((len(bounds) + 1) / outer)
        blocks = blocks.repartition(parts, "range").sortWithinPartitions("range").mapInArrow(recut(width, outer), _BLOCK)
    blocks = blocks.repartition(len(bounds) + 1, "range").sortWithinPartitions("range")
    schema = ", ".join(f"{c} string" for c in ["lang", *_WORDS]) + ", f bigint, edge boolean"
    counts = stage(blocks.mapInArrow(summed, schema), "phrase-counts")
    # at most ten phrases of a range reach over its edge
    over = counts.filter("edge").groupBy("lang", *_WORDS).agg(F.sum("f").alias("f")).filter((F.col("f") >= least) | F.col("w1").isNull())
    return counts.filter("NOT edge").drop("edge").unionByName(over)


def _read_in_order(phrases: DataFrame, backwards: bool, value: str) -> DataFrame:
    """Phrases with ``parts`` and ``best``, read in prefix order, or ``backwards`` in suffix order.

    ``parts``: counts of the phrases of 1, 2, ... words that this one begins
    (backwards: ends) with.  ``best``: the largest ``value`` of the longer
    phrases that begin (end) with this one, 0 if none.  Every such part of a
    phrase is among ``phrases`` too.
    """
    names = [c for c in phrases.columns if c != "best"]
    at = {c: i for i, c in enumerate(names)}

    def key(row: tuple) -> tuple[str, ...]:
        words = [row[at[w]] for w in _WORDS if row[at[w]] is not None]
        words = words[::-1] if backwards else words
        return (row[at["lang"]], *words, *[""] * (ORDER - len(words)))

    total = phrases.count()
    ranges = max(1, min(MOST_RANGES, math.ceil(total / PHRASES)))
    bounds: list[tuple] = []
    if ranges > 1:
        sample = phrases.select(*names).sample(min(1.0, 20 * ranges / total), seed=7).collect()
        keys = sorted(key(tuple(r)) for r in sample)
        bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    # the parts of a range's first phrase may lie before it: they are read there as context
    context: dict[tuple, list[int]] = {}
    for i, bound in enumerate(bounds, 1):
        for k in range(1, ORDER):
            if bound[k + 1]:
                context.setdefault((*bound[: k + 1], *[""] * (ORDER - k)), []).append(i)

    fields = {f.name: f for f in phrases.schema.fields}
    own = ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in names)
    keys = [f"k{i}" for i in range(ORDER + 1)]
    arrow = {"string": pa.string(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "boolean": pa.bool_(), "int": pa.int32()}
    kinds = [arrow[fields[c].dataType.simpleString()] for c in names]

    def batch(rows: list[tuple], more: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
        every = list(zip(names, kinds)) + more
        columns = list(zip(*rows)) if rows else [()] * len(every)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, every)], names=[n for n, _ in every])

    routed_columns = [("range", pa.int32()), *[(k, pa.string()) for k in keys], ("edge", pa.bool_())]

    def routed(batches):
        for part in batches:
            rows = []
            for row in zip(*[part.column(c).to_pylist() for c in names]):
                k = key(row)
                edge = k in context
                for number in {bisect.bisect_right(bounds, k), *context.get(k, ())}:
                    rows.append((*row, number, *k, edge))
            yield batch(rows, routed_columns)

    def read(batches):
        path: list[list] = []  # [key words, row, edge, best so far], each a part of the next
        out: list[tuple] = []
        last = None

        def close(entry):
            words, row, edge, best = entry
            parts = [e[1][at["f"]] for e in path]
            out.append((*row, edge, parts, best))
            if path:
                path[-1][3] = max(path[-1][3], best, row[at[value]])

        for part in batches:
            columns = [part.column(c).to_pylist() for c in (*names, "range", *keys, "edge")]
            for found in zip(*columns):
                row, number, k, edge = found[: len(names)], found[len(names)], found[len(names) + 1 : -1], found[-1]
                words = (k[0], *[w for w in k[1:] if w])
                if number != last:
                    while path:
                        close(path.pop())
                    last = number
                while path and path[-1][0] != words[: len(path[-1][0])]:
                    close(path.pop())
                path.append([words, row, edge, 0])
            yield batch(out, read_columns)
            out.clear()
        while path:
            close(path.pop())
        yield batch(out, read_columns)

    read_columns = [("edge", pa.bool_()), ("parts", pa.list_(pa.int64())), ("best", pa.int64())]
    rows = phrases.select(*names).mapInArrow(routed, own + ", range int, " + ", ".join(f"{k} string" for k in keys) + ", edge boolean")
    rows = rows.repartition(len(bounds) + 1, "range").sortWithinPartitions("range", *keys)
    done = stage(rows.mapInArrow(read, own + ", edge boolean, parts array<bigint>, best bigint"), "phrase-stream")
    # a phrase read in several ranges has the best of all of them
    rest = [c for c in done.columns if c not in ("lang", *_WORDS, "edge", "best")]
    over = done.filter("edge").groupBy("lang", *_WORDS).agg(*[F.first(c).alias(c) for c in rest], F.max("best").alias("best"))
    return done.filter("NOT edge").drop("edge").unionByName(over.select(*[c for c in done.columns if c != "edge"]))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
    range_bytes: int = RANGE_BYTES, flush: int = FLUSH, fanout: int = FANOUT,
) -> DataFrame:
    """The ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counted = counted_phrases(docs, text, lang, least, range_bytes, flush, fanout)
    words = counted.filter("w1 IS NULL").select("lang", F.col("f").alias("n"))
    phrases = counted.filter("w1 IS NOT NULL")
    left = _read_in_order(phrases, False, "f").withColumnsRenamed({"parts": "l", "best": "longer"})
    left = left.withColumn("most", F.greatest("f", "longer"))
    both = _read_in_order(left, True, "most").withColumn("longer", F.greatest("longer", "best"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    own = both.filter(F.col("w2").isNotNull() & (PART_OF[0] * wide("longer") < PART_OF[1] * wide("f")))
    # parts[i] ends the phrase with i + 1 words, so the cut after the first k of m words leaves the part at m - k - 1
    own = own.withColumn("cuts", F.zip_with("l", F.reverse("parts"), lambda left, right: F.struct(left.alias("l"), right.alias("r"))))
    # whole numbers beyond 64 bits, divided without a remainder
    best = F.expr(f"""array_min(transform(cuts, (c, k) -> struct(
        cast((cast({SCALE} AS decimal(9, 0)) * cast(f AS decimal(19, 0))) div (cast(c.l AS decimal(19, 0)) + cast(c.r AS decimal(19, 0))) AS bigint) AS score,
        k, c.l AS l, c.r AS r)))""")
    rows = own.select("lang", F.concat_ws(" ", *_WORDS).alias("phrase"), F.col("f").alias("a"), best.alias("cut"))
    rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within shares of a language, so that the last step sees a bounded number of rows
    shares = rows.withColumn("share", F.pmod(F.crc32(F.col("phrase").cast("binary")), F.lit(32)))
    firsts = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
