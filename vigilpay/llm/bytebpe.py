"""Byte-level BPE by ranks: overlapping chunks, stitched where pre-tokens meet again, and byte-exact decoding.

A text is cut into chunks that overlap.  Each chunk is pre-tokenised on its own, as
if its first character began a pre-token, which need not be so.  The pattern looks
ahead but never back, so once two scans share a boundary they agree from there on:
a chunk is joined to the one before at the first boundary of the overlap that both
have, and what the later chunk found before it is dropped.  Where no boundary is
shared (a pre-token longer than the overlap), the open end and the next chunk are
scanned as one.  Pieces are then encoded by the ranks alone.

Texts of one chunk, nearly all, take a single pass without a shuffle.  Longer ones
are spread chunk by chunk over the tasks, before and after stitching, and equal
long texts are encoded once.

Defined results: a null or empty text has no ids and decodes to no bytes; rows with
null or repeated ids are encoded like any other; a column named like a result is
replaced by it; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from vigilpay.llm.arrays import chunks, ragged, text_bytes
from vigilpay.llm.common import pass_through

# --- fixed value: the pre-token pattern of the vocabulary ---
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ------------------------------------------------------------

#: Characters of a chunk, and how far it reaches into the next one.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: A boundary this close to the end of a chunk may depend on what follows it.
MARGIN = 4
#: Bytes of text whose pieces are encoded together.
BATCH_BYTES = 3 << 20
#: Pieces of this many bytes and more are merged one by one, with a heap.
LONG_PIECE = 64
#: Rows of an output batch.
ROWS = 512


@dataclass(frozen=True)
class Vocabulary:
    """Byte strings and their ranks, as the lines of a rank file; what tasks receive."""

    data: bytes
    pattern: str = PATTERN

    @property
    def encoder(self) -> "Encoder":
        """Built once in a process, whatever the number of its tasks."""
        if self not in _ENCODERS:
            _ENCODERS[self] = Encoder(self)
        return _ENCODERS[self]


_ENCODERS: dict[Vocabulary, "Encoder"] = {}


def load_vocabulary(path: str, pattern: str = PATTERN) -> Vocabulary:
    """Read a rank file (base64 of the bytes, space, rank) on the driver."""
    with open(path, "rb") as f:
        data = f.read()
    vocabulary = Vocabulary(data, pattern)
    missing = [b for b in range(256) if bytes([b]) not in vocabulary.encoder.ranks]
    if missing:
        raise ValueError(f"the vocabulary has no rank for the bytes {missing[:5]}: some texts could not be encoded")
    return vocabulary


_NONE = np.int64(1) << 40
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """White space, letter, number or other, for every code point, as the pattern's classes have it; built once in a process."""
    if not _KINDS:
        kind = np.full(0x110000, _OTHER, np.uint8)
        classes = [(_SPACE, regex.compile(r"\s")), (_LETTER, regex.compile(r"\p{L}")), (_NUMBER, regex.compile(r"\p{N}"))]
        for block in range(0, 0x110000, 0x800):  # surrogates fill blocks of their own
            text = "" if 0xD800 <= block < 0xE000 else "".join(map(chr, range(block, block + 0x800)))
            for which, of in classes:
                kind[[ord(c) for c in of.findall(text)]] = which
        _KINDS.append(kind)
    return _KINDS[0]


def token_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of ``PATTERN`` begin, in texts of code points on end.

    The pattern cuts between runs of letters, of numbers, of white space and of
    the rest.  The last character of white space before something else is cut
    off, and if it is a blank it joins what follows.  An apostrophe that begins a
    pre-token takes one of seven endings with it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _kinds()[points]
    first = np.zeros(n + 1, bool)
    first[text_starts[text_starts < n]] = True
    new = first.copy()
    new[1:n] |= kind[1:] != kind[:-1]
    new[n] = True
    last = np.zeros(n, bool)  # of a text
    last[:-1] = first[1:n]
    last[-1] = True
    starts = new[:n].copy()
    space = kind == _SPACE
    # the end of white space that something follows in its text
    cut = space & new[1:] & ~last
    starts |= cut
    joined = np.flatnonzero(cut & (points == 0x20)) + 1
    starts[joined] = False
    marks = np.flatnonzero((points == 0x27) & starts & new[1:] & ~last)
    marks = marks[kind[marks + 1] == _LETTER]
    one = points[marks + 1]
    two = np.where(last[marks + 1], 0, points[np.minimum(marks + 2, n - 1)])
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    starts[marks[short | long] + 1] = False
    after = np.concatenate([marks[short] + 2, marks[long] + 3])
    starts[after[after < n]] = True
    return np.flatnonzero(starts)


class Encoder:
    """Pre-tokens of texts and the ids of pieces; a rank is the id of its bytes."""

    def __init__(self, vocabulary: Vocabulary):
        lines = (line.split() for line in vocabulary.data.splitlines() if line)
        self.ranks = ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.matches = None if vocabulary.pattern == PATTERN else regex.compile(vocabulary.pattern)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        # every way to make a token of two others
        pairs = {
            (ranks[token[:k]] << 32) | ranks[token[k:]]: rank
            for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
        }
        self._table(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64))

    def _table(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Put pairs into a table of open addresses, at most a quarter full."""
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.pair_keys, self.pair_ranks = np.full(1 << self.bits, -1), np.full(1 << self.bits, _NONE)
        at = self._places(keys)
        while len(keys):
            free = np.flatnonzero(self.pair_keys[at] == -1)
            _, one = np.unique(at[free], return_index=True)
            taken = free[one]
            self.pair_keys[at[taken]], self.pair_ranks[at[taken]] = keys[taken], ranks[taken]
            left = np.ones(len(keys), bool)
            left[taken] = False
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of joined tokens, ``_NONE`` where there is none."""
        keys = left << np.int64(32) | right
        at = self._places(keys)
        held = self.pair_keys[at]
        found = np.where(held == keys, self.pair_ranks[at], _NONE)
        rest = np.flatnonzero((held != keys) & (held != -1))
        while len(rest):
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            held = self.pair_keys[at[rest]]
            hit = held == keys[rest]
            found[rest[hit]] = self.pair_ranks[at[rest[hit]]]
            rest = rest[~hit & (held != -1)]
        return found

    def merged(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces whose bytes lie on end, and their number per piece.

        All pieces advance together: in each round every piece merges the pair of
        lowest rank, leftmost first, and leaves when it has none.
        """
        owner = np.repeat(np.arange(len(lengths)), lengths)
        ids = self.single[data]
        ranks = np.full(len(ids), _NONE)
        ranks[:-1] = self._pairs(ids[:-1], ids[1:])
        ranks[np.cumsum(lengths) - 1] = _NONE
        done_owner, done_ids = [], []
        while len(ids):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            least = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
            open_ = least != _NONE
            done_owner.append(owner[~open_])
            done_ids.append(ids[~open_])
            owner, ids, ranks, least = owner[open_], ids[open_], ranks[open_], least[open_]
            if not len(ids):
                break
            hits = np.flatnonzero(ranks == least)
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
            ids[hits] = ranks[hits]
            kept = np.ones(len(ids), bool)
            kept[hits + 1] = False
            owner, ids, ranks = owner[kept], ids[kept], ranks[kept]
            hits = hits - np.arange(len(hits))
            for left in (hits, hits[hits > 0] - 1):
                inner = left[left < len(ids) - 1]
                ranks[left] = _NONE
                ranks[inner] = np.where(owner[inner] == owner[inner + 1], self._pairs(ids[inner], ids[inner + 1]), _NONE)
        owner, ids = np.concatenate(done_owner), np.concatenate(done_ids)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(lengths))

    def long_piece(self, raw: bytes) -> list[int]:
        """The same for one piece of any length, with a heap."""
        ranks, n = self.ranks, len(raw)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def pair(i: int) -> tuple[int, int, int] | None:
            j = ends[i]
            rank = ranks.get(raw[i : ends[j]]) if j < n else None
            return None if rank is None else (rank, i, ends[j])

        heap = [p for p in map(pair, range(n - 1)) if p]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = ends[i]
            # the pair may be gone or may have grown since it was put here
            if not alive[i] or j >= n or ends[j] != end:
                continue
            alive[j] = False
            ends[i] = end
            if end < n:
                before[end] = i
            for changed in (before[i], i):
                if changed >= 0 and (found := pair(changed)):
                    heapq.heappush(heap, found)
        return [ranks[raw[i : ends[i]]] for i in range(n) if alive[i]]

    def encoded(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces on end, and their number per piece; equal pieces are worked out once."""
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        coded = pieces.dictionary_encode()
        raws = coded.dictionary.to_pylist()
        counts, whole, ids, rest = np.zeros(len(raws), np.int64), [], [], []
        for i, raw in enumerate(raws):
            rank = self.ranks.get(raw)
            if rank is None and len(raw) < LONG_PIECE:
                rest.append(i)
                continue
            found = [rank] if rank is not None else self.long_piece(raw)
            whole.append(i)
            counts[i] = len(found)
            ids += found
        known = np.array(ids, np.int64)
        if rest:
            data = np.frombuffer(b"".join([raws[i] for i in rest]), np.uint8)
            merged, counts[rest] = self.merged(data, np.array([len(raws[i]) for i in rest]))
            known = np.concatenate([known, merged])
        order = np.array(whole + rest, np.int64)
        starts = np.zeros(len(raws), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        at = coded.indices.to_numpy()
        return known[ragged(starts[at], counts[at])].astype(np.int32), counts[at]

    def boundaries(self, text: str) -> np.ndarray:
        """Where the pre-tokens of a text end, in characters."""
        if self.matches is not None:
            return np.cumsum([len(p) for p in self.matches.findall(text)], dtype=np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return np.append(token_starts(points, np.zeros(1, np.int64))[1:], len(points)).astype(np.int64) if len(points) else np.zeros(0, np.int64)

    def ids(self, pieces: list[str]) -> np.ndarray:
        return self.encoded(pa.array(pieces, pa.large_string()).cast(pa.large_binary()))[0]

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pre-tokens of texts on end begin, in bytes."""
        if self.matches is not None:
            raw = data.tobytes()
            texts = (raw[a:b].decode() for a, b in zip(offsets, offsets[1:]))
            sizes = [len(p.encode()) for t in texts for p in self.matches.findall(t)]
            return np.cumsum([0, *sizes])[:-1]
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        places = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a character
        return places[token_starts(points, np.searchsorted(places, offsets[:-1]))]

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
        """The ids of each text of UTF-8 bytes on end."""
        starts = self._cut(data, offsets)
        buffers = [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        ids, counts = self.encoded(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers))
        places = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)]
        return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids))


def cut(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[tuple[int, int, str, bool]]:
    """Number, place, text and whether it is the last, of the overlapping chunks of a text."""
    for k, start in enumerate(range(0, max(len(text), 1), chunk)):
        yield k, start, text[start : start + chunk + overlap], start + chunk >= len(text)


def stitched(scans: Iterator[tuple[int, str, np.ndarray, bool]], scan: Callable[[str], np.ndarray]) -> Iterator[tuple[str, np.ndarray]]:
    """Stretches of one text that begin and end at pre-token boundaries, with their boundaries.

    ``scans`` are the chunks in order: place, text, boundaries found in it, last or
    not.  Only the stretch that is still open is held.
    """
    place, text, ends, done = next(scans)
    for start, following, found, done in scans:
        edge = place + len(text)
        trusted = ends[ends <= len(text) - MARGIN]
        shared = np.intersect1d(trusted + place, np.concatenate([[0], found]) + start)
        if len(shared):
            meet = int(shared[0])
            yield text[: meet - place], trusted[trusted <= meet - place]
            place, text, ends = meet, following[meet - start :], found[found > meet - start] - (meet - start)
            continue
        # a pre-token reaches through the overlap: go on with its beginning and the next chunk as one
        closed = int(trusted[-1]) if len(trusted) else 0
        if closed:
            yield text[:closed], trusted
        place, text = place + closed, text[closed:] + following[max(edge - start, 0) :]
        ends = scan(text)
    if len(text):
        yield text, ends


def _with_ids(docs: DataFrame, vocabulary: Vocabulary, text: str, keep: list[str]) -> DataFrame:
    """Texts of a single chunk: pre-tokenised and encoded where they are."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder
        for batch in batches:
            column, kept = batch.column(text), [batch.column(c) for c in keep]
            data, offsets = text_bytes(column)
            for lo, hi in chunks(offsets, BATCH_BYTES):
                ids = encoder.texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in kept] + [ids], names=[*keep, "ids"])

    columns = list(dict.fromkeys([*keep, text]))
    return docs.select(*columns).mapInArrow(encoded, schema)


_CHUNKS = "key string, k int, place bigint, chunk string, last boolean"
_SCANS = _CHUNKS + ", ends binary"
_STRETCHES = "key string, k int, chunk string, ends binary"


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 64) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a bounded number of chunk rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _long_ids(texts: DataFrame, vocabulary: Vocabulary, chunk: int, overlap: int) -> DataFrame:
    """``key`` and ``ids`` of distinct long texts, by chunks."""

    def cut_up(batches):
        return _batches(((key, *c) for key, text in _rows(batches) for c in cut(text, chunk, overlap)), _arrow(_CHUNKS))

    def scanned(batches):
        scan = vocabulary.encoder.boundaries
        found = ((*row, scan(row[3]).astype(np.int64).tobytes()) for row in _rows(batches))
        return _batches(found, _arrow(_SCANS))

    def joined(batches):
        rows, scan = _rows(batches), vocabulary.encoder.boundaries

        def stretches():
            row = next(rows, None)
            while row is not None:
                key = row[0]

                def own():
                    nonlocal row
                    while row is not None and row[0] == key:
                        yield row[2], row[3], np.frombuffer(row[5], np.int64), row[4]
                        row = next(rows, None)

                for k, (text, ends) in enumerate(stitched(own(), scan)):
                    yield key, k, text, ends.astype(np.int64).tobytes()

        return _batches(stretches(), _arrow(_STRETCHES))

    def coded(batches):
        encoder = vocabulary.encoder
        for key, k, text, ends in _rows(batches):
            ends = np.frombuffer(ends, np.int64).tolist()
            ids = encoder.ids([text[a:b] for a, b in zip([0, *ends], ends)])
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([k], pa.int32()), lists], names=["key", "k", "ids"])

    pieces = texts.mapInArrow(cut_up, _CHUNKS).repartition("key", "k").mapInArrow(scanned, _SCANS)
    pieces = pieces.repartition("key").sortWithinPartitions("key", "k").mapInArrow(joined, _STRETCHES)
    pieces = pieces.repartition("key", "k").mapInArrow(coded, "key string, k int, ids array<int>")
    in_order = F.array_sort(F.collect_list(F.struct("k", "ids")))
    return pieces.groupBy("key").agg(F.flatten(F.transform(in_order, lambda x: x["ids"])).alias("ids"))


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with ``ids``, the ids of every whole text; ``keep`` names the columns to return, all by default.

    Cutting into chunks changes no id, whatever ``chunk`` and ``overlap`` are.
    """
    keep = pass_through(docs, ["ids"]) if keep is None else keep
    fits = F.coalesce(F.length(F.col(text)), F.lit(0)) <= chunk
    short = _with_ids(docs.filter(fits), vocabulary, text, keep)
    key = F.sha2(F.col(text).cast("binary"), 256)
    # the key is a struct of its own, so that no column of the table can clash with it
    rows = docs.filter(~fits).select(F.struct(*[F.col(c) for c in keep]).alias("row"), key.alias("key"), F.col(text).alias("whole"))
    distinct = rows.select("key", "whole").dropDuplicates(["key"])
    ids = _long_ids(distinct, vocabulary, chunk, overlap)
    return short.unionByName(rows.join(ids, "key").select("row.*", "ids"))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the raw bytes of the ids on end; a null list gives no bytes.

    An id that the vocabulary does not have is an error.
    """
    kept = pass_through(rows, ["decoded"])
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField("decoded", T.BinaryType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary.encoder.tokens
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                column = part.column(ids)
                values = column.flatten().to_pylist()
                if values and (min(values) < 0 or max(values) >= len(tokens)):
                    raise ValueError("an id is outside the vocabulary")
                ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).tolist()
                found = [tokens[i] for i in values]
                texts = pa.array([b"".join(found[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [texts], names=[*kept, "decoded"])

    return rows.select(*kept).mapInArrow(decoded, schema)
