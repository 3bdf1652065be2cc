"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text is cut wherever no piece spans two neighbouring characters; what lies
between two cuts is a unit.  Distinct units of equal length advance together: at
each place, hashes of all substrings that end there probe the sorted keys of the
pieces, and a vectorised maximum stores the backpointer.

Two kinds of models have different maxima.  A unigram model takes the best sum
of scores.  A byte-pair model merges the pair with the best score again and
again, which no sum of scores expresses.  But its result has one characteristic:
of all segmentations it is the only one in which every two neighbours, merged
alone, stay the two pieces they are.  So a path scores 0 if all its neighbours
agree and minus infinity otherwise, and the maximum is the model's own result.
Whether two pieces agree is worked out once from the merges they are made of.

Characters that no piece holds become their UTF-8 bytes.  Runs of spaces merge
last, from the left.  A literal U+2581, which the model uses for a space, is
encoded as bytes, so decoding always gives the text back.

Defined results: null gives null, an empty text no pieces; repeated rows are
encoded one by one; an empty table gives an empty table; other columns are
carried along.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from vigilpay.llm.arrays import CHUNK_BYTES, _powers, chunks, mix, ragged, text_bytes
from vigilpay.llm.common import pass_through

SPACE = "▁"
_R = np.uint64(0xD6E8FEB86659FD93)
_NEVER = np.int64(1) << 40
#: Distinct units that a worker remembers before it starts afresh.
REMEMBERED = 1_200_000
#: Units learned last, which are merged into the others when they are this many.
FRESH = 100_000
#: Bytes of text that are encoded at once.
AT_ONCE = CHUNK_BYTES
_PAIR_SLOTS = 1 << 20
#: Units of one length that advance together.
TOGETHER = 20_000


def merge_alone(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Byte-pair merging of a few symbols, best first and leftmost among equals; the last pair merged."""
    last = None
    while True:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            r = rank.get(symbols[i] + symbols[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            return symbols, last
        last = (symbols[at], symbols[at + 1])
        symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]


@dataclass
class PieceModel:
    """A vocabulary as arrays; built on the driver and broadcast (its size is that of the vocabulary)."""

    kind: str  # "bpe" or "unigram"
    pieces: list[bytes]  # what each id decodes to
    chars: np.ndarray  # code points in pieces, sorted; the class of a character is its place plus 1
    space: int  # id of the single space
    singles: np.ndarray  # id of each class
    byte_ids: np.ndarray
    pairs: np.ndarray  # classes that stand side by side in a piece, as c1 * (classes + 1) + c2
    keys: np.ndarray  # sorted hashes of pieces
    ids: np.ndarray  # their ids
    scores: np.ndarray  # by id
    ranks: np.ndarray  # by id: when the piece is merged; -1 for single characters
    lefts: np.ndarray  # by id: the pieces it is merged from
    rights: np.ndarray
    hashes: np.ndarray  # by id
    lengths: np.ndarray  # by id, in characters
    runs: dict[int, int] = field(default_factory=dict)  # spaces in a run piece -> id

    def longest(self) -> int:
        return int(self.lengths[self.ids].max())


def _hash(classes: list[int]) -> int:
    h = 0
    for c in classes:
        h = (h * int(_R) + c) & 0xFFFFFFFFFFFFFFFF
    return h


def load_model(path: str, kind: str = "bpe") -> PieceModel:
    """Read a SentencePiece model file on the driver."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    n = processor.vocab_size()
    names = [processor.id_to_piece(i) for i in range(n)]
    scores = np.array([processor.get_score(i) for i in range(n)])
    byte_ids, texts, decoded = np.full(256, -1, np.int32), {}, []
    for i, name in enumerate(names):
        if processor.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            decoded.append(bytes([int(name[3:5], 16)]))
        elif processor.is_control(i) or processor.is_unused(i):
            decoded.append(b"")
        elif processor.is_unknown(i):
            decoded.append(" ⁇ ".encode())
        else:
            texts[name] = i
            decoded.append(name.replace(SPACE, " ").encode())
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    return build_model(texts, scores, decoded, byte_ids, kind)


def build_model(texts: dict[str, int], scores: np.ndarray, decoded: list[bytes], byte_ids: np.ndarray, kind: str) -> PieceModel:
    runs = {len(t): i for t, i in texts.items() if len(t) > 1 and not t.strip(SPACE)}
    words = {t: i for t, i in texts.items() if i not in runs.values()}
    if any(SPACE in t[1:] for t in words):
        raise ValueError("pieces across words are not supported")
    chars = np.array(sorted({ord(c) for t in words for c in t}), np.int64)
    if any(chr(c) not in words for c in chars):
        raise ValueError("every character of a piece must be a piece")
    class_of = {chr(c): k + 1 for k, c in enumerate(chars)}
    n, across = len(decoded), len(chars) + 1
    singles = np.full(across, -1, np.int32)
    for c in chars:
        singles[class_of[chr(c)]] = words[chr(c)]
    hashes, lengths = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for t, i in words.items():
        hashes[i], lengths[i] = _hash([class_of[c] for c in t]), len(t)
    ranks, lefts, rights = np.full(n, -1, np.int64), np.full(n, -1, np.int32), np.full(n, -1, np.int32)
    usable = dict(words)
    if kind == "bpe":
        order = {t: r for r, t in enumerate(sorted((t for t in words if len(t) > 1), key=lambda t: -scores[words[t]]))}
        if len({scores[words[t]] for t in order}) < len(order):
            raise ValueError("a byte-pair model needs distinct scores")
        for t, r in order.items():
            whole, last = merge_alone(list(t), order)
            if len(whole) == 1:
                ranks[words[t]], lefts[words[t]], rights[words[t]] = r, words[last[0]], words[last[1]]
            else:
                del usable[t]  # merging never ends in this piece
    keys = np.array([hashes[i] for i in usable.values()], np.uint64)
    ids = np.array(list(usable.values()), np.int32)
    by_key = np.argsort(keys)
    pairs = {class_of[a] * across + class_of[b] for t in words for a, b in zip(t, t[1:])}
    return PieceModel(
        kind, decoded, chars, words[SPACE], singles, byte_ids, np.array(sorted(pairs), np.int64),
        keys[by_key], ids[by_key], scores, ranks, lefts, rights, hashes, lengths, runs,
    )


def _merged(one: tuple, two: tuple) -> tuple:
    keys = np.concatenate([one[0], two[0]])
    by_key = np.argsort(keys, kind="stable")
    return keys[by_key], *(np.concatenate([a, b])[by_key] for a, b in zip(one[1:], two[1:]))


class Encoder:
    """What a worker keeps of a model: lookup tables, units it has seen, pairs it has compared."""

    def __init__(self, model: PieceModel):
        self.m, self.across, self.longest = model, len(model.chars) + 1, model.longest()
        self.class_of = np.zeros(0x110000, np.int32)
        self.class_of[model.chars] = np.arange(1, self.across)
        self.class_of[0x20], self.class_of[0x2581] = self.class_of[0x2581], 0
        self.joined = np.zeros((self.across, self.across), bool)
        self.joined.flat[model.pairs] = True
        self.table = mix(np.arange(1, self.across + 1, dtype=np.uint64) * _R) | np.uint64(1)
        self.radix = np.multiply.accumulate(np.r_[np.ones(1, np.uint64), np.full(self.longest + 1, _R)])
        self.pair_tags = np.full(_PAIR_SLOTS, -1, np.int64)
        self.pair_fits = np.zeros(_PAIR_SLOTS, bool)
        self.run_cache: dict[int, list[int]] = {}
        self.forget()

    def forget(self) -> None:
        self.known = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in range(2)]
        self.pool = np.concatenate([self.m.singles, np.zeros(1 << 16, np.int32)])
        self.used = len(self.m.singles)

    def piece(self, hashes: np.ndarray) -> np.ndarray:
        """The id of the piece with each hash, or -1."""
        at = np.minimum(np.searchsorted(self.m.keys, hashes), len(self.m.keys) - 1)
        return np.where(self.m.keys[at] == hashes, self.m.ids[at], -1)

    # --- do two pieces agree? -------------------------------------------------------

    def _agree(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the characters of two pieces ends in just these two.

        Goes back in time from the two pieces: the one that was merged later falls
        apart, and the halves at the border are looked at.  They would have merged
        if their piece comes before the merges that took them elsewhere.
        """
        m = self.m
        a, b = left.astype(np.int64), right.astype(np.int64)
        up_a, up_b = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        fits, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            across = self.piece(m.hashes[x] * self._power(m.lengths[y]) + m.hashes[y])
            rank = np.where(across >= 0, m.ranks[across], _NEVER)
            wrong = (rank < up_a[live]) & (rank <= up_b[live]) & (across >= 0)
            fits[live[wrong]] = False
            done = wrong | ((m.ranks[x] < 0) & (m.ranks[y] < 0))
            live, x, y = live[~done], x[~done], y[~done]
            first = m.ranks[x] > m.ranks[y]
            p, q = live[first], live[~first]
            up_a[p], a[p] = m.ranks[x[first]], m.rights[x[first]]
            up_b[q], b[q] = m.ranks[y[~first]], m.lefts[y[~first]]
        return fits

    def _power(self, lengths: np.ndarray) -> np.ndarray:
        return self.radix[lengths]

    def agree(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_agree`` with a memory: one slot per hash of a pair, the latest pair stays."""
        pair = left.astype(np.int64) * len(self.m.pieces) + right
        slot = (mix(pair.astype(np.uint64)) & np.uint64(_PAIR_SLOTS - 1)).astype(np.int64)
        hit = self.pair_tags[slot] == pair
        fits = self.pair_fits[slot]
        miss = np.flatnonzero(~hit)
        if len(miss):
            new, inverse = np.unique(pair[miss], return_inverse=True)
            found = self._agree(new // len(self.m.pieces), new % len(self.m.pieces))
            fits[miss] = found[inverse]
            self.pair_tags[slot[miss]] = pair[miss]
            # two pairs of one slot: the tag that was written last decides
            kept = self.pair_tags[slot[miss]] == pair[miss]
            self.pair_fits[slot[miss[kept]]] = fits[miss[kept]]
        return fits

    # --- Viterbi over units of equal length -------------------------------------------

    def _advance(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of units (one row of classes each), on end, and their number per unit."""
        n, length = classes.shape
        m = self.m
        prefix = np.zeros((length + 1, n), np.uint64)
        for i in range(length):
            prefix[i + 1] = prefix[i] * _R + classes[:, i].astype(np.uint64)
        last = np.full((length + 1, n), -1, np.int32)  # backpointer: the piece that ends here
        best = np.zeros((length + 1, n))
        for end in range(1, length + 1):
            lens = np.arange(1, min(end, self.longest) + 1)
            begins = end - lens
            hashes = prefix[end][None, :] - prefix[begins] * self.radix[lens][:, None]
            ids = self.piece(hashes)
            row, column = np.nonzero(ids >= 0)
            piece, begin = ids[row, column], begins[row]
            score = np.full(ids.shape, -np.inf)
            if m.kind == "bpe":
                ok = begin == 0
                before = last[begin, column]
                inner = np.flatnonzero(~ok & (before >= 0))
                ok[inner] = self.agree(before[inner], piece[inner])
                score[row[ok], column[ok]] = 0.0
            else:
                score[row, column] = best[begin, column] + m.scores[piece]
            top = score.argmax(axis=0)
            best[end] = score[top, np.arange(n)]
            last[end] = np.where(best[end] > -np.inf, ids[top, np.arange(n)], -1)
        if (last[length] < 0).any():
            raise RuntimeError("a unit has no segmentation: the model's merges contradict its scores")
        place, counts, steps = np.full(n, length), np.zeros(n, np.int64), []
        while (place > 0).any():
            live = place > 0
            piece = np.where(live, last[place, np.arange(n)], -1)
            steps.append(piece)
            counts += live
            place = place - np.where(live, m.lengths[piece], 0)
        back = np.stack(steps, axis=1)[:, ::-1]  # the last piece comes first
        return back[back >= 0], counts

    def _learn(self, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, classes: np.ndarray) -> None:
        """Segment new distinct units and remember them."""
        found_at, found_n = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int32)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, cuts):
            length = int(lengths[group[0]])
            step = max(1, TOGETHER * 16 // max(16, length))
            for lo in range(0, len(group), step):
                part = group[lo : lo + step]
                tokens, counts = self._advance(classes[starts[part][:, None] + np.arange(length)])
                found_at[part], found_n[part] = self.used + np.cumsum(counts) - counts, counts
                end = self.used + len(tokens)
                if end > len(self.pool):
                    self.pool = np.concatenate([self.pool, np.zeros(max(end, len(self.pool) // 2), np.int32)])
                self.pool[self.used : end] = tokens
                self.used = end
        old, fresh = self.known
        fresh = _merged(fresh, (hashes, found_at, found_n))
        if len(fresh[0]) > FRESH:
            old, fresh = _merged(old, fresh), tuple(x[:0] for x in fresh)
        self.known = [old, fresh]

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which units are remembered, and their place in the pool and number of pieces."""
        seen, at, count = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        for keys, places, counts in self.known:
            if len(keys):
                k = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[k] == hashes
                at[hit], count[hit] = places[k[hit]], counts[k[hit]]
                seen |= hit
        return seen, at, count

    def _units(self, starts: np.ndarray, lengths: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of pieces of each unit."""
        at, count = classes[starts].astype(np.int64), np.ones(len(starts), np.int64)
        long = np.flatnonzero(lengths > 1)
        if len(long):
            up, down = _powers(len(classes) + 1)
            sums = np.zeros(len(classes) + 1, np.uint64)
            np.cumsum(self.table[classes] * up[: len(classes)], out=sums[1:])
            s, e = starts[long], starts[long] + lengths[long]
            hashes = mix((sums[e] - sums[s]) * down[s] + lengths[long].astype(np.uint64))
            unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            if sum(len(k[0]) for k in self.known) + len(unique) > REMEMBERED:
                self.forget()
            seen, place, number = self._find(unique)
            if not seen.all():
                new = ~seen
                self._learn(unique[new], s[first[new]], lengths[long][first[new]], classes)
                _, place[new], number[new] = self._find(unique[new])
            at[long], count[long] = place[inverse], number[inverse]
        return at, count

    def _run(self, n: int) -> list[int]:
        """Pieces of ``n`` spaces: equal scores, so the leftmost pair that is a piece merges first."""
        if n not in self.run_cache:
            sizes, i = [1] * n, 0
            while i < len(sizes) - 1:
                if sizes[i] + sizes[i + 1] in self.m.runs:
                    sizes[i : i + 2] = [sizes[i] + sizes[i + 1]]
                    i = max(0, i - 1)
                else:
                    i += 1
            self.run_cache[n] = [self.m.space if s == 1 else self.m.runs[s] for s in sizes]
        return self.run_cache[n]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and where each text begins (one more than texts)."""
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]  # characters before each text
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        full = np.flatnonzero(np.diff(first) > 0)
        # every text that is not empty begins with a space
        codes = np.insert(codes, first[full], 0x20)
        heads = first[full] + np.arange(len(full))
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        classes = self.class_of[codes]
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.joined[classes[:-1], classes[1:]]
        cut[heads] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.r_[starts, len(codes)])
        at, count = self._units(starts, lengths, classes)
        pool = self.pool[: self.used]
        strange = np.flatnonzero(classes[starts] == 0)  # a unit of its own each
        if len(strange):
            kinds, inverse = np.unique(codes[starts[strange]], return_inverse=True)
            raw = [self.m.byte_ids[np.frombuffer(chr(c).encode(), np.uint8)] for c in kinds]
            sizes = np.array([len(r) for r in raw])
            at[strange] = (len(pool) + np.cumsum(sizes) - sizes)[inverse]
            count[strange] = sizes[inverse]
            pool = np.concatenate([pool, *raw])
        ids = pool[ragged(at, count)]
        before = np.r_[0, np.cumsum(count)]
        begins = np.full(len(offsets), len(ids))
        begins[full] = before[np.searchsorted(starts, heads)]
        for i in np.flatnonzero(np.diff(offsets) == 0)[::-1]:
            begins[i] = begins[i + 1]
        return self._merge_spaces(ids, begins)

    def _merge_spaces(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.m.runs:
            return ids, begins
        is_space = ids == self.m.space
        joined = np.zeros(len(ids), bool)
        joined[1:] = is_space[1:] & is_space[:-1]
        joined[begins[begins < len(ids)]] = False
        if not joined.any():
            return ids, begins
        heads = np.flatnonzero(is_space & ~joined & np.r_[joined[1:], False])
        ends = heads + 1
        while True:  # the run goes on while the next piece is joined
            more = (ends < len(ids)) & joined[np.minimum(ends, len(ids) - 1)]
            if not more.any():
                break
            ends[more] += 1
        keep = np.ones(len(ids), bool)
        ids = ids.copy()
        for a, b in zip(heads, ends):
            merged = self._run(int(b - a))
            ids[a : a + len(merged)] = merged
            keep[a + len(merged) : b] = False
        return ids[keep], np.r_[0, np.cumsum(keep)][begins]

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts on end, and where each begins; the first space of a text goes."""
        if not hasattr(self, "_bytes"):
            self._bytes = np.frombuffer(b"".join(self.m.pieces), np.uint8)
            self._sizes = np.array([len(p) for p in self.m.pieces])
            self._from = np.cumsum(self._sizes) - self._sizes
        sizes, place = self._sizes[ids], self._from[ids]
        some = np.flatnonzero(np.diff(begins) > 0)
        lead = begins[:-1][some]
        spaced = (sizes[lead] > 0) & (self._bytes[np.minimum(place[lead], len(self._bytes) - 1)] == 0x20)
        sizes[lead[spaced]] -= 1
        place[lead[spaced]] += 1
        return self._bytes[ragged(place, sizes)], np.r_[0, np.cumsum(sizes)][begins]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker and model."""
    if shared.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.id] = Encoder(shared.value)
    return _ENCODERS[shared.id]


class _Shared:
    """A broadcast model with a name that workers know it by."""

    def __init__(self, spark, model: PieceModel):
        self._broadcast = spark.sparkContext.broadcast(model)
        self.id = uuid.uuid4().hex

    @property
    def value(self) -> PieceModel:
        return self._broadcast.value


def encode(docs: DataFrame, model: PieceModel, text: str = "text", ids: str = "ids", check: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of the text; ``check`` names a column that tells whether they decode to it."""
    results = [ids, check] if check else [ids]
    keep = pass_through(docs, results)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if check:
        fields.append(T.StructField(check, T.BooleanType()))
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    shared, at = _Shared(docs.sparkSession, model), keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            for lo, hi in chunks(offsets, AT_ONCE):
                own, starts = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                found, begins = encoder.encode(own, starts)
                part = batch.slice(lo, hi - lo)
                missing = part.column(at).is_null()
                columns = [*part.columns, pa.ListArray.from_arrays(
                    pa.array(begins, pa.int32()), pa.array(found, pa.int32()), mask=missing if missing.true_count else None
                )]
                if check:
                    back, places = encoder.decode(found.astype(np.int64), begins)
                    if np.array_equal(back, own) and np.array_equal(places, starts):
                        equal = np.ones(hi - lo, bool)
                    else:
                        equal = [back[a:b].tobytes() == own[c:d].tobytes() for a, b, c, d in zip(places, places[1:], starts, starts[1:])]
                    columns.append(pa.array(equal, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *results])

    return docs.select(*keep).mapInArrow(run, schema)


def decode(docs: DataFrame, model: PieceModel, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of the piece ids."""
    keep = pass_through(docs, [text])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text, T.StringType())])
    shared, at = _Shared(docs.sparkSession, model), keep.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            column = batch.column(at)
            begins = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)[begins[0] : begins[-1]].astype(np.int64) if len(column) else np.zeros(0, np.int64)
            data, places = encoder.decode(values, begins - begins[0] if len(begins) else np.zeros(1, np.int64))
            raw, valid = data.tobytes(), column.is_valid().to_pylist()
            texts = [raw[a:b].decode(errors="replace") if v else None for a, b, v in zip(places, places[1:], valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, text])

    return docs.select(*keep).mapInArrow(run, schema)
