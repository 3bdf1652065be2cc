"""Language identification, words first with backoff to character n-grams.

A word of the model counts with its log frequency in each language.  For an
unseen word the longest n-grams of which the model knows any decide, from five
characters (word ends included) down to one, with their mean log frequency.  A
document gets the language with the largest sum over all its words; the score is
the posterior probability of that language under equal priors.

The model is fitted on a bounded sample of labelled documents: about
``per_language`` for each language, chosen by a hash of the id.  It holds every
word and n-gram that the sample has ``least`` times or more, whatever their
number; it is counted by Spark and broadcast, and the sample bounds its size.
Prediction reads whole texts.

Letters are those of Unicode category L; marks and numbers, also those written
with letter-like signs, end a word.

Defined results: a null text or one without letters is ``und`` with score 0, as
is everything if no language was learned; ties go to the first language in code
point order; repeated rows are predicted one by one; an empty table gives an
empty table; other columns are carried along, those named like a result are
replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vigilpay.llm.common import pass_through

PER_LANGUAGE = 4000
#: What the sample has less often than this is not learned.
LEAST = 3
LONGEST_GRAM = 5
SMOOTHING = 0.5
#: Characters of a text that are split into words at once.
_STRETCH = 1 << 20
#: Distinct words of which a worker remembers the scores.
REMEMBERED = 300_000
_WORD = regex.compile(r"\p{L}+")
UNKNOWN = "und"


def letters(text: str) -> Iterator[list[str]]:
    """Words (runs of letters, in lower case) of a text, some at a time."""
    at, n = 0, len(text)
    while at < n:
        end = min(at + _STRETCH, n)
        while end < n and text[end].isalpha() and text[end - 1].isalpha():
            end += 1
        yield _WORD.findall(text[at:end].lower())
        at = end


def grams(word: str, n: int) -> list[str]:
    edged = f" {word} "
    if n == 1:
        return list(word)
    return [edged[i : i + n] for i in range(len(edged) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies by language, as many rows as a bounded sample has items."""

    languages: list[str]
    tables: list[tuple[dict[str, int], np.ndarray]]  # 0: words; n: n-grams

    def word(self, word: str) -> np.ndarray:
        index, logs = self.tables[0]
        at = index.get(word)
        if at is not None:
            return logs[at]
        for n in range(LONGEST_GRAM, 0, -1):
            index, logs = self.tables[n]
            known = [index[g] for g in grams(word, n) if g in index]
            if known:
                return logs[known].mean(axis=0)
        return np.zeros(len(self.languages))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a document is kept from learning; one without an id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    per_language: int = PER_LANGUAGE, least: int = LEAST,
) -> LanguageModel:
    """Learn from rows with a language and a text."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull())
    rows = rows.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # languages are few; their counts choose the share of each that is read
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], [])
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, F.lit(min(1.0, per_language / sizes[name]))).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(draw < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = found.setdefault(name, Counter())
                for words in letters(value):
                    seen.update(words)
            table = [(n, w, c) for n, seen in found.items() for w, c in seen.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in table], pa.string()), pa.array([r[1] for r in table], pa.string()),
                 pa.array([r[2] for r in table], pa.int64())], names=["lang", "item", "n"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for name, word, c in zip(*(x.to_pylist() for x in batch.columns)):
                found[(name, 0, word)] += c
                for n in range(1, LONGEST_GRAM + 1):
                    for gram in grams(word, n):
                        found[(name, n, gram)] += c
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["lang", "length", "item", "n"],
            )

    words = sample.mapInArrow(count, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    items = words.mapInArrow(cut, "lang string, length int, item string, n long")
    per_item = items.groupBy("length", "item").pivot("lang", languages).agg(F.sum("n"))
    total = sum((F.coalesce(F.col(f"`{name}`"), F.lit(0)) for name in languages), F.lit(0))
    per_item = per_item.filter(total >= least).persist()
    try:
        tables = []
        for n in range(LONGEST_GRAM + 1):
            top = per_item.filter(F.col("length") == n).orderBy("item").collect()
            counts = np.array([[r[name] or 0 for name in languages] for r in top], float).reshape(-1, len(languages))
            logs = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * (len(top) + 1)))
            tables.append(({r["item"]: i for i, r in enumerate(top)}, logs))
    finally:
        per_item.unpersist()
    return LanguageModel(languages, tables)



def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    keep = pass_through(docs, ["lang_pred", "score"])
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    source = docs.select(*keep, F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, width = shared.value, len(shared.value.languages)
        place: dict[str, int] = {}
        vectors = np.zeros((0, width))
        for batch in batches:
            names, scores = [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                sums, n = np.zeros(width), 0
                for words in letters(value or "") if width else ():
                    n += len(words)
                    new = {w for w in words if w not in place}
                    if new:
                        if len(place) + len(new) > REMEMBERED:
                            place, vectors, new = {}, np.zeros((0, width)), set(words)
                        fresh = list(new)
                        if len(place) + len(fresh) > len(vectors):
                            room = np.zeros((max(4096, len(place) + 2 * len(fresh)), width))
                            vectors = np.concatenate([vectors, room])
                        for w in fresh:
                            vectors[len(place)] = model.word(w)
                            place[w] = len(place)
                    sums += vectors[[place[w] for w in words]].sum(axis=0)
                if not n:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    best = int(sums.argmax())
                    names.append(model.languages[best])
                    scores.append(float(1.0 / np.exp(sums - sums[best]).sum()))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"]
            )

    return source.mapInArrow(run, schema)


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """Learn from the documents that are not held out and predict all: id, ``held_out``, ``lang_pred``, ``score``."""
    model = fit(docs.filter(~held_out(doc_id)), text, lang, doc_id)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return predict(narrow, model).select("doc_id", "held_out", "lang_pred", "score")
