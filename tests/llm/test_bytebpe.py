"""Byte-level BPE: ids of the library, chunks that change nothing, exact round trips."""

import random

import numpy as np
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tests.llm import cases
from vigilpay.llm import bytebpe, queries


@pytest.fixture(scope="module")
def vocabulary():
    return bytebpe.load_vocabulary(queries.BYTE_VOCABULARY)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=bytebpe.PATTERN, mergeable_ranks=vocabulary.encoder.ranks, special_tokens={})


def mixed_texts(n, seed=1):
    r = random.Random(seed)
    for _ in range(n):
        text = "".join(r.choice("ab 'sxé日\n\t .,12\x1c　\U0001F600") for _ in range(r.randrange(200)))
        yield text + r.choice("x 9.é日") * r.randrange(0, 400)


def encoded(encoder, texts):
    raws = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raws)])
    return encoder.texts(np.frombuffer(b"".join(raws), np.uint8), offsets).to_pylist()


def test_pre_tokens_are_those_of_the_pattern(vocabulary):
    pattern = regex.compile(bytebpe.PATTERN)
    points = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}b " for c in [*range(0x3000), 0x2028, 0x1D7D8, 0x1F600, 0x10FFFF])
    r = random.Random(11)
    texts = [points, "", " ", "'", "'s", " 's", "x's'll've're'm'd't'Sa're", "'r'v'l're", "\n's\t'll  're", "a  ", "a \n b", "'re's'"]
    texts += ["".join(r.choice("a'srveltmd \n\t!1é") for _ in range(r.randrange(40))) for _ in range(3000)]
    for text in texts:
        assert vocabulary.encoder.boundaries(text).tolist() == np.cumsum([len(p) for p in pattern.findall(text)]).tolist(), text
    # many at once, and by the pattern itself for another one
    other = bytebpe.Encoder(bytebpe.Vocabulary(vocabulary.data, f"(?:{bytebpe.PATTERN})"))
    assert other.matches is not None
    assert encoded(other, texts) == encoded(vocabulary.encoder, texts)


def test_pieces_have_the_library_ids(vocabulary, library):
    encoder = vocabulary.encoder
    for text in [*mixed_texts(400), *(t for _, t, *_ in cases.odd_rows() if t), "x" * 20_000, " " * 3000 + "a", "<|endoftext|>"]:
        assert encoded(encoder, [text]) == [library.encode_ordinary(text)]
        raw = text.encode()[:300]
        if raw:
            ids, counts = encoder.merged(np.frombuffer(raw * 2, np.uint8), np.array([len(raw)] * 2))
            assert ids.tolist() == 2 * encoder.long_piece(raw) and counts.tolist() == [len(ids) // 2] * 2


def test_chunks_meet_at_the_same_boundaries(vocabulary):
    encoder, r = vocabulary.encoder, random.Random(5)
    for text in mixed_texts(600, seed=9):
        chunk, overlap = r.choice([8, 16, 33, 64]), r.choice([5, 8, 12, 40])
        scans = ((place, part, encoder.boundaries(part), last) for _, place, part, last in bytebpe.cut(text, chunk, overlap))
        pieces = []
        for part, ends in bytebpe.stitched(scans, encoder.boundaries):
            ends = ends.tolist()
            pieces += [part[a:b] for a, b in zip([0, *ends], ends)]
        assert pieces == regex.findall(bytebpe.PATTERN, text)


@pytest.mark.parametrize("chunk, overlap", [(1 << 16, 1 << 10), (40, 8)])
def test_tables_of_all_kinds(spark, vocabulary, library, chunk, overlap):
    rows = [*cases.odd_rows(), (70, "y" * 100_000, "en", "s", 1), (71, "don't  stop   " * 4000, "en", "s", 1)]
    if chunk == 40:
        rows = rows[:-2]
    docs = cases.clashing(cases.documents(spark, rows)).withColumn("decoded", F.lit("x")).withColumn("key", F.lit(3)).withColumn("k", F.lit(1))
    found = bytebpe.decode(bytebpe.encode(docs, vocabulary, chunk=chunk, overlap=overlap), vocabulary)
    got = found.select("doc_id", "text", "key", "score", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for row in got:
        text = row["text"] or ""
        assert row["ids"] == library.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode() and (row["key"], row["score"]) == (3, 7)
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(((i, t) for i, t, *_ in rows), key=repr)


def test_empty_table_and_null_ids(spark, vocabulary):
    docs = cases.documents(spark, [])
    assert bytebpe.decode(bytebpe.encode(docs, vocabulary), vocabulary).count() == 0
    rows = spark.createDataFrame([(1, None), (2, [])], "i int, ids array<int>")
    assert [bytes(r["decoded"]) for r in bytebpe.decode(rows, vocabulary).collect()] == [b"", b""]


def test_ids_outside_the_vocabulary_are_refused(spark, vocabulary):
    rows = spark.createDataFrame([(1, [10**6])], "i int, ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bytebpe.decode(rows, vocabulary).collect()
