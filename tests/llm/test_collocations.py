"""Collocations against plain counts; settings that only move work change nothing."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from vigilpay.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            words[lang] += len(ws)
            for i in range(len(ws)):
                for k in range(1, 5):
                    if i + k <= len(ws):
                        counts[lang][tuple(ws[i : i + k])] += 1
    return counts, words


def plain(rows, least, top):
    counts, words = plain_counts(rows)
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {
            q[i : i + k] for q, a in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
            if 100 * a >= 80 * candidates[q[i : i + k]]
        }
        found = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return sorted(out)


def table(spark):
    """A pair on a third of all words, control characters in words, ties, several languages."""
    docs = [(i, cases.prose(500 + i, 40, 9), ["en", "de", None, ""][i % 4], "s", 1) for i in range(40)]
    docs += [(100 + i, "Of The " * 60 + f"of the x{i % 7}; of the\x01z ÀB\x1fc", "en", "s", 1) for i in range(20)]
    docs += [(200 + i, "new\tyork city, new york\x0bstate new york city", "en", "s", 1) for i in range(12)]
    return cases.odd_rows() + docs


SETTINGS = [{}, {"range_bytes": 1500, "flush": 300, "fanout": 3}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_collocations_equal_plain_ones(spark, monkeypatch, settings):
    if settings:
        monkeypatch.setattr(collocations, "PHRASES", 40)
        monkeypatch.setattr(collocations, "SAMPLE_ROWS", 64)
    rows = table(spark)
    docs = cases.clashing(cases.documents(spark, rows)).withColumn("f", F.lit(1)).withColumn("range", F.lit(1)).repartition(5)
    for least, top in ((6, 2000), (12, 5)):
        got = collocations.collocations(docs, least=least, top=top, **settings)
        assert sorted(map(tuple, got.collect())) == plain([(lang, text) for _, text, lang, *_ in rows], least, top)


@pytest.mark.parametrize("settings", SETTINGS)
def test_counts_of_all_orders(spark, settings):
    rows = table(spark)
    counts, words = plain_counts([(lang, text) for _, text, lang, *_ in rows])
    got = collocations.counted_phrases(cases.documents(spark, rows), least=3, **settings).collect()
    expected = {(lang, *p, *[None] * (4 - len(p)), n) for lang, f in counts.items() for p, n in f.items() if n >= 3}
    expected |= {(lang, None, None, None, None, n) for lang, n in words.items() if n}
    assert len(got) == len(expected) and set(map(tuple, got)) == expected


def test_nothing_to_find(spark):
    for rows in ([], [(1, None, "en", "s", 1), (2, " .;", None, "s", 1)], [(3, "one two three", "en", "s", 1)]):
        assert collocations.collocations(cases.documents(spark, rows)).count() == 0
