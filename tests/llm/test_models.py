"""SentencePiece, language identification, LM scoring."""

import math
import os
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import cases
from vigilpay.llm import language, lm, pieces

MODEL = os.environ.get("VIGILPAY_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
TEXTS = [
    "", "hello  world\nfoo x", " ", "  a", "   ", "a" * 70, "ﬁ é é Ａ\t x\r\n", "aaaaa aaa aaaaaaa", "日本語のテキスト、です。",
    "x      y" + " " * 43 + "z", "1234567 12.5", "\n\n\n   \n", " leading", "trail ", "def f(x):\n    return x\n\t\tpass",
    "internationalization unbelievable Straße naïve", "\U0001F600\U0001F600 ok", "".join(map(chr, range(1, 300))),
]


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(MODEL)


def test_ids_equal_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = TEXTS + [r[1] or "" for r in cases.odd_rows()]
    data, offsets = pieces.text_bytes(pa.array(texts))
    ids, begins = pieces.Encoder(model).encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == library.encode(texts)


def test_agreement_of_pairs_against_plain_merging(model):
    names = {i: t for i, t in enumerate(model.pieces)}
    usable = [int(i) for i in model.ids]
    r = np.random.default_rng(2)
    left, right = r.choice(usable, 4000), r.choice(usable, 4000)
    text = lambda i: names[i].decode().replace(" ", pieces.SPACE)
    rank = {text(i): int(model.ranks[i]) for i in usable if model.ranks[i] >= 0}
    got = pieces.Encoder(model).agree(left, right)
    for a, b, fits in zip(left, right, got):
        whole = text(a) + text(b)
        assert (pieces.merge_alone(list(whole), rank)[0] == [text(a), text(b)]) == fits


def test_unigram_viterbi_against_plain():
    vocabulary = {"▁": -4.0, "a": -3.0, "b": -3.5, "c": -5.0, "ab": -4.0, "bc": -4.2, "abc": -6.5, "▁a": -3.2, "▁ab": -7.9, "ca": -4.4}
    names = list(vocabulary)
    byte_ids = np.arange(len(names), len(names) + 256, dtype=np.int32)
    decoded = [n.replace("▁", " ").encode() for n in names] + [bytes([i]) for i in range(256)]
    scores = np.array([vocabulary[n] for n in names] + [0.0] * 256)
    unigram = pieces.build_model({n: i for i, n in enumerate(names)}, scores, decoded, byte_ids, "unigram")
    r = np.random.default_rng(0)
    texts = ["".join(r.choice(list("abc"), r.integers(1, 12))) for _ in range(200)]
    data, offsets = pieces.text_bytes(pa.array(texts))
    ids, begins = pieces.Encoder(unigram).encode(data, offsets)

    def best(word):
        top = [0.0] + [-math.inf] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(e):
                if word[s:e] in vocabulary:
                    top[e] = max(top[e], top[s] + vocabulary[word[s:e]])
        return top[-1]

    for text, a, b in zip(texts, begins, begins[1:]):
        found = [names[i] for i in ids[a:b]]
        assert "".join(found) == "▁" + text
        assert sum(vocabulary[n] for n in found) == pytest.approx(best("▁" + text))


def test_round_trip(spark, model):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS + ["a▁b", None])] + cases.odd_rows()
    docs = cases.clashing(cases.documents(spark, rows))
    coded = pieces.encode(docs, model, check="fine")
    back = pieces.decode(coded, model)
    for r in back.collect():
        assert r["fine"] and r["decoded"] == r["text"]
        assert (r["ids"] is None) == (r["text"] is None)
    assert pieces.encode(cases.documents(spark, []), model).collect() == []


def test_forgetting_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    monkeypatch.setattr(pieces, "FRESH", 10)
    data, offsets = pieces.text_bytes(pa.array([r[1] for r in cases.odd_rows()]))
    whole, begins = pieces.Encoder(model).encode(data, offsets)
    encoder, parts = pieces.Encoder(model), []
    for lo, hi in pieces.chunks(offsets, 500):
        parts.append(encoder.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])[0])
    assert np.concatenate(parts).tolist() == whole.tolist()


LANGUAGES = {"xx": ["ba", "do", "ki"], "yy": ["ñu", "lé", "so"], "zz": ["tz", "sch", "ei"]}


def labelled(n):
    import random

    rows = []
    for i in range(n):
        name = sorted(LANGUAGES)[i % 3]
        r = random.Random(i)
        text = " ".join("".join(r.choice(LANGUAGES[name]) for _ in range(r.randrange(1, 5))) for _ in range(12))
        rows.append((i, text, name, "s", 1))
    return rows


def test_language_held_out_accuracy(spark):
    rows = labelled(240) + [(900, None, "xx", "s", 1), (901, "123 !!", "yy", "s", 1), (902, "", None, "s", 1), (None, "ba do", "xx", "s", 1)]
    docs = cases.clashing(cases.documents(spark, rows))
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    out = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert len(out) > 30
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)
    odd = {r["doc_id"]: r for r in got}
    assert odd[900]["lang_pred"] == odd[901]["lang_pred"] == odd[902]["lang_pred"] == "und" and odd[901]["score"] == 0
    assert odd[None]["lang_pred"] == "xx" and not odd[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_learns_only_from_its_side(spark):
    # the held-out side alone has another language
    import zlib

    rows = [(i, t, "ww" if zlib.crc32(str(i).encode()) % 4 == 2 else n, s, c) for i, t, n, s, c in labelled(120)]
    assert {r["lang_pred"] for r in language.identify(cases.documents(spark, rows)).collect()} <= set(LANGUAGES)


def plain_language(rows, least):
    """Words first, then n-grams of 5 to 1, by counting in plain dictionaries; (best language, its share) per text."""
    import zlib

    def words(text):
        out, word = [], ""
        for c in (text or "").lower() + " ":
            if unicodedata.category(c).startswith("L"):
                word += c
            elif word:
                out.append(word)
                word = ""
        return out

    def cut(word, n):
        edged = f" {word} "
        return list(word) if n == 1 else [edged[i : i + n] for i in range(len(edged) - n + 1)]

    learned = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    names = sorted({r[2] for r in learned})
    tables = []
    for n in range(6):
        counts = {}
        for _, text, name, *_ in learned:
            for w in words(text):
                for item in [w] if n == 0 else cut(w, n):
                    counts.setdefault(item, Counter())[name] += 1
        counts = {i: c for i, c in counts.items() if sum(c.values()) >= least}
        totals = {name: sum(c[name] for c in counts.values()) for name in names}
        tables.append({i: [math.log((c[x] + 0.5) / (totals[x] + 0.5 * (len(counts) + 1))) for x in names] for i, c in counts.items()})
    out = []
    for _, text, *_ in rows:
        sums, seen = [0.0] * len(names), words(text)
        for w in seen:
            known = [tables[0][w]] if w in tables[0] else []
            for n in range(5, 0, -1):
                known = known or [tables[n][g] for g in cut(w, n) if g in tables[n]]
            for k in range(len(names)):
                sums[k] += sum(v[k] for v in known) / len(known) if known else 0.0
        best = max(range(len(names)), key=lambda k: (sums[k], -k))
        out.append((names[best], 1 / sum(math.exp(x - sums[best]) for x in sums)) if seen else ("und", 0.0))
    return out


def test_language_equals_plain_model(spark):
    odd = ["½", "² ①", "Ⅷ ⅻ 12", "é ½ ba", "a\u0301b do", "İstanbul ßa", "日本 ba", None, "", "x" * 5000, " ".join(["do ki"] * 3000)]
    rows = labelled(90) + [(1000 + i, t, None, "s", 1) for i, t in enumerate(odd)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(cases.documents(spark, rows)).collect()}
    for r, (name, score) in zip(rows, plain_language(rows, language.LEAST)):
        assert got[r[0]][0] == name and got[r[0]][1] == pytest.approx(score, abs=1e-9), r
    assert [got[1000 + i][0] for i in range(3)] == ["und"] * 3


def test_language_backoff():
    model = language.LanguageModel(["a", "b"], [
        ({"known": 0}, np.array([[-1.0, -2.0]])), ({"q": 0}, np.array([[-3.0, -1.0]])),
        ({"un": 0, "ns": 1}, np.array([[-1.0, -5.0], [-3.0, -5.0]])), ({}, np.zeros((0, 2))), ({}, np.zeros((0, 2))), ({}, np.zeros((0, 2))),
    ])
    assert model.word("known").tolist() == [-1.0, -2.0]
    assert model.word("unseen").tolist() == [-2.0, -5.0]  # the bigrams it knows, no single characters
    assert model.word("qqz").tolist() == [-3.0, -1.0]
    assert model.word("zzz").tolist() == [0.0, 0.0]


def test_long_text_in_stretches(monkeypatch):
    monkeypatch.setattr(language, "_STRETCH", 7)
    text = "abc défg 12 hijklmnop, qr"
    assert [w for part in language.letters(text) for w in part] == ["abc", "défg", "hijklmnop", "qr"]


def test_language_empty(spark):
    assert language.identify(cases.documents(spark, [])).collect() == []
    assert [r["lang_pred"] for r in language.identify(cases.documents(spark, [(1, "text", None, None, 1)])).collect()] == ["und"]


def test_lm_prefers_the_target(spark):
    rows = labelled(90)
    docs = cases.documents(spark, rows)
    labels = spark.createDataFrame([(r[0], int(r[2] == "xx")) for r in rows if r[0] < 60], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in lm.cross_entropy_difference(docs, labels, "quality = 1").collect()}
    own = [scores[r[0]] for r in rows if r[0] >= 60 and r[2] == "xx"]
    other = [scores[r[0]] for r in rows if r[0] >= 60 and r[2] != "xx"]
    assert max(own) < min(other)


def test_lm_uses_every_word_bigram_and_target_document(spark):
    # tens of thousands of words and labelled documents, a million bigrams
    import random

    r = random.Random(8)
    rows = [(1000 + i, " ".join(f"w{r.randrange(45000)}" for _ in range(26)), "en", "s", 1) for i in range(22000)]
    rows += [r for r in cases.odd_rows() if r[0] is not None]
    target = {r[0] for r in rows if r[0] >= 1000 and r[0] % 50} | {1, 2, 3, 40}
    labels = spark.createDataFrame([(i, 1) for i in target] + [(None, 1), (1, 1), (5, 0)], "doc_id long, quality int")
    docs = cases.clashing(cases.documents(spark, rows + [(None, "w1 w2", "en", "s", 1)]))
    assert len(target) > 20_000
    texts = [(r[0], (r[1] or "").lower().split()) for r in rows] + [(None, ["w1", "w2"])]
    models = []
    for some in ([x for x in texts if x[0] in target], texts):
        pairs = Counter(p for _, ws in some for p in zip(["<s>", *ws], ws))
        ones, after = Counter(w for _, ws in some for w in ws), Counter()
        for (a, _), n in pairs.items():
            after[a] += n
        models.append((pairs, ones, after, sum(ones.values()) + len({w for _, ws in texts for w in ws}) + 1))

    def loss(ws, pairs, ones, after, size):
        probability = lambda a, b: (pairs[a, b] + lm.PRIOR * (ones[b] + 1) / size) / (after[a] + lm.PRIOR)
        return -sum(math.log(probability(a, b)) for a, b in zip(["<s>", *ws], ws)) / len(ws)

    expected = {i: (len(ws), *[loss(ws, *m) if ws else None for m in models]) for i, ws in texts}
    assert len(models[1][1]) > 1 << 15 and len(models[1][0]) > 1 << 19
    got = lm.cross_entropy_difference(docs, labels, "quality = 1").collect()
    assert len(got) == len(rows) + 1
    for r in got:
        n, t, b = expected[r["doc_id"]]
        assert r["n_tokens"] == n
        if n:
            assert r["target_loss"] == pytest.approx(t, rel=1e-9) and r["background_loss"] == pytest.approx(b, rel=1e-9)
            assert r["score"] == pytest.approx(t - b, abs=1e-9)
        else:
            assert r["target_loss"] is None and r["score"] is None


def test_lm_blocks_change_nothing(spark, monkeypatch):
    from pyspark.sql import functions as F

    docs = cases.documents(spark).filter("doc_id IS NOT NULL").coalesce(1)
    labels = docs.select("doc_id", F.expr("1").alias("quality")).filter("doc_id % 3 = 0")
    whole = cases.rows_of(lm.cross_entropy_difference(docs, labels, "quality = 1"))
    monkeypatch.setattr(lm, "BLOCK", 50)
    parts = cases.rows_of(lm.cross_entropy_difference(docs, labels, "quality = 1"))
    assert [r[:2] for r in parts] == [r[:2] for r in whole]
    assert all(a[4] == pytest.approx(b[4]) for a, b in zip(parts, whole) if a[4] is not None)
    empty = cases.documents(spark, [])
    assert lm.cross_entropy_difference(empty, labels, "quality = 1").collect() == []
    assert lm.cross_entropy_difference(docs, labels, "quality = 0").count() == docs.count()
