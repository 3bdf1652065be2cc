"""SimHash, substring and suffix dedup, embeddings, components."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import cases
from vigilpay.llm import exchange, simhash, substring, suffix, vectors
from vigilpay.llm.components import components


def plain_print(text):
    ws = cases.words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    classes = sorted(set(prints.values()) | set())
    low = cases.components(classes, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, p in prints.items():
        least[low[p]] = min(i, least.get(low[p], i))
    return {i: least[low[p]] for i, p in prints.items()}


def test_simhash_against_plain(spark):
    docs = cases.documents(spark)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).filter("doc_id IS NOT NULL").collect()}
    prints = {i: plain_print(t) for i, t, *_ in cases.odd_rows() if i is not None}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(prints)
    assert simhash.near_duplicates(docs).count() == len(cases.odd_rows())


@pytest.mark.parametrize("block", [4096, 20])
def test_links_join_exactly_the_near(spark, block, monkeypatch):
    # groups around centres, some larger than the block and than what is compared pair by pair
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(5)
    prints = set()
    for size in (1, 2, 3, 150):
        centre = r.getrandbits(64)
        for _ in range(size):
            p = centre
            for _ in range(r.randrange(4)):
                p ^= 1 << r.randrange(64)
            prints.add(p)
    prints |= {r.getrandbits(64) for _ in range(50)} | {0, 7, (1 << 64) - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "bits long"))
    low = {x["node"]: x["component"] for x in components(found).collect()}
    got = {p: low.get(s, s) for p, s in zip(prints, signed)}
    plain = cases.components(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    groups = lambda d: sorted(sorted(k for k in d if d[k] == v) for v in set(d.values()))
    assert groups(got) == groups(plain)


def test_one_document_of_each_group_stays(spark):
    docs = cases.documents(spark)
    kept = simhash.drop_near_duplicates(docs)
    prints = {i: plain_print(t) for i, t, *_ in cases.odd_rows() if i is not None}
    stays = {i for i, c in plain_components(prints).items() if i == c}
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted(stays)
    assert kept.columns == docs.columns


def test_components_of_a_long_chain(spark):
    n = 300
    chain = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1000, 1100).select(F.lit(999).cast("long").alias("a"), F.col("id").alias("b"))
    found = {r["node"]: r["component"] for r in components(chain.unionByName(star)).collect()}
    assert found == {**{i: 0 for i in range(n)}, **{i: 999 for i in range(999, 1100)}}


def plain_words_report(rows, window=13):
    low = {}
    for i, t, *_ in rows:
        ws = cases.words(t)
        for k in range(len(ws) - window + 1):
            if i is not None:
                key = tuple(ws[k : k + window])
                low[key] = min(i, low.get(key, i))
    out = []
    for i, t, *_ in rows:
        ws = cases.words(t)
        gone = {
            p for k in range(len(ws) - window + 1) if i is not None and low[tuple(ws[k : k + window])] < i
            for p in range(k, k + window)
        }
        kept = " ".join(w for p, w in enumerate(ws) if p not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("flush", [exchange.FLUSH, 300])
def test_substring_against_plain(spark, flush, monkeypatch):
    monkeypatch.setattr(exchange, "FLUSH", flush)  # small blocks: answers come from buckets
    rows = cases.odd_rows()
    assert cases.rows_of(substring.repeat_report(cases.documents(spark, rows))) == plain_words_report(rows)


def test_substring_at_every_alignment(spark):
    passage = cases.prose(1, 40).split()
    rows = [(100 - k, " ".join([f"lead{k}x{j}" for j in range(k)] + passage[: 13 + k] + [f"t{k}"] * 3), "en", "s", 1) for k in range(20)]
    assert cases.rows_of(substring.repeat_report(cases.documents(spark, rows))) == plain_words_report(rows)


def test_substring_text_is_cut(spark):
    docs = cases.documents(spark)
    cut = substring.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    report = {(r[0], r[3]) for r in plain_words_report(cases.odd_rows())}
    got = {(r["doc_id"], hashlib.sha256(" ".join(cases.words(r["text"])).encode()).hexdigest()) for r in cut.collect()}
    assert got == report


def plain_bytes_report(rows, length=50):
    low = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            if i is not None:
                low[b[k : k + length]] = min(i, low.get(b[k : k + length], i))
    out = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if i is not None and low[b[k : k + length]] < i:
                gone[k : k + length] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard, flush", [(suffix.SHARD, suffix.FLUSH), (700, 40)])
def test_suffix_against_plain(spark, shard, flush, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD", shard)  # several shards are merged in a bucket
    monkeypatch.setattr(suffix, "FLUSH", flush)
    rows = cases.odd_rows() + [(200 + k, "z" * k + cases.prose(9, 60)[k : 60 + 5 * k], "en", "s", 1) for k in range(30)]
    assert cases.rows_of(suffix.repeat_report(cases.documents(spark, rows))) == plain_bytes_report(rows)


def test_merged_transforms_give_repeated_intervals():
    r = random.Random(3)
    shards = []
    for _ in range(4):
        text = b"".join(bytes(r.choice(b"ab") for _ in range(r.randrange(40, 90))) * r.randrange(1, 4) + b"\xff" for _ in range(6))
        shards.append(np.frombuffer(text, np.uint8))
    place, block = suffix.repeated_intervals(shards, 50)
    whole = b"".join(s.tobytes() for s in shards)
    plain = {}
    for k in range(len(whole) - 49):
        if b"\xff" not in whole[k : k + 50]:
            plain.setdefault(whole[k : k + 50], []).append(k)
    plain = sorted(v for v in plain.values() if len(v) > 1)
    got = {}
    for p, b in zip(place.tolist(), block.tolist()):
        got.setdefault(b, []).append(p)
    assert sorted(sorted(v) for v in got.values()) == plain


def unit(r, n=16):
    v = np.array([r.gauss(0, 1) for _ in range(n)])
    return v / np.linalg.norm(v)


def vector_rows():
    r = random.Random(8)
    rows, i = [], 0
    for size in (1, 1, 2, 5, 40):
        centre = unit(r)
        for _ in range(size):
            rows.append((i, (centre + 0.05 * unit(r)).tolist()))
            i += 1
    rows += [(1000 + k, unit(r).tolist()) for k in range(60)]
    rows += [(2000 + k, rows[3][1]) for k in range(30)] + [(3000, [2 * x for x in rows[3][1]])]
    rows += [(4000, None), (4001, [0.0] * 16), (4002, [float("nan")] + [1.0] * 15), (4003, [None] + [1.0] * 15),
             (4004, [float("inf")] * 16), (4005, []), (4006, [-0.0] + rows[0][1][1:]), (4007, [0.0] + rows[0][1][1:])]
    return rows


@pytest.mark.parametrize("block", [2048, 7])
def test_vectors_against_plain(spark, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = vector_rows()
    got = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = sorted(good)
    u = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    degree = {i: int(n) for i, n in zip(ids, near.sum(axis=1))}
    low = cases.components(ids, lambda a, b: near[ids.index(a), ids.index(b)])
    assert len(got) == len(rows)
    for i, _ in rows:
        assert got[i]["n_links"] == degree.get(i, 0)
        assert got[i]["component_id"] == low.get(i, i)
        assert got[i]["kept"] == (low.get(i, i) == i)


def test_vector_recall_on_random_neighbours(spark):
    r = random.Random(1)
    rows = []
    for k in range(600):
        v = unit(r, 32)
        away = unit(r, 32)
        away -= away @ v * v
        away /= np.linalg.norm(away)
        c = r.uniform(0.951, 0.99)
        rows += [(2 * k, v.tolist()), (2 * k + 1, (c * v + np.sqrt(1 - c * c) * away).tolist())]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.filter("vec_id % 2 = 1 AND n_links > 0").count() >= 0.95 * 600


def test_empty_tables_and_clashing_names(spark):
    empty = cases.documents(spark, [])
    for operator in (simhash.near_duplicates, simhash.drop_near_duplicates, substring.repeat_report, substring.remove_repeats, suffix.repeat_report):
        assert operator(empty).collect() == []
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    docs, clash = cases.documents(spark), cases.clashing(cases.documents(spark))
    assert cases.rows_of(simhash.near_duplicates(clash)) == cases.rows_of(simhash.near_duplicates(docs))
    assert cases.rows_of(substring.repeat_report(clash)) == cases.rows_of(substring.repeat_report(docs))
    cut = substring.remove_repeats(clash)
    assert cut.columns == clash.columns
    assert cases.rows_of(cut.select(*docs.columns)) == cases.rows_of(substring.remove_repeats(docs))
    assert simhash.drop_near_duplicates(clash).columns == clash.columns
    named = docs.withColumnRenamed("doc_id", "key").withColumnRenamed("text", "body")
    cut = substring.remove_repeats(named, "body", "key")
    assert cut.columns == named.columns
    assert cases.rows_of(cut) == cases.rows_of(substring.remove_repeats(docs))


def test_a_settled_value_is_shared_for_a_repeated_id():
    # documents 1 and 5 share the value in one block; another row of 1, in another block, asks for it
    key, buckets = np.uint64(12), 4
    marked = lambda *m: np.array(m, bool)
    shipped = []
    for ids, marks in (([1, 5], marked(False, True)), ([1], marked(True))):
        part = (np.array(ids), np.full(len(ids), key), None, marks)
        for batch in exchange._ship([part], buckets, later=False):
            shipped += [r for r in batch.to_pylist() if not r["known"]]
    blocks = [(r["ids"], r["keys"], r["checks"], r["marks"]) for r in shipped]
    told = lambda some: [exchange.unpack_ids(ids).tolist() for _, ids, _ in exchange._answer(some, 0, buckets, later=False)]
    assert told(blocks) == [[1]]
    assert told(blocks[1:]) == []
