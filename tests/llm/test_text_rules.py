"""Quality rules, sharding, mixing."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from vigilpay.llm import mixing, quality, ring


def plain_counts(text):
    t = text or ""
    ws = cases.words(t)
    lines = [x for x in t.split("\n") if cases.words(x)]
    starts = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    hit = {p for i in range(len(ws) - 4) if starts[tuple(ws[i : i + 5])] > 1 for p in range(i, i + 5)}
    return len(ws), sum(map(len, ws)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), len(hit)


def plain_kept(text):
    n, chars, symbols, dup, repeat = plain_counts(text)
    lines = len([x for x in (text or "").split("\n") if cases.words(x)])
    base = n < 10 or 100 * repeat > 20 * n
    return base, not (base or 100 * symbols > 20 * n or 100 * dup > 30 * lines or chars < 2 * n or chars > 15 * n)


def test_quality_counts_and_verdict(spark):
    docs = cases.documents(spark)
    got = cases.rows_of(quality.quality_report(docs).select("doc_id", *quality.COUNTS, "base_failed", "kept"))
    expected = sorted(((i, *plain_counts(t), *plain_kept(t)) for i, t, *_ in cases.odd_rows()), key=repr)
    assert got == expected


def test_quality_order_changes_nothing(spark):
    docs = cases.documents(spark)
    kept = sorted((r for r in cases.odd_rows() if plain_kept(r[1])[1]), key=repr)
    assert cases.rows_of(quality.quality_filter(docs)) == kept
    for order in (list(quality.RULES), list(reversed(quality.RULES))):
        judged = quality.cascade(docs, order)
        assert cases.rows_of(judged.filter("rejected_by IS NULL").select(*docs.columns)) == kept


def test_quality_orders_by_rejections_per_second(spark):
    docs = cases.documents(spark, [(i, "###" if i % 2 else cases.prose(i, 40), "en", "s", 1) for i in range(200)])
    ordered = [r.name for r in quality.order_rules(docs, fraction=1.0)]
    assert sorted(ordered) == sorted(r.name for r in quality.RULES)
    # half the rows fail this rule and none fails the other
    assert ordered.index("few_words") < ordered.index("long_words")


def test_quality_plan_has_no_python_and_no_shuffle(spark):
    plan = quality.quality_report(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_whole_and_even(spark, shards):
    docs = cases.documents(spark)
    rows = ring.shard_documents(docs, shards).collect()
    assert len(rows) == len(cases.odd_rows())
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {r["doc_id"]: r["size"] for r in rows}[50] == 1


def test_adding_a_shard_moves_few(spark):
    keys = spark.range(6000).withColumnRenamed("id", "doc_id")
    before = {r[0]: r[1] for r in ring.shard_rows(keys, "doc_id", 8).select("doc_id", "shard").collect()}
    after = {r[0]: r[1] for r in ring.shard_rows(keys, "doc_id", 9).select("doc_id", "shard").collect()}
    moved = sum(before[k] != after[k] for k in before)
    assert moved < 0.45 * len(before)  # a new modulus would move 8 of 9
    assert Counter(after.values())[8] in (666, 667)


def test_one_key_of_a_third_is_spread(spark):
    keys = spark.range(300).select(F.when(F.col("id") < 100, F.lit(5)).otherwise(F.col("id")).alias("doc_id"))
    rows = ring.shard_rows(keys, "doc_id", 4).collect()
    assert Counter(r["shard"] for r in rows) == {0: 75, 1: 75, 2: 75, 3: 75}
    assert len({(r["shard"], r["slot"]) for r in rows}) == 300


def plain_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            out.update(share)
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def test_mixing_meets_targets(spark):
    rows = cases.odd_rows() + [(1000 + i, cases.prose(i, 5 + i % 90), "en", f"t{i % 7}", 1) for i in range(700)]
    docs = cases.documents(spark, rows)
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(rows)
    sizes, source = Counter(), {}
    for i, t, _, s, _ in rows:
        sizes[s] += len(cases.words(t))
        source.setdefault(i, s)
    goal = plain_targets(sizes)
    taken, longest = Counter(), Counter()
    for r in got:
        if r["doc_id"] is None:
            continue
        s = source[r["doc_id"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(goal[s])
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s in goal:
        if s not in ("s1", None):  # rows without an id are of these
            assert abs(taken[s] - goal[s]) <= longest[s]
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_mixing_is_the_entropy_solution(spark):
    # one source below its size: rates are exp(lambda * size / mean), the same lambda for all
    histogram = spark.createDataFrame([("=a", 10, 500), ("=a", 100, 100), ("=a", 1000, 10)], "s string, size long, n long")
    goal = spark.createDataFrame([("=a", "a", 25000, 610, 12000.0)], "s string, source string, source_size long, docs long, target double")
    solved = mixing.multipliers(histogram, goal).first()
    import math

    mean = 25000 / 610
    rate = lambda size: min(2.0, math.exp(solved["lambda"] * size / mean))
    assert sum(n * size * rate(size) for size, n in ((10, 500), (100, 100), (1000, 10))) == pytest.approx(12000)


def test_mixing_repeats_documents(spark):
    docs = cases.documents(spark)
    copies = Counter()
    for r in mixing.mix_report(docs).collect():
        copies[r["doc_id"]] += r["copies"]
    mixed = Counter(r["doc_id"] for r in mixing.mix_documents(docs).collect())
    assert mixed == Counter({k: v for k, v in copies.items() if v})
    assert mixing.mix_documents(docs).columns == docs.columns


def test_empty_tables_and_clashing_names(spark):
    empty = cases.documents(spark, [])
    assert quality.quality_filter(empty).collect() == []
    assert ring.shard_documents(empty, 8).collect() == []
    assert mixing.mix_report(empty).collect() == []
    assert mixing.mix_documents(empty).collect() == []
    docs, clash = cases.documents(spark), cases.clashing(cases.documents(spark))
    assert set(clash.columns) >= set(quality.quality_filter(clash).columns)
    assert quality.quality_filter(clash).count() == quality.quality_filter(docs).count()
    assert cases.rows_of(ring.shard_documents(clash, 8)) == cases.rows_of(ring.shard_documents(docs, 8))
    assert cases.rows_of(mixing.mix_report(clash)) == cases.rows_of(mixing.mix_report(docs))
    assert mixing.mix_documents(clash).columns == clash.columns
