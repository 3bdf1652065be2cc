"""The stages one after the other, against plain versions of their decisions."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_dedup import plain_components, plain_print, plain_words_report
from tests.llm.test_text_rules import plain_kept, plain_targets


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = cases.odd_rows() + [(500 + i, cases.prose(i, 20 + i % 60), "en", f"s{i % 4}", 1) for i in range(80)]
    # repeated ids: a copy of 503 under the id of another document, beside that document
    rows += [(507, cases.prose(3, 20 + 3), "en", "s3", 1)]
    cases.documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    return path, rows


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    path, _ = folder
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        to = f"{tmp_path_factory.mktemp('stage')}/{name}"
        function(spark, docs, path).write.parquet(to)
        docs = spark.read.parquet(to)
        out.append(docs)
    return out


def test_stages_follow_plain_decisions(folder, stages):
    _, rows = folder
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(s.columns == columns for s in stages[:-1])
    good = [r for r in rows if plain_kept(r[1])[1]]
    assert Counter(map(tuple, stages[0].collect())) == Counter(good)
    prints = [plain_print(r[1]) for r in good]
    low = plain_components(dict(enumerate(prints)))  # by place, as ids repeat and may be null
    least = {}
    for place, r in enumerate(good):
        ids = [x for x in (least.get(low[place]), r[0]) if x is not None]
        least[low[place]] = min(ids, default=None)
    single = {r for place, r in enumerate(good) if r[0] == least[low[place]]}
    kept = list(map(tuple, stages[1].collect()))
    assert len(kept) == len(set(kept)) and set(kept) == single
    cut = stages[2].collect()
    report = {r[0]: r for r in plain_words_report([r for r in single if r[0] is not None])}
    assert len(cut) == len(single)
    for r in (r for r in cut if r["doc_id"] is not None):
        assert len(cases.words(r["text"])) == report[r["doc_id"]][1] - report[r["doc_id"]][2]
        assert r["n_chars"] == len(r["text"])
    sizes, goal_of = Counter(), {}
    for r in cut:
        sizes[r["source"]] += len(cases.words(r["text"]))
    goal = plain_targets(dict(sizes))
    mixed = stages[3].collect()
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies.values()) <= {1, 2}
    taken = Counter()
    for r in mixed:
        taken[r["source"]] += len(cases.words(r["text"]))
    longest = max(len(cases.words(r["text"])) for r in cut)
    assert all(abs(taken[s] - goal[s]) <= longest for s in goal)


def test_last_stage_encodes_the_mix(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
    expected = Counter((r["doc_id"], tuple(library.encode(r["text"]))) for r in stages[3].collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stages[4].collect()) == expected
    assert all(r["round_trip"] for r in stages[4].collect())


def test_run_is_the_stages(spark, folder, stages):
    path, _ = folder
    got = corpus_pipeline.run(spark, path)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == Counter(
        (r["doc_id"], tuple(r["ids"])) for r in stages[4].collect()
    )


def test_empty_corpus(spark, tmp_path):
    cases.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_library_does_not_import_the_subpackage():
    root = os.path.dirname(corpus_pipeline.__file__)
    for base, _, names in os.walk(f"{root}/vigilpay"):
        if base.endswith("/llm") or "__pycache__" in base:
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(base, name)) as f:
                    assert "vigilpay.llm" not in f.read()
