"""Small tables with all that a real table may hold, and plain versions of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "do", "ki", "lu", "mé", "ß", "no"]) for _ in range(r.randrange(1, 5))) + str(r.randrange(vocabulary)) for _ in range(n))


def odd_rows():
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    passage = prose(1, 60)
    rows = [(i, prose(100 + i, 30 + 7 * i), "en", f"s{i % 3}") for i in range(12)]
    rows += [(20 + i, prose(103, 51), "en", "s1") for i in range(4)]  # exact copies of 3
    near = prose(110, 400).split()
    rows += [(30 + i, " ".join(near[:200] + [f"x{i}"] + near[201:]), "de", "s2") for i in range(4)]
    rows += [(40 + i, f"{prose(200 + i, 40)}\n{passage}\t{prose(300 + i, 25 + i)}", "fr", "s0") for i in range(3)]
    rows += [
        (50, None, "en", "s0"), (51, "", "en", "s0"), (52, " \t\n ", None, None), (53, "one", "en", None),
        (54, "one two", "en", None), (55, prose(7, 3000), "de", "s1"), (56, "a b c d e " * 40, "en", "s2"),
        (57, "Zürich\x0bstraße\x1cñ\x85é 日本語のテキスト \U0001F600 end", "es", "s0"), (58, "### $$$ 123 456", "en", "s1"),
        (None, prose(1, 60), "en", "s1"), (None, None, None, None), (60, prose(400, 20), "en", "s1"), (60, prose(400, 20), "en", "s1"),
        (59, "x" * 300, "en", "s2"), (61, "x" * 180, "en", "s2"), (-5, f"{passage} tail", "en", "s0"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCUMENTS)


def clashing(df):
    """The same table with columns named like results and helpers."""
    from pyspark.sql import functions as F

    names = [
        "n_words", "kept", "rejected_by", "shard", "slot", "size", "ids", "score", "found", "component_id", "fingerprint",
        "lang_pred", "m", "first", "hash", "block", "start", "target", "copies",
    ]
    return df.select("*", *[F.lit(7).alias(n) for n in names])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def components(nodes, linked):
    """Smallest node reachable, by links given as a predicate."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if low[b] < low[a] and linked(a, b):
                    low[a], changed = low[b], True
    return low
