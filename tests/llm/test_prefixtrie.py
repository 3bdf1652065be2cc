"""The conversation trie against one built prefix by prefix."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vigilpay.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    conversations = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conversations[c].append((turn is not None, turn or 0, role or "", text or ""))
    tie = lambda v: hashlib.sha256(f"{len(v[2].encode())}:{v[2]}{v[3]}".encode()).digest()[:16]
    for own in conversations.values():
        own.sort(key=lambda v: (v[0], v[1], tie(v)))
    sequences = {}
    for c, own in list(conversations.items()):
        base, h = c - (abs(c) % 5) * (1 if c >= 0 else -1), zlib.crc32(str(c).encode()) % 9
        sequences[c] = tuple(v[2:] for v in conversations.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[sequences[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, m in members.items():
        own = (len(m) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own
            leaves[path[:d]] += children[path] == 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted((
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], sha(c for c in m if sequences[c] == p))
        for p, m in members.items()
    ), key=repr)


def found(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit(1)).withColumn("name", F.lit("x")).withColumn("c", F.lit(2))
    return sorted(map(tuple, prefixtrie.prefix_trie(table).collect()), key=repr)


def varied():
    r = random.Random(3)
    lengths = [1, 2, 3, 9, 17, 40]
    rows = [(c, t, r.choice("ab"), r.choice("xyé")) for c in [*range(40), -7, -5, 105, 106] for t in range(r.choice(lengths))]
    same = [(300, t, "u", f"same{t // 3}") for t in range(30)]
    rows += same + [(c, *rest) for c in (301, 302, 303, 304, 310) for _, *rest in same]
    # null values, ties, repeated rows, a base that is absent, fewer turns than are taken
    rows += [(3, None, None, None), (3, 2, "a", "x"), (3, 2, "a", "x"), (None, 1, "a", "b"), (200, 1, "u", "z"), (201, 1, "q", "z")]
    return rows


def test_trie_equals_plain_one(spark, monkeypatch):
    rows = varied()
    expected = plain(rows)
    assert found(spark, rows) == expected
    monkeypatch.setattr(prefixtrie, "ID_BLOCK", 2)
    assert found(spark, list(reversed(rows))) == expected


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")], [(1, 0, None, None)], [(c, 0, "u", "hi") for c in range(9)]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == plain(rows)


def test_one_conversation_with_most_turns(spark):
    rows = [(5, t, "u", "again" if t % 2 else str(t // 50)) for t in range(300)] + [(c, 0, "u", "0") for c in range(4)]
    assert found(spark, rows) == plain(rows)
