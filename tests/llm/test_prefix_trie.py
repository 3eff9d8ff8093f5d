import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tideload.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    nodes = defaultdict(list)
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 9
        rest = abs(conv) % 5 * (1 if conv >= 0 else -1)
        path = tuple(own.get(conv - rest, [])[:head] + turns[head:])
        for depth in range(len(path) + 1):
            nodes[path[:depth]].append((conv, depth == len(path)))
    owner = {path: min(c for c, _ in members) for path, members in nodes.items()}
    children = Counter(path[:-1] for path in nodes if path)
    saved, leaves = Counter(), Counter()
    for path, members in nodes.items():
        for depth in range(len(path) + 1):
            saved[path[:depth]] += (len(members) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:depth]] += not children[path]
    return sorted(
        (owner[p], len(p), owner[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c, end in sorted(m) if end).encode()).hexdigest())
        for p, m in nodes.items()
    )


def check(spark, rows, partitions=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = [tuple(r) for r in prefix_trie(table).collect()]
    assert sorted(got, key=lambda r: r[:2]) == brute(rows)


def talk(rng, turns, words=("a", "b", "é"), roles=("user", "assistant")):
    return [(i, roles[i % 2], rng.choice(words)) for i in range(turns)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(c, *t) for c in range(0, 150, 1 + seed) for t in talk(rng, rng.randrange(0, 14))]
    # A group of copies, and one that differs in the last turn.
    rows += [(c, i, "user", "same") for c in range(1000, 1060) for i in range(20)]
    rows += [(c, i, "user", "same" if i < 19 else f"last {c % 7}") for c in range(2000, 2040) for i in range(20)]
    rows += [(-c, i, "user", rng.choice("ab")) for c in range(1, 30) for i in range(4)]
    rng.shuffle(rows)
    check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(c, t, r, x) for c in range(0, 40) for t, r, x in [(None, "user", None), (1, None, "b"), (1, "a", "b"), (1, "a", "b"), (0, "", "")]]
    rows += [(None, 1, "user", "x"), (41, None, None, None), (45, 1, "user", "long " * 50_000), (47, 1, "user", "long " * 50_000)]
    check(spark, rows)


def test_long_conversations_over_many_partitions(spark):
    """Two thirds of all turns are in three conversations that share their beginnings."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(c, i, "user", f"turn {i % 11}" if i < 900 - 100 * (c % 3) else f"own {c} {i}") for c in (500, 501, 502) for i in range(1000)]
        rows += [(c, i, "user", f"turn {i % 11}") for c in range(100, 200) for i in range(c % 17)]
        check(spark, rows, 8)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_conversations_without_turns(spark):
    """A head that its family's missing first conversation can't fill leaves nothing."""
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    assert [tuple(r)[:7] for r in prefix_trie(spark.createDataFrame([(alone, 0, "user", "x")], SCHEMA)).collect()] == [
        (alone, 0, None, 1, 0, 1, 0)
    ]
    check(spark, [(alone, 0, "user", "x")])


def test_empty_table_and_other_columns(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(c, 0, "user", "x", 1, 2) for c in range(10)]
    table = spark.createDataFrame(rows, SCHEMA + ", depth int, owner int")
    assert sorted(tuple(r) for r in prefix_trie(table).collect()) == brute([r[:4] for r in rows])
