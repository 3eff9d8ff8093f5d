from collections import Counter

import pytest

from tideload.llm.sharding import fill_table, place, write_shards

NAMES = [f"s{i}" for i in range(12)]


def plain_table(names, size, order):
    """Every shard claims its most preferred free slot in turn."""
    table, owner = [None] * size, 0
    wishes = {n: iter(order(n)) for n in names}
    while None in table:
        for n in names:
            slot = next((s for s in wishes[n] if table[s] is None), None)
            if slot is None:
                break
            table[slot] = n
    return table


def test_turns_and_balance():
    import xxhash

    size = 251
    order = lambda n: [
        (xxhash.xxh64_intdigest(n.encode(), 1) + k * (xxhash.xxh64_intdigest(n.encode(), 2) % (size - 1) + 1)) % size
        for k in range(size)
    ]
    got = fill_table(NAMES, size)
    assert [NAMES[i] for i in got] == plain_table(sorted(NAMES), size, order)
    counts = Counter(got)
    assert max(counts.values()) - min(counts.values()) <= 1
    weighted = Counter(fill_table(NAMES, 1009, {"s3": 3}))
    assert abs(weighted[3] - 3 * weighted[0]) <= 3


def test_losing_a_shard_moves_few_slots():
    before, after = fill_table(NAMES, 1009), fill_table(NAMES[:-1], 1009)
    stayed = [a == b for a, b in zip(before, after, strict=True) if a != len(NAMES) - 1]
    assert sum(stayed) >= 0.85 * len(stayed)
    reversed_names = fill_table(NAMES[::-1], 1009)
    assert [NAMES[::-1][i] for i in reversed_names] == [NAMES[i] for i in before]


@pytest.mark.parametrize("size, names", [(250, NAMES), (251, []), (251, ["a", "a"]), (7, NAMES)])
def test_wrong_tables(size, names):
    with pytest.raises(ValueError):
        fill_table(names, size)


def test_place(spark, scratch):
    table = fill_table(NAMES, 251)
    df = spark.createDataFrame([(i, str(i), 1) for i in range(500)] + [(None, str(i), 1) for i in range(200)] + [(3, "3", 1)], "k long, t string, slot int")
    got = place(df, ["k"], {"shard": (NAMES, table)}).collect()
    assert len(got) == 701 and all(NAMES[table[r.slot]] == r.shard for r in got)
    assert len({r.slot for r in got if r.k == 3}) == 1
    assert len({r.slot for r in got if r.k is None}) > 50
    assert place(df.limit(0), ["k"], {"shard": (NAMES, table)}).collect() == []
    write_shards(place(df, ["k"], {"shard": (NAMES, table)}), "shard", ["k", "t"], f"{scratch}/out")
    assert spark.read.parquet(f"{scratch}/out").count() == 701
