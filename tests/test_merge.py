"""Laws and edge cases of the merges, in every form."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from tideload.operators.latest import latest_by_aggregate, latest_per_key
from tideload.operators.merge import apply_deletes, apply_puts, merge_changes, merge_latest

FORMS = ["lookup", "join", "window"]
BASE = "k int, v string"
CHANGES = "k int, v string, header__operation string, header__timestamp timestamp_ntz, seq int"
DAY = datetime(2024, 1, 1)


def at(seconds):
    return DAY + timedelta(seconds=seconds)


def merged(spark, base, changes, form, keys=("k",)):
    b = spark.createDataFrame(base, BASE)
    c = spark.createDataFrame(changes, CHANGES)
    return rows(merge_changes(b, c, list(keys), tiebreak=["seq"], form=form))


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize(
    ("base", "changes", "expected"),
    [
        pytest.param([(1, "a")], [(9, "x", "DELETE", at(0), 1)], [(1, "a")], id="delete of an unknown key"),
        pytest.param([(1, "a")], [(2, "b", "UPDATE", at(0), 1)], [(1, "a"), (2, "b")], id="update of an unknown key"),
        pytest.param(
            [(1, "a")], [(1, "a", "DELETE", at(0), 1), (1, "b", "INSERT", at(5), 2)], [(1, "b")], id="delete then insert"
        ),
        pytest.param(
            [], [(1, "a", "INSERT", at(0), 1), (1, "a", "DELETE", at(0.5), 2)], [], id="same second, sequence decides"
        ),
        pytest.param(
            [], [(1, "a", "INSERT", at(0.9), 2), (1, "b", "UPDATE", at(0.95), 1)], [(1, "a")], id="sequence beats fraction"
        ),
        pytest.param([(1, "a")], [(1, "z", "BEFOREIMAGE", at(9), 9)], [(1, "a")], id="only a before-image"),
        pytest.param([(1, "a")], [(1, "z", None, at(9), 9)], [(1, "a")], id="no operation"),
        pytest.param(
            [(1, "a")], [(1, "z", "UPDATE", datetime(1950, 1, 1), 1)], [(1, "z")], id="old change still wins"
        ),
        pytest.param(
            [(1, "a")],
            [(1, "z", "UPDATE", datetime(1850, 1, 1), 1), (2, "y", "INSERT", datetime(1850, 1, 1), 1)],
            [(1, "a"), (2, "y")],
            id="change from before the stored age",
        ),
        pytest.param(
            [(1, "a")],
            [(1, "z", "UPDATE", None, 1), (2, "y", "INSERT", None, 1), (1, "d", "DELETE", None, 2)],
            [(1, "a"), (2, "y")],
            id="undated changes only add keys",
        ),
        pytest.param([(1, "a"), (2, "b")], [], [(1, "a"), (2, "b")], id="no changes"),
        pytest.param([], [(1, "a", "INSERT", at(0), 1)], [(1, "a")], id="no base"),
        pytest.param(
            [(None, "n"), (1, "a")],
            [(None, "m", "UPDATE", at(0), 1), (None, "o", "UPDATE", at(1), 1)],
            [(1, "a"), (None, "o")],
            id="NULL is a key",
        ),
    ],
)
def test_edge_cases(spark, form, base, changes, expected):
    assert merged(spark, base, changes, form) == sorted(expected, key=str)


def by_hand(base, changes):
    """The merge row by row."""
    best = {}
    for k, v in base:
        best[k] = ((datetime(1900, 1, 1), -1), v, "INSERT")
    for k, v, op, ts, seq in changes:
        if op is None or op == "BEFOREIMAGE":
            continue
        order = (ts.replace(microsecond=0), seq)
        if k not in best or order > best[k][0]:
            best[k] = (order, v, op)
    return sorted(((k, v) for k, (_, v, op) in best.items() if op != "DELETE"), key=str)


def random_changes(rng, n, hot=None):
    ops = ["INSERT", "UPDATE", "DELETE", "BEFOREIMAGE", None]
    return [
        (hot if hot is not None and i % 3 == 0 else rng.randrange(40), f"c{i}", rng.choice(ops), at(rng.randrange(30) / 3), i)
        for i in rng.sample(range(n), n)
    ]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_row_by_row(spark, form, seed):
    rng = random.Random(seed)
    base = [(k, f"b{k}") for k in range(25)]
    changes = random_changes(rng, 300, hot=7)
    assert merged(spark, base, changes, form) == by_hand(base, changes)


@pytest.mark.parametrize("form", FORMS)
def test_merging_again_changes_nothing(spark, form):
    base = [(k, f"b{k}") for k in range(25)]
    changes = random_changes(random.Random(4), 200)
    once = merged(spark, base, changes, form)
    assert merged(spark, once, changes, form) == once


@pytest.mark.parametrize("form", FORMS)
def test_two_steps_equal_one(spark, form):
    base = [(k, f"b{k}") for k in range(25)]
    changes = random_changes(random.Random(5), 200)
    early = [c for c in changes if c[3] < at(5)]
    late = [c for c in changes if c[3] >= at(5)]
    first = merged(spark, base, early, form)
    assert merged(spark, first, late, form) == merged(spark, base, changes, form)


@pytest.mark.parametrize("form", FORMS)
def test_composite_key_with_null_part(spark, form):
    base = spark.createDataFrame([(1, "x", 10), (1, None, 11), (2, "x", 12)], "a int, b string, v int")
    changes = spark.createDataFrame(
        [(1, None, 21, "UPDATE", at(0)), (2, "x", 0, "DELETE", at(0)), (2, None, 22, "INSERT", at(0))],
        "a int, b string, v int, header__operation string, header__timestamp timestamp_ntz",
    )
    got = rows(merge_changes(base, changes, ["a", "b"], form=form))
    assert got == sorted([(1, "x", 10), (1, None, 21), (2, None, 22)], key=str)


@pytest.mark.parametrize("limit", ["-1", "1", "10485760"])
def test_repeated_base_keys_give_one_answer(spark, limit):
    """Whatever the form and the broadcast limit: repeated keys, the sentinel second, NULL keys."""
    sentinel = datetime(1900, 1, 1)
    b = spark.createDataFrame([(1, "a", 5), (1, "b", 9), (2, "c", 1), (3, "d", 9), (None, "e", 1), (None, "f", 2)], "k int, v string, n int")
    c = spark.createDataFrame(
        [(2, "C", 7, "UPDATE", at(0)), (3, "D", 3, "UPDATE", sentinel), (4, "E", 1, "INSERT", sentinel), (None, "N", 0, "UPDATE", None)],
        "k int, v string, n int, header__operation string, header__timestamp timestamp_ntz",
    )
    newer = c.where("header__timestamp IS NOT NULL").select("k", "v", "n", F.col("header__timestamp").alias("lastmodifieddate"))
    dated = b.withColumn("lastmodifieddate", F.lit(sentinel))
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, limit)
    try:
        got = {f: rows(merge_changes(b, c, ["k"], tiebreak=["n"], form=f)) for f in ["auto", *FORMS]}
        latest = {f: rows(merge_latest(dated, newer, ["k"], tiebreak=["n"], form=f), "k", "v") for f in ["auto", *FORMS]}
    finally:
        spark.conf.unset(key)
    want = sorted([(1, "b", 9), (2, "C", 7), (3, "d", 9), (4, "E", 1), (None, "f", 2)], key=str)
    assert all(g == want for g in got.values()), got
    assert all(g == sorted([w[:2] for w in want], key=str) for g in latest.values()), latest


@pytest.mark.parametrize("form", FORMS)
def test_the_word_that_keys_are_unique_changes_nothing_where_it_is_true(spark, form):
    base = [(k, f"b{k}") for k in range(25)]
    changes = random_changes(random.Random(6), 200)
    b, c = spark.createDataFrame(base, BASE), spark.createDataFrame(changes, CHANGES)
    got = [
        rows(merge_changes(b, c, ["k"], tiebreak=["seq"], form=form, unique_base=u, key_partitioned=p))
        for u in (False, True)
        for p in (False, True)
    ]
    assert all(g == by_hand(base, changes) for g in got)


def test_without_tiebreak_runs_agree(spark):
    changes = [(1, f"v{i}", "UPDATE", at(0.1), None) for i in range(20)]
    c = spark.createDataFrame(changes, CHANGES).drop("seq")
    b = spark.createDataFrame([], BASE)
    got = {tuple(rows(merge_changes(b, c.repartition(n), ["k"], form=f))) for n in (1, 3, 5) for f in FORMS}
    assert len(got) == 1


LATEST = "k int, v string, lastmodifieddate timestamp_ntz"


@pytest.mark.parametrize("form", FORMS)
def test_latest_wins(spark, form):
    base = spark.createDataFrame(
        [(1, "old", at(0)), (2, "newer", at(9)), (3, "tie", at(5)), (4, "undated", None), (5, "kept", at(1))], LATEST
    )
    changes = spark.createDataFrame(
        [(1, "new", at(1)), (1, "newest", at(1.5)), (2, "late", at(8)), (3, "change", at(5)), (4, "dated", at(0)),
         (6, "added", at(0)), (5, "undated", None), (7, "undated", None)],
        LATEST,
    )
    got = rows(merge_latest(base, changes, ["k"], form=form), "k", "v")
    assert got == [(1, "newest"), (2, "newer"), (3, "change"), (4, "dated"), (5, "kept"), (6, "added"), (7, "undated")]


def test_puts_and_deletes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], BASE)
    puts = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], BASE)
    assert rows(apply_puts(target, puts, ["k"])) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "N")], key=str)
    assert rows(apply_deletes(target, puts.unionByName(puts), ["k"])) == [(1, "a")]


def test_latest_forms_agree(spark):
    rng = random.Random(6)
    data = [(rng.randrange(8), rng.choice([None, *range(20)]), i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(data, "k int, a int, seq int, v string")
    by_rank = latest_per_key(df, ["k"], [F.col("a").desc_nulls_last(), F.col("seq").desc()])
    assert rows(by_rank) == rows(latest_by_aggregate(df, ["k"], ["a", "seq"]))


# The documented fixtures: change tables derived from orders and events by rule.

def fixture_changes(spark, reinsert):
    o = spark.read.parquet(str(DATA / "sf0.01" / "orders.parquet"))
    key = F.col("o_orderkey")

    def feed(rows_, op, day, seq):
        return rows_.select(
            "*",
            F.lit(op).alias("header__operation"),
            F.lit(day).cast("timestamp_ntz").alias("header__timestamp"),
            F.lit(seq).alias("seq"),
        )

    updated = o.where(key % 7 == 0).withColumns({"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + 1})
    changes = (
        feed(updated, "UPDATE", "2024-01-01", 2)
        .unionByName(feed(o.where(key % 7 == 0), "BEFOREIMAGE", "2024-01-01", 0))
        .unionByName(feed(o.where(key % 11 == 0), "DELETE", "2024-01-02", 3))
        .unionByName(feed(o.where(key % 10 == 9), "INSERT", "2024-01-01", 1))
    )
    if reinsert:
        changes = changes.unionByName(feed(o.where(key % 22 == 0), "INSERT", "2024-01-03", 4))
    return o.where(key % 10 < 9), changes


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize(("reinsert", "count"), [(False, 13636), (True, 14318)])
def test_fixture_counts(spark, form, reinsert, count):
    base, changes = fixture_changes(spark, reinsert)
    assert merge_changes(base, changes, ["o_orderkey"], tiebreak=["seq"], form=form).count() == count
