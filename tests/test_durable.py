"""Numbers and keys over runs, fact deltas, extract splits, counts while writing, cells in a store."""

import os
import random
import subprocess
import sys
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import DATA, ROOT, plan_of, rows
from pyspark.sql import functions as F

from tideload.operators.audit import latest_counts
from tideload.operators.cells import to_cells, to_mutations
from tideload.operators.publish import VersionedTable, write_counted
from tideload.operators.ranged import RangedTable
from tideload.operators.sequences import KeyMap, Sequences
from tideload.plans.billing import at_stage, receipts, stage_position
from tideload.plans.loads import LoadSpec, run_all, run_full
from tideload.plans.warehouse import FACT_KEYS, FactInputs, HeadedInputs, add_fact_delta, fact_delta, fact_of, fact_state, invoice_fact, merge_fact_delta
from tideload.queries.billing import filled_headers, open_headers, sponsors
from tideload.queries.loading import skewed_lines
from tideload.queries.registry import Tables
from tideload.session import joins_by_some_keys
from tideload.sources.cellstore import FileCells, write_mutations
from tideload.sources.extract import balanced_predicates, read_split


def test_sequences(spark, scratch):
    sequences = Sequences(spark, f"{scratch}/s")
    part = spark.range(100).select("id")
    one = dict(rows(sequences.number(part.where("id < 40"), ["id"], "invoice", "one", start=10)))
    assert one == {i: 10 + i for i in range(40)}
    for _ in range(2):  # a run that is repeated has the same numbers
        two = dict(rows(sequences.number(part.where("id >= 40"), ["id"], "invoice", "two")))
        assert two == {i: 10 + i for i in range(40, 100)}
    assert sequences.reserve("receipt", "two", 5) == 1 and sequences.reserve("receipt", "three", 5) == 6
    with pytest.raises(ValueError, match="60 numbers"):
        sequences.reserve("invoice", "two", 61)
    assert sequences.blocks().count() == 4


def test_key_map(spark, scratch):
    keys = KeyMap(spark, f"{scratch}/k", ["a", "b"], "key")
    with pytest.raises(FileNotFoundError):
        keys.with_keys(spark.range(1))
    schema = "a int, b string, v int"
    first = spark.createDataFrame([(2, "x", 1), (1, None, 1), (1, "x", 1), (2, "x", 9)], schema)
    assert keys.add(first, "one") == 3
    assert rows(keys.read()) == [(1, 1, None), (2, 1, "x"), (3, 2, "x")]
    # A reload with new and missing rows, and a repetition of it.
    second = spark.createDataFrame([(0, "x", 1), (2, "x", 1), (None, None, 1)], schema)
    assert [keys.add(second, "two") for _ in range(2)] == [2, 0]
    found = keys.with_keys(first.unionByName(second).unionByName(spark.createDataFrame([(7, "z", 0)], schema)))
    assert rows(found.select("key", "a", "b").distinct()) == sorted(
        [(4, None, None), (1, 1, None), (2, 1, "x"), (3, 2, "x"), (5, 0, "x"), (None, 7, "z")], key=str
    )


def test_key_map_run_that_failed(spark, scratch, monkeypatch):
    """Numbers that were reserved, but not written, are given to the same keys by the run that is repeated."""
    keys = KeyMap(spark, f"{scratch}/k", ["id"], "key")
    keys.add(spark.range(3), "one")

    def fail(*_):
        raise InterruptedError

    monkeypatch.setattr("tideload.operators.sequences.write_counted", fail)
    with pytest.raises(InterruptedError):
        keys.add(spark.range(6), "two")
    monkeypatch.undo()
    assert keys.read().count() == 3 and keys.add(spark.range(6), "two") == 3
    assert rows(keys.read(), "id", "key") == [(i, i + 1) for i in range(6)]


FACT_MEASURES = ("amount", "tax")


def inputs(spark, details, patients, admissions, diagnoses=("flu", "cold")):
    return FactInputs(
        spark.createDataFrame(details, "detail_id int, service_id int, hospital_id int, doctor_id int, patient_id int, amount long, tax long"),
        spark.createDataFrame([(p,) for p in patients], "patient_id int"),
        spark.createDataFrame(admissions, "patient_id int, diagnosis_id string"),
        spark.createDataFrame([(d,) for d in diagnoses], "diagnosis_id string"),
    )


@pytest.mark.parametrize("each_admission", [True, False])
def test_fact_delta_equals_the_rebuild(spark, scratch, each_admission):
    rng = random.Random(4)

    def detail(i):
        return (i, rng.randrange(3), 1, rng.randrange(2), rng.randrange(12), rng.choice([None, rng.randrange(100)]), rng.choice([None, 7]))

    old = {i: detail(i) for i in range(120)}
    new = {**old, **{i: detail(i) for i in [*range(0, 120, 7), *range(120, 140)]}}
    for i in range(5, 120, 11):
        del new[i]
    changed = [i for i in {**old, **new} if old.get(i) != new.get(i)]
    stays = [(rng.randrange(14), rng.choice(["flu", "cold", "other"])) for _ in range(20)]
    later = stays[3:] + [(1, "flu"), (11, "other")]
    moved = {p for p, _ in (Counter(stays) - Counter(later)) + (Counter(later) - Counter(stays))} | {2, 13}
    before = inputs(spark, list(old.values()), range(0, 13), stays)
    after = inputs(spark, list(new.values()), [p for p in range(14) if p != 2], later)
    delta = fact_delta(
        before, after, ["detail_id"], spark.createDataFrame([(i,) for i in changed], "detail_id int"),
        spark.createDataFrame([(p,) for p in moved], "patient_id int"), FACT_MEASURES, each_admission,
    )
    want = rows(invoice_fact(*after, FACT_MEASURES, each_admission))
    start = fact_state(before, FACT_MEASURES, each_admission)
    assert rows(fact_of(start, FACT_MEASURES)) == rows(invoice_fact(*before, FACT_MEASURES, each_admission))
    assert rows(fact_of(add_fact_delta(start, delta), FACT_MEASURES)) == want
    table = RangedTable(spark, f"{scratch}/fact", FACT_KEYS)
    table.create(start, files=6)
    assert merge_fact_delta(table, delta, "one").rewritten
    assert merge_fact_delta(table, delta, "one") is None
    assert rows(fact_of(table.read(), FACT_MEASURES)) == want


def test_balanced_splits(spark):
    lines = skewed_lines(Tables(spark, str(DATA / "sf0.01")))
    total = lines.where("split_key IS NOT NULL").count()
    predicates = balanced_predicates(lines, "split_key", 8, spread="l_orderkey", sample_rows=20_000)
    read = read_split(lines, predicates, "read")
    sizes = {r["read"]: r["count"] for r in read.groupBy("read").count().collect()}
    assert sum(sizes.values()) == lines.count()
    assert all(size <= 2 * total / 8 for number, size in sizes.items() if number)
    assert sizes[0] == lines.where("split_key IS NULL").count() > 0
    assert len(predicates) <= 30


def test_split_conditions(spark):
    def split(values, parts, kind, **options):
        table = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, i int")
        predicates = balanced_predicates(table, "k", parts, **options)
        # Keys the sample has not seen are read too, and nothing twice.
        other = spark.createDataFrame([(v, 100 + i) for i, v in enumerate(values)], f"k {kind}, i int")
        assert rows(read_split(table, predicates)) == rows(table)
        assert rows(read_split(other, balanced_predicates(table.limit(3), "k", parts, **options))) == rows(other)
        return predicates

    assert split([None, None], 4, "int") == ["k IS NULL", "k IS NOT NULL"]
    assert split([3, 1, 2, 4], 2, "int") == ["k IS NULL", "k < 3", "k >= 3"]
    assert split([5] * 10 + [1, 9, None], 4, "int") == ["k IS NULL", "k < 5", "k = 5", "k > 5"]
    assert split([5] * 10 + [1, 9], 4, "int", spread="i")[2:6] == [f"k = 5 AND (i) % 4 = {i}" for i in range(4)]
    split(["it's", "b", "", "a\\n", None], 3, "string")
    split([datetime(2024, 1, d, 1, 2, 3) for d in range(1, 9)], 3, "timestamp_ntz")
    split([datetime(2024, 1, d).date() for d in range(1, 9)], 3, "date")
    split([Decimal("1.10"), Decimal("-2.00"), Decimal("7.50")], 3, "decimal(5,2)")
    split([], 3, "int")
    with pytest.raises(TypeError):
        balanced_predicates(spark.createDataFrame([(True,), (False,)], "k boolean"), "k", 2)


def test_counts_while_writing(spark, scratch, monkeypatch):
    assert write_counted(spark.range(10).where("id > 3"), f"{scratch}/a") == 6
    assert write_counted(spark.range(10).where("false"), f"{scratch}/b") == 0
    table = VersionedTable(spark, f"{scratch}/t")
    table.publish(spark.range(7).repartition(3))
    assert table.rows() == table.rows(1) == 7
    os.remove(f"{scratch}/t/_rows/1")
    assert table.rows() == 7  # counted, where no count was written


def test_a_load_scans_each_table_once(spark, scratch):
    """The audit starts no job over the tables: what it writes is one row per table."""
    specs = [LoadSpec(name, ["id"], ["id"]) for name in ("a", "b")]
    scanned = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scanned.add(len(batch))
            yield batch

    sources = {n: spark.range(100).mapInPandas(seen, "id long") for n in ("a", "b")}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "audit")
    counts = run_all(spark, specs, run_full, sources, f"{scratch}/root", f"{scratch}/audit", workers=1)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert scanned.value == 200
    assert rows(counts, "tablename", "count") == rows(latest_counts(spark, f"{scratch}/audit")) == [("a", 100), ("b", 100)]
    assert len(tracker.getJobIdsForGroup("audit")) <= 4


def test_cells_of_jobs_that_fail_and_repeat(spark, scratch):
    store = FileCells(f"{scratch}/store")
    df = spark.createDataFrame([(i, f"v{i}", None) for i in range(50)], "id int, v string, w string")
    write_mutations(to_mutations(df, ["id"]), store)
    assert rows(store.read(spark)) == rows(to_cells(df, ["id"]))
    broken = to_mutations(df.withColumn("v", F.when(F.col("id") == 37, F.raise_error(F.lit("broken"))).otherwise(F.lit("new"))), ["id"])
    with pytest.raises(Exception, match="broken"):
        write_mutations(broken, store, "second")
    assert rows(store.read(spark)) == rows(to_cells(df, ["id"])) and os.listdir(f"{scratch}/store/tasks") != []
    change = df.where("id < 10").withColumn("v", F.lit("new"))
    for _ in range(2):
        write_mutations(to_mutations(change, ["id"], F.col("id") < 3), store, "second")
    got = {(r.rowkey, r.qualifier): r.value for r in store.read(spark).collect()}
    want = {(str(i), "v"): "new" if i < 10 else f"v{i}" for i in range(3, 50)} | {(str(i), "w"): "" for i in range(3, 50)}
    assert got == want and len(os.listdir(f"{scratch}/store/jobs")) == 2


RETRY = """
import os, sys
FOLDER = sys.argv[1]
sys.path.insert(0, sys.argv[2])
from tideload.session import build_session
from tideload.operators.cells import to_mutations
from tideload.sources.cellstore import FileCells, write_mutations

class Flaky(FileCells):
    def open(self, job, task):
        writer = super().open(job, task)
        put, seen = writer.put, []
        def once(rowkey, family, cells):
            seen.append(rowkey)
            put(rowkey, family, cells)
            mark = FOLDER + "/failed"
            if len(seen) == 5 and not os.path.exists(mark):
                open(mark, "w").close()
                raise OSError("the store went away")
        writer.put = once
        return writer

spark = build_session("retry", "local[2,4]", **{"spark.sql.shuffle.partitions": "3"})
store = Flaky(FOLDER + "/store")
write_mutations(to_mutations(spark.range(100).selectExpr("id", "id * 2 AS v"), ["id"]), store)
assert os.path.exists(FOLDER + "/failed")
found = store.read(spark).collect()
assert sorted((int(r.rowkey), r.value) for r in found) == [(i, str(2 * i)) for i in range(100)], found
print("all cells once")
"""


def test_a_task_that_fails_and_runs_again(scratch):
    done = subprocess.run([sys.executable, "-c", RETRY, scratch, str(ROOT)], capture_output=True, text=True, timeout=300)
    assert "all cells once" in done.stdout, done.stderr[-2000:]


def test_stage_positions(spark):
    stages = spark.createDataFrame([(10, "Arrival"), (20, "Attend"), (35, "Result")], "stage_id int, stage_name string")
    assert rows(stage_position(stages, "Result")) == [(35, 20)] and rows(stage_position(stages, "Arrival")) == [(10, None)]
    records = spark.range(2)
    assert rows(at_stage(records, stages, "Attend")) == [(0, 20, 10), (1, 20, 10)]
    assert at_stage(records, stages, "unknown").count() == 0


def test_receipts_read_the_lines_once(spark, monkeypatch):
    """The headers carry that their order has lines; only their totals read the lines."""
    t = Tables(spark, str(DATA / "sf0.001"))
    due = {}
    headers = open_headers(t)
    monkeypatch.setattr("tideload.plans.billing.number_rows", lambda df, *_: due.setdefault("rows", df))
    receipts(filled_headers(t, headers), sponsors(t), None, "OPR")
    scans = [line for line in plan_of(due["rows"]).splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1


def test_print_stream(spark, scratch, capfd):
    from tideload.streaming.changes import print_stream

    spark.range(3).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema("id long").parquet(f"{scratch}/in")
    query = print_stream(stream, availableNow=True)
    assert query.awaitTermination(60)
    assert query.lastProgress["numInputRows"] == 3 and query.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")


def test_fact_sums_are_not_exchanged(spark, scratch):
    """Details are exchanged as they are, summed up where they lie; a delta is added in the files' ranges."""
    given = inputs(spark, [(1, 1, 1, 1, 1, 5, None), (2, 1, 1, 1, 1, 6, 7), (3, 2, 1, 1, 2, 7, 7)], [1, 2], [(1, "flu"), (1, "flu")])
    measures = {"m": F.col("amount") * 2, "n": F.col("tax")}
    fact = invoice_fact(*given, measures)
    assert rows(fact.select("service_id", "diagnosis_id", "m", "n")) == [(1, "flu", 44, 14), (2, None, 14, 7)]
    for plan in (plan_of(fact), plan_of(fact_state(given, measures, by_range=True))):
        summed = [i for i, line in enumerate(plan.splitlines()) if "sum(" in line]
        moved = [i for i, line in enumerate(plan.splitlines()) if "Exchange" in line]
        assert summed and not [i for i in moved if summed[0] < i < summed[1]]
    table = RangedTable(spark, f"{scratch}/fact", FACT_KEYS)
    table.create(fact_state(given, measures, by_range=True), placed=True)
    gone = fact_state(given._replace(details=given.details.where("detail_id < 3")), measures)
    negative = gone.select(*FACT_KEYS, *[(-F.col(c)).alias(c) for c in gone.columns if c not in FACT_KEYS])
    more = fact_state(given._replace(details=given.details.where("detail_id = 3")), measures)
    table.add(negative.unionByName(more), "n_rows")
    assert rows(fact_of(table.read(), measures).select("service_id", "m", "n")) == [(2, 28, 14)]


def test_fact_build_exchanges_details_by_patient_only(spark):
    """The diagnoses join the sums where these lie: no exchange of one row per detail and diagnosis."""
    details = spark.createDataFrame(
        [(1, 1, 1, 1, 5), (1, 1, 1, 1, 7), (2, 1, 1, 2, 3), (2, None, 1, 2, 4), (3, 1, 1, 9, 8), (3, 1, 1, None, 8)],
        "service_id int, hospital_id int, doctor_id int, patient_id int, m long",
    )
    patients = spark.createDataFrame([(1,), (2,), (2,), (None,)], "patient_id int")
    admissions = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "x"), (1, None), (9, "a")], "patient_id int, diagnosis_id string")
    diagnoses = spark.createDataFrame([("a",), ("b",)], "diagnosis_id string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = invoice_fact(details, patients, admissions, diagnoses, ["m"])
        plan = plan_of(fact)
        got = rows(fact)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [line for line in plan.splitlines() if "Exchange" in line and "hashpartitioning(service_id" in line]
    want = [(1, 1, 1, 1, "a", 24), (1, 1, 1, 1, "b", 12), (1, 1, 1, 1, None, 24), (2, 1, 1, 2, None, 3), (2, None, 1, 2, None, 4)]
    assert got == sorted(want, key=str)


def test_cells_are_exchanged_as_mutations(spark, scratch, monkeypatch):
    """A part that is read is bounded by the text of the store, whatever the session joins, and cells come after the exchange."""
    monkeypatch.setattr("tideload.sources.cellstore.READ_BYTES", 1 << 14)
    store = FileCells(f"{scratch}/store")
    df = spark.range(0, 5000, 1, 4).selectExpr("id", "id * 2 AS v", "uuid() AS w")
    write_mutations(to_mutations(df, ["id"]), store, "first")
    write_mutations(to_mutations(df.where("id < 9"), ["id"], F.col("id") < 3), store, "second")
    read = store.read(spark)
    assert not [line for line in plan_of(read).splitlines() if "Exchange" in line and "qualifier" in line]
    assert read.rdd.getNumPartitions() > 20
    assert read.count() == 2 * 4997


@pytest.mark.parametrize("each_admission", [True, False])
def test_fact_delta_of_details_whose_heads_have_the_patient(spark, scratch, each_admission):
    """The same fact; details are exchanged once, by their head, to be marked and joined, and sums are never hashed."""
    rng = random.Random(5)
    details = [(h, d, rng.randrange(3), 1, rng.randrange(2), rng.choice([None, rng.randrange(90)])) for h in [*range(30), None] for d in range(3)]
    heads = [(h, rng.choice([None, *range(9)])) for h in [*range(28), 3, None]]
    stays = [(rng.choice([None, *range(8)]), rng.choice(["flu", "cold", "other", None])) for _ in range(12)]
    schema = "head int, detail int, service_id int, hospital_id int, doctor_id int, amount long"
    measures = {"m": F.col("amount") * 2, "n": F.when(F.col("amount") > 40, 1)}

    def given(rows_, admissions, apart):
        lines, tops = spark.createDataFrame(rows_, schema), spark.createDataFrame(heads, "head int, patient_id int")
        patients = spark.createDataFrame([(p,) for p in range(8)], "patient_id int")
        known = spark.createDataFrame([("flu",), ("cold",)], "diagnosis_id string")
        admitted = spark.createDataFrame(admissions, "patient_id int, diagnosis_id string")
        if apart:
            return HeadedInputs(lines, patients, admitted, known, tops, ["head"])
        return FactInputs(lines.join(tops, "head"), patients, admitted, known)

    now = [(*r[:5], None if r[5] is None else r[5] + 1) if r[1] == 1 else r for r in details if r[0] != 4] + [(6, 9, 1, 1, 1, 50)]
    changed = spark.createDataFrame([(h, d) for h in range(30) for d in (0, 1, 2) if d == 1 or h == 4] + [(6, 9), (6, 9)], "head int, detail int")
    moved = spark.createDataFrame([(p,) for p, _ in stays[:2]], "patient_id int")
    before, after = (details, stays), (now, stays[2:])
    want = rows(invoice_fact(*given(*after, False), measures, each_admission))
    setting = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {k: spark.conf.get(k) for k in setting}
    try:
        for key, value in setting.items():
            spark.conf.set(key, value)
        table = RangedTable(spark, f"{scratch}/fact", FACT_KEYS)
        state = fact_state(given(*before, True), measures, each_admission, by_range=True)
        table.create(state, placed=True, unique=True)
        whole = rows(fact_delta(given(*before, False), given(*after, False), ["head", "detail"], changed, moved, measures, each_admission))
        delta = fact_delta(given(*before, True), given(*after, True), ["head", "detail"], changed, moved, measures, each_admission, by_range=True)
        assert rows(delta) == whole
        assert merge_fact_delta(table, delta, "one", placed=True).written and merge_fact_delta(table, delta, "one", placed=True) is None
        with joins_by_some_keys(spark):
            plan = plan_of(delta.select("*"))
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
    assert rows(fact_of(table.read(), list(measures))) == want
    # Two for the distinct keys, none for the details.
    assert sum("hashpartitioning(head" in line and "detail" in line for line in plan.splitlines()) == 2
    assert not [line for line in [*plan.splitlines(), *plan_of(state).splitlines()] if "HashAggregate" in line and "sum(" in line and "_stays" in line and "n_rows" in line]
    assert "SortAggregate" in plan and "SortAggregate" in plan_of(state)


def test_small_numbers_in_one(spark):
    """Any value comes back, those that do not fit too."""
    from tideload.functions.numbers import Packed

    small = Packed("p", "loose", {"a": 2, "b": 7, "c": 54})
    values = [(True, 0, 0), (False, 126, 5), (None, None, None), (True, 127, 5), (True, -1, 5), (None, 3, (1 << 54) - 2), (None, 3, (1 << 54) - 1), (True, 1, (1 << 63) - 1), (False, -(1 << 63), -1)]
    df = spark.createDataFrame(values, "a boolean, b long, c long")
    packed = df.select("*", *small.pack({c: F.col(c) for c in "abc"}))
    assert [r[0] for r in packed.select(F.col("p").isNotNull() & F.col("loose").isNull()).collect()] == [True, True, True, False, False, True, False, False, False]
    assert packed.where(F.col("p").isNull() == F.col("loose").isNull()).count() == 0
    got = packed.select((small.unpack("a") == 1).alias("a"), small.unpack("b"), small.unpack("c"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(values, key=str)
    with pytest.raises(ValueError):
        Packed("p", "loose", {"a": 60, "b": 4})
