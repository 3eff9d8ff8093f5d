"""Change-file cycles that are killed after each step and run again."""

import os

import pytest
from conftest import rows

import tideload.plans.cycles as cycles_module
from tideload.plans.cycles import ChangeCycles
from tideload.plans.loads import LoadSpec, run_full, run_full_ranged
from tideload.sources.metadata import Field, TableMeta

META = TableMeta("t", (Field("k", "int", True), Field("v", "varchar", False)))
SPEC = LoadSpec.from_metadata(META)


def line(k, v, op="UPDATE", day="01"):
    return f"0,0,0,0,{op},1,2024-01-{day} 00:00:00,{k},{v}\n"


def deliver(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines(lines)


def csv_files(folder):
    return sorted(f for f in os.listdir(folder) if f.endswith(".csv") and not f.startswith(".")) if os.path.isdir(folder) else []


class Killed(Exception):
    pass


def kill_at(cycles, step, monkeypatch):
    """Let a cycle break off: before or after a step's effect."""
    when, name = step.split(" ")
    owner, name = {
        "rejects": (cycles_module, "write_counted"), "commit": (cycles, "_commit"), "archive": (cycles_module, "move_into"),
    }[name]
    real = getattr(owner, name)

    def broken(*args):
        if name == "move_into" and not args[1]:
            return real(*args)
        if when == "after":
            real(*args)
        raise Killed

    monkeypatch.setattr(owner, name, broken)


@pytest.mark.parametrize(
    ("step", "ranged"),
    [("after rejects", False), ("before commit", False), ("before commit", True), ("after commit", False), ("after commit", True),
     ("before archive", True), ("after archive", False)],
)
def test_killed_and_run_again(spark, scratch, monkeypatch, step, ranged):
    start = spark.createDataFrame([(1, "one"), (2, "two")], "k int, v string")
    (run_full_ranged if ranged else run_full)(SPEC, start, scratch)
    folder, archive = f"{scratch}/in", f"{scratch}/archive"
    deliver(folder, "a.csv", line(1, "new"), line("x", "bad"), line(3, "three", "INSERT"))
    cycles = ChangeCycles(spark, SPEC, META, scratch, ranged)
    with monkeypatch.context() as patch:
        kill_at(cycles, step, patch)
        with pytest.raises(Killed):
            cycles.run(folder, archive)
    deliver(folder, "b.csv", line(2, "", "DELETE", "02"), line("y", "bad"))
    ChangeCycles(spark, SPEC, META, scratch, ranged).run(folder, archive)
    cycles = ChangeCycles(spark, SPEC, META, scratch, ranged)
    assert cycles.run(folder, archive) == 0
    assert rows(cycles.table.read()) == [(1, "new"), (3, "three")]
    assert rows(cycles.rejects(), "k", "reason") == [("x", "malformed field"), ("y", "malformed field")]
    assert csv_files(folder) == [] and csv_files(archive) == ["a.csv", "b.csv"]
    committed = cycles.committed().collect()
    assert sum(r.files for r in committed) == sum(r.rejected for r in committed) == 2
    cycles.vacuum()
    assert cycles.rejects().count() == 2 and cycles.committed().count() == len(committed)


def test_a_file_that_comes_again_is_not_taken_for_the_old_one(spark, scratch, monkeypatch):
    """Delivered under the same name between a commit and its archiving."""
    run_full(SPEC, spark.createDataFrame([(1, "one")], "k int, v string"), scratch)
    folder, archive = f"{scratch}/in", f"{scratch}/archive"
    deliver(folder, "a.csv", line(1, "new"))
    cycles = ChangeCycles(spark, SPEC, META, scratch)
    with monkeypatch.context() as patch:
        kill_at(cycles, "before archive", patch)
        with pytest.raises(Killed):
            cycles.run(folder, archive)
    deliver(folder, "a.csv", line(5, "another row, longer", "INSERT").replace("another row, longer", "another"))
    assert cycles.run(folder, archive) == 1
    assert rows(cycles.table.read()) == [(1, "new"), (5, "another")] and csv_files(folder) == []


def test_a_full_load_between_keeps_the_ledger(spark, scratch):
    run_full(SPEC, spark.createDataFrame([(1, "one")], "k int, v string"), scratch)
    folder, archive = f"{scratch}/in", f"{scratch}/archive"
    cycles = ChangeCycles(spark, SPEC, META, scratch)
    assert cycles.run(folder, archive) == 0 and cycles.rejects().count() == 0 and cycles.finish(archive) == 0
    deliver(folder, "a.csv", line(1, "new"), line("x", "bad"))
    cycles.run(folder, archive)
    run_full(SPEC, spark.createDataFrame([(9, "nine")], "k int, v string"), scratch)
    assert cycles.committed().count() == 1 and cycles.rejects().count() == 1
    deliver(folder, "b.csv", line(9, "again"))
    assert cycles.run(folder, archive) == 1 and rows(cycles.table.read()) == [(9, "again")]
    assert [r.number for r in cycles.committed().orderBy("number").collect()] == [1, 2]
