"""Cycles over a table's change files that can break off anywhere and be run again.

A cycle has an id. It writes under that id what it is about to consume and what it rejects, then
commits the merged table with the id as the tag of the version, and then archives. The commit decides: the
next run finds the tag of the newest version and first archives what that cycle consumed, and rejects
and lists of cycles that never committed count for nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.files import data_files, file_marks, folder_names, move_into, remove_folder
from tideload.operators.publish import VersionedTable, write_counted
from tideload.operators.ranged import RangedTable
from tideload.plans.loads import LoadSpec
from tideload.session import staged
from tideload.sources.delimited import (
    change_required,
    change_struct,
    change_text_struct,
    read_text_snapshot,
    reject_reason,
    type_columns,
    with_bad_row,
)
from tideload.sources.metadata import TableMeta

_CONSUMED = "file string, bytes long, changed long"
_CYCLES = "cycle string, number long, files long, rejected long"


class ChangeCycles:
    """The change-file cycles of one table below ``root``.

    ``ranged``: the table is a :class:`RangedTable`, of which a cycle rewrites the files it touches;
    otherwise it is a :class:`VersionedTable`, written whole.
    """

    def __init__(
        self, spark: SparkSession, spec: LoadSpec, meta: TableMeta, root: str, ranged: bool = False, rejects: str | None = None
    ):
        self.spark, self.spec, self.meta = spark, spec, meta
        path = f"{root.rstrip('/')}/{spec.table}"
        self.table = RangedTable(spark, path, spec.keys) if ranged else VersionedTable(spark, path)
        self.notes = f"{path}/_cycles"
        self.reject_folder = rejects or f"{path}/_rejects"

    def run(self, folder: str, archive: str) -> int:
        """Finish what the last cycle left, then consume the files that are there; returns their number.

        Files that arrive meanwhile wait for the next cycle.
        """
        self.finish(archive)
        marks = file_marks(self.spark, data_files(self.spark, folder))
        if not marks:
            return 0
        cycle, before = uuid.uuid4().hex, self.committed()
        consumed = self.spark.createDataFrame(marks, _CONSUMED).coalesce(1)
        # Parsed once: good and bad rows are taken from what is written here.
        text = read_text_snapshot(self.spark, [m[0] for m in marks], change_text_struct(self.meta))
        reason = reject_reason(change_struct(self.meta), change_required(self.meta))
        parsed = staged(text.withColumn("reason", reason), "changes")
        rejected = parsed.where("reason IS NOT NULL")
        count = write_counted(rejected, self._rejects_of(cycle))
        consumed.write.parquet(f"{self.notes}/{cycle}/consumed")
        numbers = self.spark.createDataFrame([(cycle, before.count() + 1, len(marks), count)], _CYCLES)
        before.unionByName(numbers).coalesce(1).write.parquet(f"{self.notes}/{cycle}/cycles")
        good = type_columns(parsed.where("reason IS NULL").drop("reason"), change_struct(self.meta))
        self._commit(good, cycle)
        self.finish(archive)
        return len(marks)

    def finish(self, archive: str) -> int:
        """Move to the archive what the last committed cycle consumed and is still there, unchanged."""
        cycle = self.table.tag()
        if cycle is None:
            return 0
        # One row per file of a cycle.
        listed = {tuple(r) for r in self.spark.read.parquet(f"{self.notes}/{cycle}/consumed").collect()}
        left = [m[0] for m in file_marks(self.spark, [r[0] for r in listed]) if m in listed]
        move_into(self.spark, left, archive)
        return len(left)

    def committed(self) -> DataFrame:
        """The cycles whose version has been committed, with their number, files and rejected rows."""
        cycle = self.table.tag()
        if cycle is None:
            return self.spark.createDataFrame([], _CYCLES)
        return self.spark.read.schema(_CYCLES).parquet(f"{self.notes}/{cycle}/cycles")

    def rejects(self) -> DataFrame:
        """The rows, as text with a ``reason`` and their ``cycle``, that committed cycles could not apply."""
        # One row per cycle.
        cycles = [r.cycle for r in self.committed().where("rejected > 0").orderBy("number").collect()]
        schema = with_bad_row(change_text_struct(self.meta)).add("reason", "string")
        if not cycles:
            return self.spark.createDataFrame([], schema).withColumn("cycle", F.lit(""))
        rows = self.spark.read.schema(schema).parquet(*[self._rejects_of(c) for c in cycles])
        parts = F.split(F.col("_metadata.file_path"), "/")
        return rows.withColumn("cycle", F.replace(F.element_at(parts, -2), F.lit("cycle="), F.lit("")))

    def vacuum(self) -> None:
        """Remove the rejects of cycles that never committed, and all notes but those of the last one that did."""
        known = {r.cycle for r in self.committed().collect()}
        for name in folder_names(self.spark, self.reject_folder):
            if name.removeprefix("cycle=") not in known:
                remove_folder(self.spark, f"{self.reject_folder}/{name}")
        for cycle in folder_names(self.spark, self.notes):
            if cycle != self.table.tag():
                remove_folder(self.spark, f"{self.notes}/{cycle}")

    def _rejects_of(self, cycle: str) -> str:
        return f"{self.reject_folder}/cycle={cycle}"

    def _commit(self, changes: DataFrame, cycle: str) -> None:
        spec = self.spec
        if isinstance(self.table, RangedTable):
            self.table.merge(changes, spec.columns, spec.op, spec.ts, spec.tiebreak, tag=cycle)
        else:
            self.table.publish(spec.merged(self.table.read(), changes), tag=cycle)


def run_change_files(
    spark: SparkSession, spec: LoadSpec, meta: TableMeta, folder: str, archive: str, root: str, rejects: str | None = None
) -> int:
    """One cycle of a table's change files: merge those that are there, then move them to the archive.

    Returns the number of files; nothing happens without files. ``rejects``: where rows that can't be
    applied go, below a folder per cycle; :meth:`ChangeCycles.rejects` reads those that count.
    """
    return ChangeCycles(spark, spec, meta, root, rejects=rejects).run(folder, archive)
