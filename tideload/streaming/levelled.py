"""Keyed state of a change stream as levelled runs.

A run holds one row per key, tombstones included. Micro-batches add small runs to level 0; a
compaction folds them into the one run of level 1, a run that has outgrown its level into the one of
the next, and so on down to the base, which is rewritten once the level above it holds a fair share of
its rows, and not before. Runs from level 1 on are bucketed and sorted by key: they are joined
where they lie, so neither a read nor a compaction moves the base.

A manifest names the runs, and what each source has had applied; its commit switches readers. A batch
is known by its source and number, and counts once however often it is replayed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.files import folder_names, read_text, remove_folder, write_text
from tideload.operators.latest import latest_per_key
from tideload.operators.merge import DELETE, INSERT, OPERATION, TIMESTAMP, compact_changes, stored_since
from tideload.operators.publish import VersionedTable, drop_table, save_table, write_counted

_MANIFEST = "kind string, level int, name string, source string, batch long, rows long"
DIRECT = "direct"
# The level of the base: below all others.
BASE = 1 << 20


@dataclass(frozen=True)
class Run:
    """A run: the smaller its level, the newer its rows."""

    level: int
    name: str
    rows: int
    source: str | None = None
    batch: int | None = None


class LevelledTable:
    """A keyed table that a change stream is applied to. One stream writes it at a time; no part of a key is NULL.

    ``database`` holds the bucketed runs as tables over folders below ``path``; where its catalog does not
    outlive the session they are registered again. ``buckets``, ``keys`` and ``columns`` are for good.
    ``fanout``: a level holds that many times the rows of the one above, and level 1 ``first_rows``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        database: str,
        keys: Sequence[str],
        columns: Sequence[str],
        op: str = OPERATION,
        ts: str = TIMESTAMP,
        tiebreak: Sequence[str] = (),
        buckets: int = 64,
        fanout: int = 8,
        first_rows: int = 1_000_000,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.database = database
        self.keys, self.columns, self.tiebreak = list(keys), list(columns), list(tiebreak)
        self.op, self.ts = op, ts
        self.buckets, self.fanout, self.first_rows = buckets, fanout, first_rows
        self.manifest = VersionedTable(spark, f"{self.path}/manifest")
        self._order = [t for t in self.tiebreak if t not in self.columns]
        self._newest = ["state_age", *self.tiebreak, "state_ts"]
        self._state_columns = ["state_op", "state_age", "state_ts", *self._order]

    def seed(self, base: DataFrame, sample_change: DataFrame) -> None:
        """Store the first state; its keys are unique. ``sample_change`` gives the types of the order columns."""
        types = dict(sample_change.dtypes)
        state = base.select(
            *self.columns,
            F.lit(INSERT).alias("state_op"),
            stored_since().alias("state_age"),
            stored_since().alias("state_ts"),
            *[F.lit(None).cast(types[t]).alias(t) for t in self._order],
        )
        write_text(self.spark, f"{self.path}/schema.json", state.schema.json())
        self._commit([self._bucketed(self._checked(state), BASE, placed=False)], {})

    def apply_batch(self, changes: DataFrame, batch_id: int, source: str = DIRECT) -> None:
        """Store one micro-batch as a run of level 0; one that the manifest knows is left out."""
        if not re.fullmatch("[0-9A-Za-z-]+", source):
            raise ValueError(f"{source!r} can't name a source")
        runs, covered = self._state_of_manifest()
        if batch_id <= covered.get(source, -1) or any((r.source, r.batch) == (source, batch_id) for r in runs):
            return
        newest = compact_changes(changes, self.keys, self.columns, self.op, self.ts, self.tiebreak)
        state = newest.select(
            *self.columns,
            F.col("_op").alias("state_op"),
            F.col("_age").alias("state_age"),
            F.col("_ts").alias("state_ts"),
            *self._order,
        )
        name = uuid.uuid4().hex
        rows = write_counted(self._checked(state), f"{self.path}/runs/{name}")
        self._commit([*runs, Run(0, name, rows, source, batch_id)], covered)

    def state(self) -> DataFrame:
        """The newest row per key, tombstones included."""
        return self._merged(self._state_of_manifest()[0])

    def read(self) -> DataFrame:
        """The table as readers see it."""
        return self.state().where(F.col("state_op") != DELETE).select(*self.columns)

    def lookup(self, keys: Sequence[object]) -> DataFrame:
        """The rows of a few values of the one key column: buckets and sorted files without them are not read."""
        (key,) = self.keys
        wanted = self._merged(self._state_of_manifest()[0], F.col(key).isin(list(keys)))
        return wanted.where(F.col("state_op") != DELETE).select(*self.columns)

    def compact(self, forget_before: str | None = None) -> list[int]:
        """Fold level 0 into the levels below as far as they have outgrown their size; the levels that were rewritten.

        Where that reaches the base, tombstones older than ``forget_before`` are dropped; a still older
        change of such a key would come back as a row, so choose it beyond the longest delay.
        """
        runs, covered = self._state_of_manifest()
        new = [r for r in runs if r.level == 0]
        if not new:
            return []
        base = next(r for r in runs if r.level == BASE)
        by_level = {r.level: r for r in runs if r.level}
        taken, level = list(new), 1
        while True:
            if level in by_level:
                taken.append(by_level[level])
            rows = sum(r.rows for r in taken)
            if rows * self.fanout >= base.rows:
                # All that lies above the base goes into it.
                taken = [r for r in runs if r.level != BASE] + [base]
                level = BASE
            if level == BASE or rows <= self.first_rows * self.fanout ** (level - 1):
                break
            level += 1
        state = self._merged(taken)
        if level == BASE and forget_before is not None:
            horizon = F.lit(forget_before).cast("timestamp_ntz")
            state = state.where((F.col("state_op") != DELETE) | (F.col("state_age") >= horizon))
        run = self._bucketed(state, level, placed=True)
        for r in new:
            covered[r.source] = max(r.batch, covered.get(r.source, -1))
        self._commit([*[r for r in runs if r not in taken], run], covered)
        return sorted({r.level for r in taken if r.level} | {level})

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the newest ``keep`` manifests, and the runs none of them names.

        A reader that began before the last commit needs the manifest before it: keep 2 then.
        """
        self.manifest.vacuum(keep)
        named = {r.name for v in self.manifest.versions() for r in self.manifest.read(v).where("kind = 'run'").collect()}
        for name in folder_names(self.spark, f"{self.path}/runs"):
            if name not in named:
                drop_table(self.spark, self._table(name))
                remove_folder(self.spark, f"{self.path}/runs/{name}")

    def runs(self) -> list[Run]:
        """The runs of the newest manifest, newest rows first."""
        return self._state_of_manifest()[0]

    def _pending(self) -> list[Run]:
        return [r for r in self.runs() if r.level == 0]

    def _state_of_manifest(self) -> tuple[list[Run], dict[str, int]]:
        if not self.manifest.exists():
            raise FileNotFoundError(f"seed the table below {self.path} first")
        # A few rows per level, and one per source.
        rows = self.manifest.read().collect()
        runs = [Run(r.level, r.name, r.rows, r.source, r.batch) for r in rows if r.kind == "run"]
        return sorted(runs, key=lambda r: r.level), {r.source: r.batch for r in rows if r.kind == "covered"}

    def _commit(self, runs: Sequence[Run], covered: dict[str, int]) -> None:
        rows = [("run", r.level, r.name, r.source, r.batch, r.rows) for r in runs]
        rows += [("covered", None, None, source, batch, None) for source, batch in covered.items()]
        self.manifest.publish(self.spark.createDataFrame(rows, _MANIFEST).coalesce(1))

    def _table(self, name: str) -> str:
        return f"{self.database}.run_{name}"

    def _bucketed(self, state: DataFrame, level: int, placed: bool) -> Run:
        """Write a run by bucket, without an exchange where a join has ``placed`` its rows."""
        name = uuid.uuid4().hex
        save_table(state, self._table(name), self.keys, self.buckets, placed=placed, location=f"{self.path}/runs/{name}")
        return Run(level, name, self.spark.table(self._table(name)).count())

    def _read(self, run: Run) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/schema.json")))
        if not run.level:
            return self.spark.read.schema(schema).parquet(f"{self.path}/runs/{run.name}")
        if not self.spark.catalog.tableExists(self._table(run.name)):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE {self._table(run.name)} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/runs/{run.name}'"
            )
        return self.spark.table(self._table(run.name)).select(*schema.names)

    def _merged(self, runs: Sequence[Run], where: Column | None = None) -> DataFrame:
        """The newest row per key of some runs: level 0 ranked, then joined level by level.

        What lies above a level is dealt to its buckets, whatever the session's number of partitions, so
        that the level itself stays where it is.
        """

        def rows_of(run: Run) -> DataFrame:
            return self._read(run) if where is None else self._read(run).where(where)

        found: DataFrame | None = None
        batches = [rows_of(r) for r in runs if r.level == 0]
        if batches:
            newest_first = [F.col(c).desc_nulls_last() for c in self._newest] + [F.xxhash64(*self.columns).desc()]
            found = latest_per_key(self._dealt(reduce(DataFrame.unionByName, batches)), self.keys, newest_first)
        for run in sorted((r for r in runs if r.level), key=lambda r: r.level):
            found = rows_of(run) if found is None else self._over(rows_of(run), self._dealt(found))
        return found.select(*self.columns, *self._state_columns)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *self.keys)

    def _over(self, stored: DataFrame, newer: DataFrame) -> DataFrame:
        """The newer row of each key of two runs; at equal order that of the newer run."""
        equal = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in self.keys])
        joined = stored.alias("l").join(newer.alias("r"), equal, "full")
        late = F.struct(*[f"l.{c}" for c in self._newest]) > F.struct(*[f"r.{c}" for c in self._newest])
        take = F.col("r.state_op").isNotNull() & (F.col("l.state_op").isNull() | ~late)
        columns = [*self.columns, *self._state_columns]
        return joined.select(*[F.when(take, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c) for c in columns])

    def _checked(self, state: DataFrame) -> DataFrame:
        """Refuse rows without a whole key: readers of change files reject them before."""
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        error = F.raise_error(F.lit(f"a row has no whole key ({', '.join(self.keys)})"))
        return state.withColumn("state_op", F.when(whole, F.col("state_op")).otherwise(error))
