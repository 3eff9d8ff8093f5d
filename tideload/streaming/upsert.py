"""Continuous upsert into a keyed table.

The table is a base state plus one folder of reduced changes per micro-batch, so a
batch writes its own rows and never rewrites the table. Readers merge the folders
into the base; ``compact`` does that once and for all from time to time.

Every stored row keeps its operation and order columns. A change that arrives late
therefore loses against a newer stored row, and a delete is remembered until its
tombstone is dropped by ``compact``.

A batch is known by its source (the id of the streaming query, which its checkpoint keeps)
and its number. The same batch again replaces its own folder; a stream with a new checkpoint
is a new source, whose batches neither hide nor replace those of another one. What a base
covers is stored beside it, so a batch replayed after ``compact`` is known too.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideload.files import complete_folders, remove_folder
from tideload.operators.merge import DELETE, INSERT, OPERATION, TIMESTAMP, compact_changes, merge_latest, stored_since
from tideload.streaming.levelled import LevelledTable

_BASE = re.compile(r"^upto=(-?\d+)$")
# Place in the log, number within the source, source.
_BATCH = re.compile(r"^place=(\d+)-(\d+)-([0-9A-Za-z-]+)$")
_COVERED = "source string, batch long"
DIRECT = "direct"


class UpsertTable:
    """A keyed table that a change stream is applied to. One stream writes it at a time."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        columns: Sequence[str],
        op: str = OPERATION,
        ts: str = TIMESTAMP,
        tiebreak: Sequence[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.columns = list(columns)
        self.op = op
        self.ts = ts
        self.tiebreak = list(tiebreak)
        self._order = [t for t in self.tiebreak if t not in self.columns]

    def seed(self, base: DataFrame, sample_change: DataFrame) -> None:
        """Store the first state. ``sample_change`` gives the types of the order columns."""
        types = dict(sample_change.dtypes)
        state = base.select(
            *self.columns,
            F.lit(INSERT).alias("state_op"),
            stored_since().alias("state_age"),
            stored_since().alias("state_ts"),
            *[F.lit(None).cast(types[t]).alias(t) for t in self._order],
        )
        state.write.mode("overwrite").parquet(f"{self.path}/base/upto=-1")

    def apply_batch(self, changes: DataFrame, batch_id: int, source: str = DIRECT) -> None:
        """Store one micro-batch. A replayed batch replaces its own folder, so nothing counts twice."""
        if not re.fullmatch("[0-9A-Za-z-]+", source):
            raise ValueError(f"{source!r} can't name a source")
        base = self._base_version()
        if batch_id <= self._covered(base).get(source, -1):
            return
        log = self._log()
        known = next((place for place, (number, name) in log.items() if (number, name) == (batch_id, source)), None)
        place = known if known is not None else max([base, *log]) + 1
        newest = compact_changes(changes, self.keys, self.columns, self.op, self.ts, self.tiebreak)
        state = newest.select(
            *self.columns,
            F.col("_op").alias("state_op"),
            F.col("_age").alias("state_age"),
            F.col("_ts").alias("state_ts"),
            *self._order,
        )
        state.write.mode("overwrite").parquet(f"{self.path}/log/{self._folder(place, batch_id, source)}")

    def state(self) -> DataFrame:
        """The newest row per key, tombstones included."""
        return self._state(self._pending())

    def read(self) -> DataFrame:
        """The table as readers see it."""
        return self.state().where(F.col("state_op") != DELETE).select(*self.columns)

    def compact(self, forget_before: str | None = None) -> None:
        """Fold the stored batches into a new base.

        Tombstones older than ``forget_before`` are dropped; a still older change of such
        a key would come back as a row, so choose it beyond the longest delay.
        """
        pending = self._pending()
        if not pending:
            return
        state = self._state(pending)
        if forget_before is not None:
            horizon = F.lit(forget_before).cast("timestamp_ntz")
            state = state.where((F.col("state_op") != DELETE) | (F.col("state_age") >= horizon))
        covered = self._covered(self._base_version())
        log = self._log()
        for place in pending:
            number, source = log[place]
            covered[source] = max(number, covered.get(source, -1))
        # One row per source. Written first: it counts once the base of the same name exists.
        rows = self.spark.createDataFrame(sorted(covered.items()), _COVERED)
        rows.write.mode("overwrite").parquet(f"{self.path}/covered/upto={pending[-1]}")
        # Readers switch when this job commits; the folders it covers are then unused.
        state.write.mode("overwrite").parquet(f"{self.path}/base/upto={pending[-1]}")

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the newest ``keep`` bases, and the batches that all kept ones cover.

        A reader that began before the last compaction needs the base before it: keep 2 then.
        """
        versions = self._versions()
        oldest = versions[-keep:][0]
        for version in versions:
            if version < oldest:
                remove_folder(self.spark, f"{self.path}/base/upto={version}")
                remove_folder(self.spark, f"{self.path}/covered/upto={version}")
        for place, (number, source) in self._log().items():
            if place <= oldest:
                remove_folder(self.spark, f"{self.path}/log/{self._folder(place, number, source)}")

    @staticmethod
    def _folder(place: int, number: int, source: str) -> str:
        return f"place={place}-{number}-{source}"

    def _log(self) -> dict[int, tuple[int, str]]:
        """Place in the log -> number and source of the stored batches, in order."""
        found = [_BATCH.match(n) for n in complete_folders(self.spark, f"{self.path}/log")]
        return {int(m[1]): (int(m[2]), m[3]) for m in sorted((m for m in found if m), key=lambda m: int(m[1]))}

    def _versions(self) -> list[int]:
        found = [_BASE.match(n) for n in complete_folders(self.spark, f"{self.path}/base")]
        return sorted(int(m[1]) for m in found if m)

    def _base_version(self) -> int:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"seed the table below {self.path} first")
        return versions[-1]

    def _covered(self, version: int) -> dict[str, int]:
        """The last batch of each source that a base holds; the first base holds none."""
        if version < 0:
            return {}
        rows = self.spark.read.schema(_COVERED).parquet(f"{self.path}/covered/upto={version}").collect()
        return {r.source: r.batch for r in rows}

    def _pending(self) -> list[int]:
        current = self._base_version()
        return [place for place in self._log() if place > current]

    def _state(self, places: Sequence[int]) -> DataFrame:
        base = self.spark.read.parquet(f"{self.path}/base/upto={self._base_version()}")
        if not places:
            return base
        log = self._log()
        paths = [f"{self.path}/log/{self._folder(p, *log[p])}" for p in places]
        log = self.spark.read.schema(base.schema).parquet(*paths)
        order = [*self.tiebreak, "state_ts"]
        return merge_latest(base, log, self.keys, base.columns, "state_age", order).select(*base.columns)


def source_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that a checkpoint folder belongs to."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def start_upsert(
    changes: DataFrame, table: UpsertTable | LevelledTable, checkpoint: str, compact_every: int | None = None, **trigger
) -> StreamingQuery:
    """Apply a stream of change rows; takes what is there and ends unless a trigger is given.

    ``compact_every``: compact the table whenever so many batches wait for it, and
    remove what neither its newest state nor the one before it needs.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.apply_batch(batch, batch_id, source_of(table.spark, checkpoint))
        if compact_every and len(table._pending()) >= compact_every:
            table.compact()
            table.vacuum(keep=2)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
