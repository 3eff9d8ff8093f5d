"""Numbers and keys that last over runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.operators.merge import same_key
from tideload.operators.numbering import dense_number
from tideload.operators.publish import VersionedTable, write_counted

_BLOCKS = "sequence string, run_id string, first long, count long"


class Sequences:
    """Named counters, each a ledger of the blocks of numbers that runs have reserved.

    A block is reserved in one commit under its run's id. The same run gets the same block again, so
    a run that failed after it repeats its numbers; the next run goes on behind the last block.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.ledger = VersionedTable(spark, path)

    def blocks(self) -> DataFrame:
        return self.ledger.read() if self.ledger.exists() else self.spark.createDataFrame([], _BLOCKS)

    def reserve(self, sequence: str, run_id: str, count: int, start: int = 1) -> int:
        """The first number of the run's block of ``count``; ``start`` is the first of a new sequence."""
        blocks = self.blocks().where(F.col("sequence") == sequence)
        # One row at most.
        held = blocks.where(F.col("run_id") == run_id).collect()
        if held:
            if held[0]["count"] != count:
                raise ValueError(f"run {run_id} has {held[0]['count']} numbers of {sequence}, not {count}")
            return held[0]["first"]
        after = blocks.agg(F.max(F.col("first") + F.col("count"))).first()[0]
        first = start if after is None else after
        row = self.spark.createDataFrame([(sequence, run_id, first, count)], _BLOCKS)
        self.ledger.publish(self.blocks().unionByName(row).coalesce(1))
        return first

    def number(
        self, df: DataFrame, order_by: Sequence[str], sequence: str, run_id: str, name: str = "number", start: int = 1
    ) -> DataFrame:
        """Add the run's next numbers of a sequence in the order of ``order_by``, which must identify a row."""
        numbered = dense_number(df, order_by, name, 0)
        first = self.reserve(sequence, run_id, numbered.count(), start)
        return numbered.withColumn(name, F.col(name) + first)


class KeyMap:
    """Surrogate keys that stay: a map from natural keys to numbers to which each load adds its new keys.

    NULL is a key value like any other. The keys a load adds are written under its run's id and count
    once the map's ledger names them; a load that is repeated adds the same keys with the same numbers.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], name: str, start: int = 1):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.name = name
        self.start = start
        self.sequences = Sequences(spark, f"{self.path}/blocks")
        self.ledger = VersionedTable(spark, f"{self.path}/loads")

    def read(self) -> DataFrame | None:
        """Natural keys and their numbers; None before the first load."""
        if not self.ledger.exists():
            return None
        # One row per load.
        runs = [r.run_id for r in self.ledger.read().orderBy("number").collect()]
        return self.spark.read.parquet(*[self._folder(r) for r in runs])

    def add(self, rows: DataFrame, run_id: str, order_by: Sequence[str] | None = None) -> int:
        """Number the natural keys of ``rows`` that the map does not have, in the order of the keys; how many there were.

        ``order_by``: columns of ``rows`` that order the new keys first, each fixed by the key.
        """
        if self._has(run_id):
            return 0
        order = [*(order_by or []), *self.keys]
        new = rows.select(*dict.fromkeys([*self.keys, *order])).distinct()
        known = self.read()
        if known is not None:
            new = new.alias("l").join(known.alias("r"), same_key("l", "r", self.keys), "left_anti").select(*new.columns)
        numbered = self.sequences.number(new, list(dict.fromkeys(order)), self.name, run_id, self.name, self.start)
        count = write_counted(numbered.select(self.name, *self.keys), self._folder(run_id))
        loads = self.ledger.read() if self.ledger.exists() else self.spark.createDataFrame([], "run_id string, number long")
        row = self.spark.createDataFrame([(run_id, loads.count() + 1)], "run_id string, number long")
        self.ledger.publish(loads.unionByName(row).coalesce(1))
        return count

    def with_keys(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of their natural key in front; NULL for keys the map does not have."""
        known = self.read()
        if known is None:
            raise FileNotFoundError(f"no load has filled the map below {self.path}")
        joined = rows.alias("l").join(known.alias("r"), same_key("l", "r", self.keys), "left")
        return joined.select(f"r.{self.name}", *[f"l.{c}" for c in rows.columns])

    def _folder(self, run_id: str) -> str:
        return f"{self.path}/keys/run={run_id}"

    def _has(self, run_id: str) -> bool:
        return self.ledger.exists() and not self.ledger.read().where(F.col("run_id") == run_id).isEmpty()
