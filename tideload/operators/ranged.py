"""A keyed table in files by ranges of its key, of which a merge rewrites only those it touches.

A manifest names the files of a version and the lowest key of each. The lowest keys cut all keys into
ranges, one a file, so that every key, stored or not, has one file that holds it or would. A
merge finds the files of the changed keys, merges these alone, writes new files and commits a new
manifest; all other files stay, and readers keep theirs until they look again.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.files import folder_names, read_text, remove_folder, write_text
from tideload.operators.merge import OPERATION, TIMESTAMP, compact_changes, merge_changes, merge_latest
from tideload.operators.publish import VersionedTable
from tideload.session import staged, sums_in_order

# Names of this module's columns beside the caller's.
_SLICE = "_slice"
_BOUNDS = "_bounds"

# Numbers in a file that is added to by one task; file and delta are sorted there, 8 bytes a number.
ADDED_CELLS = 1 << 24
CODEC = "zstd"


@dataclass(frozen=True)
class Touched:
    """What a merge did: the files before it, those it read and replaced, and those it wrote."""

    files: int
    rewritten: int
    written: int


def interval_of(value: Column, bounds: Column, count: int) -> Column:
    """How many of the ascending ``bounds`` (an array of ``count``) are at most ``value``, by binary search."""
    steps = [1 << i for i in reversed(range(max(count, 1).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= value, at + step).otherwise(at),
    )


class RangedTable:
    """A table whose rows are known by ``keys``; NULL is a key value like any other, the lowest one.

    Number and size of the files: ``create`` makes a file per range partition of the session, a merge
    cuts files beyond ``file_rows`` rows. The manifest has a row per file. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], file_rows: int = 4_000_000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.file_rows = file_rows
        self.manifest = VersionedTable(spark, f"{self.path}/manifest")

    def exists(self) -> bool:
        return self.manifest.exists()

    def tag(self) -> str | None:
        return self.manifest.tag()

    def _schema(self) -> T.StructType:
        text = read_text(self.spark, f"{self.path}/schema.json")
        if text is None:
            raise FileNotFoundError(f"no table below {self.path}")
        return T.StructType.fromJson(json.loads(text))

    def _key(self) -> Column:
        return F.struct(*self.keys)

    def create(
        self, df: DataFrame, files: int | None = None, tag: str | None = None, placed: bool = False, unique: bool = False
    ) -> int:
        """Replace the table by ``df``, in ``files`` ranges of its key. A key it holds several times stays in one file.

        ``placed``: the partitions of ``df`` are ranges of the key already, and are not exchanged again.
        ``unique``: each key comes once, so a range may be cut into several files, of a size that :meth:`add` takes at once.
        """
        folder = self._new_folder()
        if placed:
            rows = df
        else:
            rows = df.repartitionByRange(files, *self.keys) if files else df.repartitionByRange(*self.keys)
        ordered = rows.sortWithinPartitions(*self.keys).withColumn(_SLICE, F.lit(0))
        most = self._added_rows(len(df.columns)) if unique else 0
        self._writer(ordered, most).partitionBy(_SLICE).parquet(f"{self.path}/data/{folder}")
        write_text(self.spark, f"{self.path}/schema.json", df.schema.json())
        return self.manifest.publish(self._files_in(folder, df.schema), tag)

    def read(self, version: int | None = None) -> DataFrame:
        names = [r.file for r in self.manifest.read(version).select("file").collect()]
        return self._read_files(names)

    def read_ranges_of(self, rows: DataFrame) -> DataFrame:
        """The rows of all files whose ranges hold a key of ``rows``."""
        return self._read_files([name for _, name in self._touched(rows)[1]])

    def rows(self, version: int | None = None) -> int:
        """The number of rows, from the manifest."""
        return self.manifest.read(version).agg(F.sum("rows")).first()[0] or 0

    def merge(
        self,
        changes: DataFrame,
        columns: Sequence[str] | None = None,
        op: str | None = OPERATION,
        ts: str = TIMESTAMP,
        tiebreak: Sequence[str] = (),
        unique_base: bool = True,
        tag: str | None = None,
    ) -> Touched:
        """Merge changes as ``merge_changes`` does (``op=None``: as ``merge_latest``) and commit the new manifest.

        ``unique_base``: the table holds each key once; any merge leaves it so in the files it writes.
        """
        schema = self._schema()
        columns = [f.name for f in schema.fields] if columns is None else list(columns)
        reduced = self._reduced(changes, columns, op, ts, tiebreak)
        manifest = self.manifest.read()
        count, found = self._touched(reduced)
        old, bounds = [name for _, name in found], self._bounds(manifest)
        base = self._read_files(old)
        options = {"unique_base": unique_base, "tiebreak": tiebreak, "ts": ts}
        merged = merge_changes(base, reduced, self.keys, columns, op, **options) if op else merge_latest(base, reduced, self.keys, columns, **options)
        placed = self._placed(self._sliced(merged, bounds, count).select(*[f.name for f in schema.fields], _SLICE))
        return self._replace(manifest, old, count, placed, tag)

    def add(self, delta: DataFrame, kept: str, tag: str | None = None, placed: bool = False) -> Touched:
        """Add the numbers of ``delta`` to those of the rows with the same keys and commit the new manifest.

        A key that is not stored is new; one whose ``kept`` comes down to 0 goes. The delta is written in
        ranges of the key (``placed``: its partitions are such ranges), and a task for each file takes that file and its
        part of the delta; stored rows are not exchanged. Only where a file gets more rows than one task should take
        (:data:`ADDED_CELLS`) are both exchanged by range, so that many tasks write them.
        """
        schema = self._schema()
        types = {f.name: f.dataType for f in schema.fields}
        most = self._added_rows(len(types))
        manifest = self.manifest.read()
        files = manifest.orderBy("lower").select("file", "rows").collect()
        path = f"{self.path}/delta/{self._new_folder()}"
        rows = delta.select(*types)
        ranges = rows if placed else rows.repartitionByRange(*self.keys)
        self._writer(ranges.sortWithinPartitions(*self.keys), most).parquet(path)

        def part(names: list[str]) -> DataFrame:
            return self.spark.read.schema(delta.select(*types).schema).parquet(*[f"{path}/{n}" for n in names])

        def summed(df: DataFrame, *by: str) -> DataFrame:
            first, *others = [F.sum(v).cast(types[v]) for v in types if v not in self.keys]
            named = zip([v for v in types if v not in self.keys], [sums_in_order(first), *others], strict=True)
            sums = df.groupBy(*by, *self.keys).agg(*[value.alias(v) for v, value in named])
            return sums.where(F.col(kept) > 0).select(*types, *by).sortWithinPartitions(*by, *self.keys)

        # A row per file of the table and file of the delta that meet; both lie by range.
        found, counts = defaultdict(list), defaultdict(int)
        at = self._sliced(self.spark.read.schema(schema).parquet(path).select(*self.keys, "_metadata.file_name"), self._bounds(manifest), len(files))
        for number, name, n in at.groupBy(_SLICE, "file_name").count().collect():
            found[number].append(name)
            counts[number] += n
        wide = [i for i in found if not i or counts[i] + files[i - 1].rows > 2 * most]
        folder, exchanged = self._new_folder(), self._new_folder()

        def add_to(i: int) -> None:
            key, of = self._key(), lambda n: manifest.where(F.col("file") == files[n - 1].file).select("lower").scalar()
            own = part(found[i])
            if i > 1:
                own = own.where(key >= of(i))
            if i < len(files):
                own = own.where(key < of(i + 1))
            one = self._read_files([files[i - 1].file]).unionByName(own).coalesce(1)
            self._writer(summed(one), most).parquet(f"{self.path}/data/{folder}/{_SLICE}={i}")

        with ThreadPoolExecutor(max_workers=max(1, self.spark.sparkContext.defaultParallelism)) as pool:
            list(pool.map(add_to, sorted(set(found) - set(wide))))
        new = []
        if len(found) > len(wide):
            new.append(self._files_in(folder, schema))
        if wide:
            stored = self._read_files([files[i - 1].file for i in wide if i])
            more = part(sorted({n for i in wide for n in found[i]}))
            both = self._sliced(stored.unionByName(more), self._bounds(manifest), len(files))
            # Files of the delta reach into neighbouring ranges.
            placed_rows = self._placed(both.where(F.col(_SLICE).isin(wide)), ordered=False)
            self._writer(summed(placed_rows, _SLICE), most).partitionBy(_SLICE).parquet(f"{self.path}/data/{exchanged}")
            new.append(self._files_in(exchanged, schema))
        done = self._commit(manifest, [files[i - 1].file for i in sorted(found) if i], len(files), new or [manifest.limit(0)], tag)
        remove_folder(self.spark, path)
        return done

    def _added_rows(self, columns: int) -> int:
        """Rows of a file that a task takes together with as many rows of a delta."""
        return max(1, min(self.file_rows, ADDED_CELLS // columns))

    def _writer(self, df: DataFrame, most: int) -> DataFrameWriter:
        """Compressed files of at most ``most`` rows (0: any number)."""
        return df.write.option("compression", CODEC).option("maxRecordsPerFile", most)

    def _placed(self, rows: DataFrame, ordered: bool = True) -> DataFrame:
        """By range, so that many new rows of one file are written by many tasks."""
        order = [_SLICE, *self.keys]
        placed = rows.repartitionByRange(*order)
        return placed.sortWithinPartitions(*order) if ordered else placed

    def _replace(self, manifest: DataFrame, old: list[str], count: int, placed: DataFrame, tag: str | None) -> Touched:
        """Write new files and commit a manifest that names them in place of ``old``."""
        folder, schema = self._new_folder(), self._schema()
        self._writer(placed, self.file_rows).partitionBy(_SLICE).parquet(f"{self.path}/data/{folder}")
        return self._commit(manifest, old, count, [self._files_in(folder, schema)], tag)

    def _commit(self, manifest: DataFrame, old: list[str], count: int, written: list[DataFrame], tag: str | None) -> Touched:
        """Commit a manifest that names the ``written`` files in place of ``old``."""
        new = staged(reduce(DataFrame.unionByName, written), "manifest")
        replaced = self.spark.createDataFrame([(f,) for f in old], "file string")
        self.manifest.publish(manifest.join(replaced, "file", "left_anti").unionByName(new), tag)
        return Touched(count, len(old), new.count())

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` manifests and the folders none of them names."""
        self.manifest.vacuum(keep)
        named: set[str] = set()
        for version in self.manifest.versions():
            named |= {r[0] for r in self.manifest.read(version).select(F.substring_index("file", "/", 1)).distinct().collect()}
        for folder in folder_names(self.spark, f"{self.path}/data"):
            if folder not in named:
                remove_folder(self.spark, f"{self.path}/data/{folder}")

    def _reduced(self, changes: DataFrame, columns: list[str], op: str | None, ts: str, tiebreak: Sequence[str]) -> DataFrame:
        """The newest change per key, written once since several jobs read it."""
        newest = compact_changes(changes, self.keys, columns, op, ts, tiebreak)
        extra = [t for t in tiebreak if t not in columns]
        have = [F.col("_op").alias(op)] if op else []
        if ts not in columns:
            have.append(F.col("_ts").alias(ts))
        return staged(newest.select(*columns, *have, *extra), "changes")

    def _bounds(self, manifest: DataFrame) -> Column:
        """The lowest keys of all files, ascending, as a scalar: a key per file."""
        return manifest.agg(F.array_sort(F.collect_list("lower"))).scalar()

    def _touched(self, rows: DataFrame) -> tuple[int, list[tuple[int, str]]]:
        """The number of files, and number and name of those whose ranges hold a key of ``rows``."""
        manifest = self.manifest.read()
        # One row per file.
        files = [r.file for r in manifest.orderBy("lower").select("file").collect()]
        sliced = self._sliced(rows.select(*self.keys), self._bounds(manifest), len(files))
        numbers = sorted(r[0] for r in sliced.select(_SLICE).distinct().collect())
        return len(files), [(i, files[i - 1]) for i in numbers if i]

    def _sliced(self, rows: DataFrame, bounds: Column, files: int) -> DataFrame:
        """Rows with the number of the file whose range has their key: 0 without files, else from 1."""
        if not files:
            return rows.withColumn(_SLICE, F.lit(0))
        with_bounds = rows.withColumn(_BOUNDS, bounds)
        at = interval_of(self._key(), F.col(_BOUNDS), files)
        return with_bounds.withColumn(_SLICE, F.greatest(at, F.lit(1))).drop(_BOUNDS)

    def _new_folder(self) -> str:
        return uuid.uuid4().hex

    def _read_files(self, names: list[str]) -> DataFrame:
        schema = self._schema()
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{n}" for n in names])

    def _files_in(self, folder: str, schema: T.StructType) -> DataFrame:
        """Manifest rows of the files of a folder; reads their keys alone.

        Files are written in key order, so the first row has the lowest key; it is an error if any row has a lower one.
        The lowest of structs would sort all rows by file.
        """
        place = F.concat(F.lit(f"{folder}/{_SLICE}="), F.col(_SLICE).cast("string"), F.lit("/"), F.col("_metadata.file_name"))
        named = T.StructType([*schema.fields, T.StructField(_SLICE, T.IntegerType())])
        rows = self.spark.read.schema(named).parquet(f"{self.path}/data/{folder}")
        keyed = rows.select(place.alias("file"), self._key().alias("_key"), F.col("_metadata.row_index").alias("_at"))
        first = F.broadcast(keyed.where(F.col("_at") == 0).select("file", F.col("_key").alias("lower")))  # a row per file
        counts = keyed.join(first, "file").groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_key") < F.col("lower")).alias("_lower"))
        unsorted = F.raise_error(F.concat(F.lit("not in key order: "), F.col("file")))
        lower = F.when(F.col("_lower") == 0, F.col("lower")).otherwise(unsorted)
        return counts.join(first, "file").select("file", lower.alias("lower"), "rows")
