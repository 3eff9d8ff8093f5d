"""Full and incremental loads of many tables, driven by their metadata."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.operators.audit import record_counts
from tideload.operators.merge import OPERATION, TIMESTAMP, merge_changes, merge_latest
from tideload.operators.publish import VersionedTable
from tideload.operators.ranged import RangedTable
from tideload.sources.extract import Reader
from tideload.sources.metadata import TableMeta, table_metas


@dataclass(frozen=True)
class LoadSpec:
    """How one table is loaded. Without an operation column, changes are whole newer rows."""

    table: str
    keys: Sequence[str]
    columns: Sequence[str]
    op: str | None = OPERATION
    ts: str = TIMESTAMP
    tiebreak: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"table {self.table} has no key; only full loads are possible without one")

    @classmethod
    def from_metadata(cls, meta: TableMeta, **options) -> LoadSpec:
        return cls(meta.table, meta.keys, [*meta.keys, *meta.others], **options)

    def merged(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        if self.op:
            return merge_changes(base, changes, self.keys, self.columns, self.op, self.ts, self.tiebreak)
        return merge_latest(base, changes, self.keys, self.columns, self.ts, self.tiebreak)


def run_full(spec: LoadSpec, source: DataFrame, root: str) -> DataFrame:
    """Publish the source's columns as a new version; returns the published table."""
    target = VersionedTable(source.sparkSession, f"{root}/{spec.table}")
    return target.read(target.publish(source.select(*spec.columns)))


def run_incremental(spec: LoadSpec, changes: DataFrame, root: str) -> DataFrame:
    """Publish the table with the changes merged in; returns the published table."""
    target = VersionedTable(changes.sparkSession, f"{root}/{spec.table}")
    return target.read(target.publish(spec.merged(target.read(), changes)))


def run_full_ranged(spec: LoadSpec, source: DataFrame, root: str) -> DataFrame:
    """Write the source's columns as a table in files by key range; returns the table."""
    target = RangedTable(source.sparkSession, f"{root}/{spec.table}", spec.keys)
    return target.read(target.create(source.select(*spec.columns)))


def run_incremental_ranged(spec: LoadSpec, changes: DataFrame, root: str) -> DataFrame:
    """Merge changes into a table in files by key range, rewriting the files they touch; returns the table."""
    target = RangedTable(changes.sparkSession, f"{root}/{spec.table}", spec.keys)
    target.merge(changes, spec.columns, spec.op, spec.ts, spec.tiebreak)
    return target.read()


def _published_rows(spec: LoadSpec, published: DataFrame, root: str) -> int:
    """The number of rows of a published table, as counted when they were written."""
    spark = published.sparkSession
    for table in (RangedTable(spark, f"{root}/{spec.table}", spec.keys), VersionedTable(spark, f"{root}/{spec.table}")):
        if table.exists():
            return table.rows()
    return published.count()


def run_all(
    spark: SparkSession,
    specs: Sequence[LoadSpec],
    step: Callable[[LoadSpec, DataFrame, str], DataFrame],
    inputs: Mapping[str, DataFrame],
    root: str,
    audit_path: str,
    workers: int = 4,
) -> DataFrame:
    """Run a full or incremental step for every table that has an input, then audit.

    Several tables load at a time, so that small ones do not leave the cluster idle. The audit takes
    the counts made while the tables were written. Returns the audit rows of this run.
    """
    due = [s for s in specs if s.table in inputs]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        published = list(pool.map(lambda s: step(s, inputs[s.table], root), due))
    counts = [(s.table, _published_rows(s, df, root)) for s, df in zip(due, published, strict=True)]
    rows = spark.createDataFrame(counts, "tablename string, count long")
    rows = rows.withColumn("run_time", F.current_timestamp().cast("timestamp_ntz"))
    record_counts(rows, audit_path)
    return rows


def load_discovered(
    spark: SparkSession, metadata: DataFrame, reader: Reader, root: str, audit_path: str, options: Mapping[str, dict] | None = None
) -> dict[str, tuple[LoadSpec, TableMeta]]:
    """Load every table that discovered metadata describes; returns what the later loads of each need.

    ``options``: settings of :class:`LoadSpec` by table.
    """
    metas = table_metas(metadata)
    specs = {t: LoadSpec.from_metadata(m, **(options or {}).get(t, {})) for t, m in metas.items()}
    run_all(spark, list(specs.values()), run_full, {t: reader(t) for t in specs}, root, audit_path)
    return {t: (specs[t], metas[t]) for t in specs}
