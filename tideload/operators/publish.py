"""Making a new table state visible."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideload.files import complete_folders, file_names, folder_names, read_text, remove_folder, write_text
from tideload.operators.merge import merge_changes
from tideload.session import plan_bytes

_VERSION = re.compile(r"^v=(\d+)(?:-([0-9A-Za-z]+))?$")
BUCKET = "_bucket"


def write_counted(df: DataFrame, path: str) -> int:
    """Write ``df`` as Parquet; the number of its rows, counted by the tasks that write them."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get.get("rows", 0)


class VersionedTable:
    """A table kept as numbered full versions; readers see the newest finished one.

    A version counts from the moment its job commits, so a failed or killed write
    changes nothing for readers and the next one starts over. One writer at a time.

    A version may carry a tag, which counts from that very moment too: what a job has to
    remember about a version is written first, under the tag, and found by it afterwards.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folders(self) -> dict[int, tuple[str, str | None]]:
        """Folder and tag of each finished version."""
        found = [_VERSION.match(n) for n in complete_folders(self.spark, self.path)]
        return {int(m[1]): (m[0], m[2]) for m in sorted((m for m in found if m), key=lambda m: int(m[1]))}

    def versions(self) -> list[int]:
        return list(self._folders())

    def exists(self) -> bool:
        return bool(self._folders())

    def tag(self) -> str | None:
        """The tag of the newest version."""
        folders = self._folders()
        return folders[max(folders)][1] if folders else None

    def publish(self, df: DataFrame, tag: str | None = None) -> int:
        """Write ``df``, which may read this table, as the next version. Without a tag it keeps that of the last one."""
        folders = self._folders()
        version = max(folders, default=0) + 1
        tag = tag or (folders[version - 1][1] if folders else None)
        rows = write_counted(df, f"{self.path}/v={version}{'-' + tag if tag else ''}")
        write_text(self.spark, f"{self.path}/_rows/{version}", str(rows))
        return version

    def _folder(self, version: int | None) -> tuple[int, str]:
        folders = self._folders()
        if not folders:
            raise FileNotFoundError(f"no finished version below {self.path}")
        version = version or max(folders)
        return version, f"{self.path}/{folders[version][0]}"

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._folder(version)[1])

    def rows(self, version: int | None = None) -> int:
        """The number of rows of a version, as counted when it was written."""
        version, folder = self._folder(version)
        known = read_text(self.spark, f"{self.path}/_rows/{version}")
        return int(known) if known else self.spark.read.parquet(folder).count()

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the newest ``keep`` versions, and what failed writes left."""
        folders = self._folders()
        kept = list(folders)[-max(keep, 1) :]
        for name in folder_names(self.spark, self.path):
            found = _VERSION.match(name)
            if found and kept and int(found[1]) <= kept[-1] and name not in {folders[v][0] for v in kept}:
                remove_folder(self.spark, f"{self.path}/{name}")
                if int(found[1]) not in kept:
                    remove_folder(self.spark, f"{self.path}/_rows/{found[1]}")


def ensure_table(spark: SparkSession, name: str, schema, location: str | None = None) -> None:
    """Create an empty Parquet table unless it exists."""
    if not spark.catalog.tableExists(name):
        where = f" LOCATION '{location}'" if location else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def append_rows(df: DataFrame, name: str) -> None:
    """Append by column name."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def save_table(
    df: DataFrame,
    name: str,
    keys: Sequence[str] = (),
    buckets: int | None = None,
    placed: bool = False,
    location: str | None = None,
) -> None:
    """Write a new Parquet table, bucketed by its key if ``buckets`` is given.

    The ``join`` form of a merge reads a bucketed base without exchanging it, and its
    rows are ``placed``: they lie by bucket already and are written without an exchange
    too. Other rows are moved first, so that a bucket is one file and not one per task.
    """
    if buckets and not placed:
        df = df.repartition(buckets, *keys)
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def full_load(
    source: DataFrame, name: str, keys: Sequence[str] = (), buckets: int | None = None, location: str | None = None
) -> None:
    """Drop the target and recreate it from the source."""
    drop_table(source.sparkSession, name)
    save_table(source, name, keys, buckets, location=location)


def publish_swap(spark: SparkSession, staging: str, final: str) -> None:
    """Let the staged table take the final name; names are qualified by their database.

    Catalog renames are two steps, so a reader between them finds no table. Use
    :class:`VersionedTable` where that matters.
    """
    previous = f"{final}_tmp"
    drop_table(spark, previous)
    if spark.catalog.tableExists(final):
        spark.sql(f"ALTER TABLE {final} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {final}")
    drop_table(spark, previous)


def bucket_count(df: DataFrame, bucket_bytes: int = 1 << 30, least: int = 8) -> int:
    """Buckets of about ``bucket_bytes`` each, by Catalyst's size estimate."""
    return max(least, -(-plan_bytes(df) // bucket_bytes))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a keyed table as one folder per hash bucket of its key."""
    spread = with_bucket(df, keys, buckets).repartition(BUCKET)
    spread.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def merge_into_buckets(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], buckets: int, **merge_options
) -> list[int]:
    """Merge changes into a bucketed table, rewriting only the buckets they touch.

    Returns the touched buckets. Folders are replaced when the job commits; applying
    the same changes again gives the same table, so a run that broke off is repeated.
    """
    changes = with_bucket(changes, keys, buckets)
    # At most ``buckets`` small numbers.
    touched = sorted(r[0] for r in changes.select(BUCKET).distinct().collect())
    if not touched:
        return []
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c != BUCKET]
    base = stored.where(F.col(BUCKET).isin(touched)).select(*columns)
    merged = with_bucket(merge_changes(base, changes, keys, columns, **merge_options), keys, buckets)
    folders = [f"{path}/{BUCKET}={bucket}" for bucket in touched]
    before = {folder: file_names(spark, folder) for folder in folders}
    (
        merged.repartition(BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    # A bucket that lost its last row has no output, so its old files are still there.
    for folder in folders:
        if before[folder] and file_names(spark, folder) == before[folder]:
            remove_folder(spark, folder)
    return touched
