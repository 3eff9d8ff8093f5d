"""Extracts of many tables by watermark: read, land, advance.

The control is a ledger of the runs that have committed: one row per table and run, with the folder the
run landed and the watermark it set. What a run has landed counts from the commit that advances the
watermarks, and not before; a reader follows the ledger, so files of failed runs are never read.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.files import folder_names, remove_folder
from tideload.operators.latest import latest_per_key
from tideload.operators.publish import VersionedTable, write_counted
from tideload.sources.extract import Reader

LEDGER = "table_name string, run_time timestamp_ntz, run_id string, folder string, rows long, commit_number long"


def ledger_of(control: VersionedTable) -> DataFrame:
    """Every committed run of every table, with its folder, rows, watermark and place in the order of commits."""
    if not control.exists():
        return control.spark.createDataFrame([], LEDGER)
    return control.read()


def control_of(control: VersionedTable) -> DataFrame:
    """The watermark of each table and the run that set it."""
    newest = latest_per_key(ledger_of(control), ["table_name"], [F.col("commit_number").desc()])
    return newest.select("table_name", "run_time", "run_id")


def run_extracts(
    spark: SparkSession,
    reader: Reader,
    tables: Mapping[str, str],
    control_path: str,
    landing: str,
    run_id: str,
    workers: int = 4,
) -> dict[str, str]:
    """Land what is new in each table (name -> its time column); returns the folders this run landed.

    A table without a watermark is landed whole. The watermark is the newest time among the landed
    rows, taken from the files, and all tables advance in one commit, which names their folders, once
    every table has landed. A run that has committed repeats nothing; one that failed left
    folders that no reader looks at, and a run of the same id replaces them.
    """
    control = VersionedTable(spark, control_path)
    # One row per table.
    known = {r.table_name: r.run_time for r in control_of(control).collect()}
    done = {r.table_name for r in ledger_of(control).where(F.col("run_id") == run_id).select("table_name").collect()}
    due = {t: ts for t, ts in tables.items() if t not in done}
    number = 1 + (ledger_of(control).agg(F.max("commit_number")).first()[0] or 0)

    def extract(table: str) -> tuple:
        ts, rows, since = due[table], reader(table), known.get(table)
        if since is not None:
            rows = rows.where(F.col(ts) > F.lit(since).cast("timestamp_ntz"))
        folder = f"{landing}/{table}/run={run_id}"
        count = write_counted(rows, folder)
        newest = spark.read.parquet(folder).agg(F.max(F.col(ts).cast("timestamp_ntz"))).first()[0]
        return table, max((x for x in (since, newest) if x is not None), default=None), run_id, folder, count, number

    with ThreadPoolExecutor(max_workers=workers) as pool:
        landed = list(pool.map(extract, due))
    if landed:
        control.publish(ledger_of(control).unionByName(spark.createDataFrame(landed, LEDGER)).coalesce(1))
    return {row[0]: row[3] for row in landed}


def landed_rows(control: VersionedTable, table: str, run_id: str | None = None) -> DataFrame:
    """The rows landed for a table by the runs that have committed, or by one of them."""
    runs = ledger_of(control).where(F.col("table_name") == table)
    if run_id is not None:
        runs = runs.where(F.col("run_id") == run_id)
    # One row per run.
    folders = [r.folder for r in runs.orderBy("commit_number").select("folder").collect()]
    if not folders:
        raise FileNotFoundError(f"no run has landed {table}")
    return control.spark.read.parquet(*folders)


def vacuum_landing(control: VersionedTable, landing: str) -> list[str]:
    """Remove the folders of runs that never committed; returns them. Not while a run is under way."""
    named = {r.folder for r in ledger_of(control).select("folder").collect()}
    spark, removed = control.spark, []
    for table in folder_names(spark, landing):
        for run in folder_names(spark, f"{landing}/{table}"):
            folder = f"{landing}/{table}/{run}"
            if folder not in named:
                remove_folder(spark, folder)
                removed.append(folder)
    return removed
