"""Writing keyed rows into a wide-column store, as a Spark data source around a caller's client.

A task sends its mutations to the store in the order of the row keys, under a name of its own; what it
wrote counts once the driver commits the job with the tokens of the tasks that succeeded. A
task that runs again, or a second copy of it, writes under another name, so nothing counts twice, and
a job that fails is taken back whole. A job has an id, and a client commits it once.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tideload.operators.cells import MUTATION_FIELDS
from tideload.session import small_tasks

# The writer travels with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Shuffled mutations that a writing task sorts, and text of mutations that a reading task has, about.
SORTED_BYTES = 4 << 20
READ_BYTES = 16 << 20


class CellTask(Protocol):
    """What one task writes, in the order of the row keys."""

    def put(self, rowkey: str, family: str, cells: Sequence[tuple[str, str]]) -> None: ...

    def delete(self, rowkey: str) -> None: ...

    def close(self) -> str:
        """Finish; the token that the driver commits."""

    def discard(self) -> None:
        """Take back what was written."""


class CellClient(Protocol):
    """The connection to a store. It is sent to the tasks, so it holds settings and no open connection."""

    def open(self, job: str, task: str) -> CellTask: ...

    def commit(self, job: str, tokens: Sequence[str]) -> None:
        """Let the writes of these tasks count, all at once; nothing if the job has been committed."""

    def abort(self, job: str, tokens: Sequence[str]) -> None: ...


@dataclass
class _Written(WriterCommitMessage):
    token: str
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, client: CellClient, job: str):
        self.client, self.job = client, job

    def write(self, iterator: Iterator[Row]) -> _Written:
        context = TaskContext.get()
        task = self.client.open(self.job, f"{context.partitionId():06d}-{context.taskAttemptId()}")
        rows, last = 0, None
        try:
            for row in iterator:
                if last is not None and row.rowkey < last:
                    raise ValueError(f"row key {row.rowkey!r} follows {last!r}: sort the mutations first")
                last = row.rowkey
                if row.deleted:
                    task.delete(row.rowkey)
                else:
                    task.put(row.rowkey, row.family, [(c["qualifier"], c["value"]) for c in row.cells])
                rows += 1
            return _Written(task.close(), rows)
        except BaseException:
            task.discard()
            raise

    def commit(self, messages: list[_Written | None]) -> None:
        self.client.commit(self.job, [m.token for m in messages if m])

    def abort(self, messages: list[_Written | None]) -> None:
        self.client.abort(self.job, [m.token for m in messages if m])


def write_mutations(mutations: DataFrame, client: CellClient, job: str | None = None) -> str:
    """Send mutations (``rowkey, family, deleted, cells``; at most one a key) to the store; the id of the job."""
    job = job or uuid.uuid4().hex
    source = f"tideload_cells_{uuid.uuid4().hex}"

    class CellSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return source

        def schema(self) -> str:
            return MUTATION_FIELDS

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return _Writer(client, job)

    mutations.sparkSession.dataSource.register(CellSource)
    # Ranges of the key: each task writes to its own part of the store.
    ordered = mutations.select("rowkey", "family", "deleted", "cells").repartitionByRange("rowkey").sortWithinPartitions("rowkey")
    with small_tasks(mutations.sparkSession, SORTED_BYTES):
        ordered.write.format(source).mode("append").save()
    return job


class FileCells:
    """A store in files, for trials and tests: a file of mutations per task, a list of files per committed job."""

    def __init__(self, path: str):
        self.path = path if "://" in path or path.startswith("file:") else f"file://{path}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path.replace("file:/", "file:///") if not self.path.startswith("file://") else self.path)

    def open(self, job: str, task: str) -> _FileTask:
        store, root = self._store()
        return _FileTask(store, f"{root}/tasks/{job}", task)

    def commit(self, job: str, tokens: Sequence[str]) -> None:
        store, root = self._store()
        store.create_dir(f"{root}/jobs")
        done = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(f"{root}/jobs")) if f.base_name.endswith(".json"))
        if any(name.partition("-")[2] == f"{job}.json" for name in done):
            return
        name = f"{root}/jobs/{len(done):08d}-{job}.json"
        with store.open_output_stream(name + ".tmp") as out:
            out.write(json.dumps([f"tasks/{job}/{t}" for t in tokens]).encode())
        store.move(name + ".tmp", name)

    def abort(self, job: str, tokens: Sequence[str]) -> None:
        store, root = self._store()
        if store.get_file_info(f"{root}/tasks/{job}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/tasks/{job}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The cells ``rowkey, family, qualifier, value`` that a reader of the store finds."""
        store, root = self._store()
        files, numbers, size = [], [], 0
        for number, info in enumerate(sorted(store.get_file_info(fs.FileSelector(f"{root}/jobs")), key=lambda f: f.base_name)):
            if info.base_name.endswith(".json"):
                with store.open_input_stream(info.path) as job:
                    names = json.loads(job.read())
                files += [f"{self.path}/{n}" for n in names]
                numbers += [(n.rpartition("/")[2], number) for n in names]
                size += sum(f.size for f in store.get_file_info([f"{root}/{n}" for n in names]))
        # One row per committed task.
        order = F.broadcast(spark.createDataFrame(numbers, "task string, job int"))
        rows = spark.read.schema(MUTATION_FIELDS).json(files).withColumn("task", F.col("_metadata.file_name")).join(order, "task")
        # Mutations are exchanged whole, to parts of a size that does not grow with the store, and taken apart there.
        rows = rows.repartition(max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES)), "rowkey")
        gone = rows.where("deleted").groupBy("rowkey").agg(F.max("job").alias("gone"))
        cells = rows.where("NOT deleted").select("rowkey", "family", "job", F.inline("cells"))
        kept = cells.join(gone, "rowkey", "left").where("gone IS NULL OR job > gone")
        return kept.groupBy("rowkey", "family", "qualifier").agg(F.max_by("value", "job").alias("value"))


class _FileTask:
    """One task's file. Its name holds the attempt, so no two attempts share one."""

    def __init__(self, store: fs.FileSystem, folder: str, task: str):
        store.create_dir(folder)
        self.store, self.name, self.path = store, f"{task}.jsonl", f"{folder}/{task}.jsonl"
        self.out = store.open_output_stream(self.path)

    def _line(self, row: dict) -> None:
        self.out.write(json.dumps(row).encode() + b"\n")

    def put(self, rowkey: str, family: str, cells: Sequence[tuple[str, str]]) -> None:
        named = [{"qualifier": q, "value": v} for q, v in cells]
        self._line({"rowkey": rowkey, "family": family, "deleted": False, "cells": named})

    def delete(self, rowkey: str) -> None:
        self._line({"rowkey": rowkey, "deleted": True})

    def close(self) -> str:
        self.out.close()
        return self.name

    def discard(self) -> None:
        self.out.close()
        self.store.delete_file(self.path)
