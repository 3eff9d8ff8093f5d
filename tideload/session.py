"""Session settings and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.files import remove_folder

CHECKPOINT_SETTING = "spark.checkpoint.dir"
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ALL_JOIN_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

# Partitions that hold a hot key are split when a join reads them, even where that
# costs one more exchange after the join.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_roots: dict[str, str] = {}


def build_session(app: str = "tideload", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs rely on. Extra settings win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", **ADAPTIVE_SETTINGS}
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give an existing session the run-time settings the jobs rely on."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def splits_skewed_joins(spark: SparkSession) -> bool:
    """Whether the session splits the hot partitions of a join at run time."""
    return all(spark.conf.get(key, "false") == "true" for key in ADAPTIVE_SETTINGS)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only used where that setting is absent and the
    master runs inside this one machine.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        _local_roots[app_id] = tempfile.mkdtemp(prefix="tideload-")
    return _local_roots[app_id]


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tideload/{spark.sparkContext.applicationId}"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder of this application below the shared one."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application staged; call it when its results have been written."""
    remove_folder(spark, _own_folder(spark))


def staged(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder (or an unused ``folder`` below it) and read it back.

    Used where a result feeds several branches and must not be computed twice,
    or where its row placement must stay the same after an executor is lost.
    """
    path = folder or fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every query run inside when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def joins_by_some_keys(spark: SparkSession) -> Iterator[None]:
    """Let the joins run inside meet rows where these lie by some of the join's keys, without an exchange by all of them."""
    before = spark.conf.get(ALL_JOIN_KEYS, "true")
    spark.conf.set(ALL_JOIN_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_JOIN_KEYS, before)


def sums_in_order(value: Column) -> Column:
    """``value``, an aggregate, such that the rows of its ``groupBy`` are sorted and summed up one after the other.

    A hash table holds all sums of every group of a task, twice where no exchange lies between, and spills
    them; sorted rows take their own width. Text can't be changed in place, so Spark sorts for it.
    """
    return F.when(F.max(F.lit("")).isNotNull(), value)


@contextmanager
def small_tasks(spark: SparkSession, size: int) -> Iterator[None]:
    """Let the queries run inside join partitions up to ``size`` bytes of shuffled data, for rows that are far larger in memory."""
    before = spark.conf.get(ADVISORY_SIZE)
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(ADVISORY_SIZE, str(min(size, bytes_of(before))))
    try:
        yield
    finally:
        spark.conf.set(ADVISORY_SIZE, before)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df``; very large where it has none."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """The largest estimated size the session broadcasts, in bytes (-1: never)."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
