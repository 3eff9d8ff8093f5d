"""Line deduplication over levelled sorted runs of line hashes.

Every line key (the line stripped of ASCII white space and lower-cased) becomes 128 bits of
hash. The index holds the keys seen so far as runs: tables bucketed and sorted by the hash,
each key in one run. A batch of documents, newer (with larger ids) than all before it, is
merge-anti-joined with the runs; its keys that no run has become a new run on level 0, and
``fanout`` runs of one level are merged into one run of the next. So a batch costs a merge
with about ``fanout`` runs a level, and a key is rewritten once a level.

Defined cases: a null text is one empty line; a null id keeps all its lines and holds no key;
repeated rows of one id count as one document and lose the same lines; an empty table gives an
empty result; result columns replace columns of the caller that have the same name; texts and lines
may have any length, a document is one row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideload.llm.common import OWN, filled, quoted, with_results
from tideload.session import fresh_dir, staged

SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HASH = [f"{OWN}h1", f"{OWN}h2"]
DOC, TEXT, LINE, FIRST = f"{OWN}doc", f"{OWN}text", f"{OWN}line", f"{OWN}first"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, UPPER.lower())


def split_lines(text: Column) -> Column:
    return F.split(filled(text), "\n")


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: document, text, place, hash."""
    text = quoted(text_col)
    # The outer form: for the other one Catalyst infers a filter that splits every text once more.
    exploded = docs.where(quoted(id_col).isNotNull()).select(
        quoted(id_col).alias(DOC), F.xxhash64(text).alias(TEXT), F.posexplode_outer(split_lines(text)).alias(LINE, "value")
    )
    keyed = exploded.withColumn("value", line_key(F.col("value"))).where(F.char_length("value") >= min_chars)
    # Two hashes with different seeds: 128 bits, so that different keys don't meet at any size.
    return keyed.select(
        DOC, TEXT, LINE, F.xxhash64("value").alias(HASH[0]), F.xxhash64(F.lit(7), F.col("value")).alias(HASH[1])
    )


class LineRuns:
    """The levelled runs of line hashes; the tables lie in a database of their own in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark = spark
        self.fanout = fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.database = f"lines_{uuid.uuid4().hex[:12]}"
        self.levels: list[list[str]] = []
        self.location = fresh_dir(spark, "lines")
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{self.location}'")

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, keys: DataFrame) -> str:
        name = f"{self.database}.run_{uuid.uuid4().hex[:12]}"
        placed = keys.repartition(self.buckets, *HASH)
        placed.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        return name

    def add_batch(self, lines: DataFrame) -> DataFrame:
        """Take in the lines of the next batch and return those to drop, written.

        A line goes if an older batch holds its key, or a smaller id of this batch.
        """
        keys = lines.groupBy(*HASH).agg(F.min(DOC).alias(FIRST))
        for run in self.runs():
            keys = keys.join(self.spark.table(run).hint("merge"), HASH, "left_anti")
        run = self._write(keys)
        # Read as plain files, so that this join exchanges both sides and a hot line's partition can be split.
        own = self.spark.read.schema(keys.schema).parquet(f"{self.location}/{run.partition('.')[2]}")
        late = lines.join(own, HASH, "left").where(F.col(FIRST).isNull() | (F.col(DOC) > F.col(FIRST)))
        dropped = staged(late.select(DOC, TEXT, LINE), "line-drops")
        self._place(run, 0)
        return dropped

    def _place(self, run: str, level: int) -> None:
        """Add a run to a level, and merge the level into the next one when it is full."""
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) < self.fanout:
            return
        full, self.levels[level] = self.levels[level], []
        merged = self.spark.table(full[0])
        for name in full[1:]:
            merged = merged.unionByName(self.spark.table(name))
        run = self._write(merged)
        for name in full:
            self.spark.sql(f"DROP TABLE {name}")
        self._place(run, level + 1)

    def close(self) -> None:
        """Drop the runs."""
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")


def _id_ranges(lines: DataFrame, batches: int) -> list[Column]:
    """Conditions that cut the ids into ascending ranges of about as many lines each."""
    shares = [i / batches for i in range(1, batches)]
    cuts = lines.select(F.percentile_approx(DOC, shares, 1000)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    low = [None, *cuts]
    high = [*cuts, None]
    ranges = []
    for a, b in zip(low, high, strict=True):
        above = F.lit(True) if a is None else F.col(DOC) > F.lit(a)
        ranges.append(above if b is None else above & (F.col(DOC) <= F.lit(b)))
    return ranges


def _without(lines: Column, drops: Column) -> Column:
    """The text of ``lines`` without those at the ascending places ``drops``, in linear time."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(drops, i - 1))
    flags = F.flatten(
        F.transform(drops, lambda p, i: F.concat(F.array_repeat(F.lit(False), p - before(i) - 1), F.array(F.lit(True))))
    )
    return F.array_join(F.zip_with(lines, flags, lambda x, gone: F.when(gone, F.lit(None)).otherwise(x)), "\n")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """Documents whose text lost every line that a document with a smaller (numeric) id holds.

    ``min_chars``: shorter keys stay. ``batches``: the table is taken in as so many batches of
    ascending ids. Adds ``n_lines`` (before) and ``n_dropped``.
    """
    spark = docs.sparkSession
    lines = staged(keyed_lines(docs, id_col, text_col, min_chars), "lines")
    runs = LineRuns(spark, fanout)
    dropped = None
    try:
        for chosen in _id_ranges(lines, batches):
            part = runs.add_batch(lines.where(chosen))
            dropped = part if dropped is None else dropped.unionByName(part)
    finally:
        runs.close()
    places = f"{OWN}places"
    # A document's places number no more than its lines.
    per_doc = dropped.groupBy(DOC, TEXT).agg(F.sort_array(F.collect_set(LINE)).alias(places))
    text = quoted(text_col)
    joined = docs.join(
        per_doc, (quoted(id_col) == F.col(DOC)) & (F.xxhash64(text) == F.col(TEXT)), "left"
    )
    split = split_lines(text)
    out = with_results(
        joined,
        n_lines=F.size(split).cast("long"),
        n_dropped=F.coalesce(F.size(places), F.lit(0)).cast("long"),
        **{text_col: F.when(F.col(places).isNull(), filled(text)).otherwise(_without(split, F.col(places)))},
    )
    return out.drop(DOC, TEXT, places)
