"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors are made of whole numbers (each component scaled and rounded down). The rows are dealt
to shards, and the index of a shard holds, for each component, the rows in descending order of
its value, cut into segments; a segment's impact on a query is the query's component times the
segment's end value, an upper bound for all its rows.

For a query, the segments of all components are worked off by descending impact, adding the
impact to the rows' accumulators. A row's score is at most its accumulator plus ``rest``, the
sum over the components of the positive impacts still to come. The exact scores of the best
accumulators give a k-th score that the answer must reach. The work stops when few rows can
still reach it, or all segments are done; all those rows are scored exactly, so the answer is
exact whenever it stops. Shards answer by themselves, and their answers are merged.

Defined cases: vectors that are null, or hold null or non-finite components, and rows without an
id take no part; shorter vectors end in zeros; an empty vector has score 0 with all; ties go to
the smaller id; fully repeated rows count once; an empty table gives an empty result.
Scores must fit a long: vectors for which they may not are refused. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideload.llm.common import quoted
from tideload.session import staged

SHARD_ROWS = 8192
QUERY_BLOCK = 2048
SEGMENT_ROWS = 256
# Rows that may still reach the answer, as a share of the shard, at which they are scored exactly.
FEW = 0.1


def whole_numbers(vector: Column, scale: int) -> Column:
    """The components as floor(scale * x), x as double; null if any is null or not finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    fits = F.forall(vector, lambda x: F.abs(scaled(x)) < float(1 << 62))
    error = F.raise_error(F.lit("a scaled component does not fit a long")).cast("array<bigint>")
    numbers = F.when(fits, F.transform(vector, lambda x: F.floor(scaled(x)).cast("long"))).otherwise(error)
    return F.when(vector.isNotNull() & F.coalesce(finite, F.lit(False)), numbers)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    first = np.cumsum(lengths) - lengths
    out[row, np.arange(len(row)) - first[row]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class ShardIndex:
    """The impact-ordered index of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        rows, width = vectors.shape
        order = np.argsort(-vectors, axis=0, kind="stable").T
        at = np.arange(0, rows, SEGMENT_ROWS)
        ends = np.minimum(at + SEGMENT_ROWS, rows) - 1
        ranked = np.take_along_axis(vectors.T, order, axis=1)
        # Component x segment x row; the last segment is filled up with a row that does not exist.
        filled = np.pad(order, ((0, 0), (0, -rows % SEGMENT_ROWS)), constant_values=rows)
        self.segments = filled.reshape(width, len(at), SEGMENT_ROWS).astype(np.int32)
        self.highest, self.lowest = ranked[:, at], ranked[:, ends]  # component x segment
        self.largest = int(np.abs(vectors).max(initial=0))

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows (places in the shard) that can be among the k best, and their exact scores."""
        rows, width = self.vectors.shape
        # Sums stay exact in float64 below 2**53, otherwise whole numbers are used.
        exact = self.largest * int(np.abs(query).max(initial=0)) * max(width, 1) < 1 << 52
        kind = np.float64 if exact else np.int64
        use = np.flatnonzero(query)
        q = query[use].astype(kind)
        # A positive component has its best rows first, a negative one last.
        bound = np.where(q[:, None] > 0, self.highest[use], self.lowest[use]).astype(kind)
        impact = q[:, None] * bound
        by_impact = np.argsort(-impact, axis=None, kind="stable")
        component, segment = np.unravel_index(by_impact, impact.shape)
        sorted_impact = impact.ravel()[by_impact]
        # Segments of a component come in descending impact, so the next one is its frontier.
        all_acc = np.zeros(rows + 1, dtype=kind)
        acc = all_acc[:rows]
        least, few = None, max(4 * k, int(FEW * rows))
        candidates = np.arange(rows)
        wave = max(1, len(by_impact) // 12)
        other = self.ids != own
        count = int(other.sum())
        if count <= k or not len(use):
            return self._scored(np.flatnonzero(other), query, kind)
        for begun in range(0, len(by_impact), wave):
            done = min(begun + wave, len(by_impact))
            touched = self.segments[use[component[begun:done]], segment[begun:done]].ravel()
            added = np.repeat(sorted_impact[begun:done], SEGMENT_ROWS)
            if exact:
                all_acc += np.bincount(touched, added, minlength=rows + 1)
            else:
                np.add.at(all_acc, touched, added)
            open_positive = sorted_impact[done:] > 0
            if open_positive.any():
                frontier = np.zeros(len(use), dtype=kind)
                np.maximum.at(frontier, component[done:][open_positive], sorted_impact[done:][open_positive])
                rest = frontier.sum()
            else:
                rest = 0
            if begun < len(by_impact) // 3:
                continue
            best = np.argpartition(np.where(other, acc, acc.min() - 1), rows - k)[rows - k :]
            _, scores = self._scored(best, query, kind)
            low = scores.min()
            least = low if least is None else max(least, low)
            candidates = np.flatnonzero((acc + rest >= least) & other)
            if len(candidates) <= few:
                break
        return self._scored(candidates, query, kind)

    def _scored(self, rows: np.ndarray, query: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
        return rows, (self.vectors[rows].astype(kind) @ query.astype(kind)).astype(np.int64)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each row that ``is_query`` holds for.

    The queries meet the shards in blocks of ``query_block``, each block and shard one task's work.
    """
    rows = (
        vectors.select(
            quoted(id_col).cast("long").alias("id"), whole_numbers(quoted(vector_col), scale).alias("numbers"), is_query.alias("asks")
        )
        .where("id IS NOT NULL AND numbers IS NOT NULL")
        .dropDuplicates(["id", "numbers"])
    )
    rows = staged(rows, "vectors")
    most = F.max(F.greatest(F.array_max("numbers"), -F.array_min("numbers")))
    size = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("numbers")), most).first()
    if (size[2] or 0) * (size[3] or 0) ** 2 >= 1 << 63:
        raise OverflowError("scores may not fit a long: take a smaller scale")
    shards = max(1, -(-size[0] // shard_rows))
    blocks = max(1, -(-size[1] // query_block))
    width = max(1, size[2] or 0)
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard")
    block = F.pmod(F.xxhash64(F.lit(7), F.col("id")), F.lit(blocks))
    first = F.lit(0).cast("long")
    every_block = F.explode(F.sequence(first, F.lit(blocks - 1).cast("long"))).alias("block")
    every_shard = F.explode(F.sequence(first, F.lit(shards - 1).cast("long"))).alias("shard")
    stored = rows.select("id", "numbers", shard, every_block)
    asked = rows.where("asks").select("id", "numbers", block.alias("block"), every_shard)

    def run(stored: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        found: list[tuple[np.ndarray, ...]] = []
        if stored.num_rows and asked.num_rows:
            ids = stored.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            index = ShardIndex(ids[order], _matrix(stored.column("numbers"), width)[order])
            for query_id, query in zip(asked.column("id").to_numpy(), _matrix(asked.column("numbers"), width), strict=True):
                row, score = index.search(query, query_id, k)
                best = np.lexsort((index.ids[row], -score))[:k]
                found.append((np.full(len(best), query_id), index.ids[row[best]], score[best]))
        if not found:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        return pa.table({n: pa.array(np.concatenate(c), pa.int64()) for n, c in zip(names, zip(*found), strict=True)})

    answers = (
        stored.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )
    # k rows per shard and query; Spark keeps k per task and query before the exchange.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
