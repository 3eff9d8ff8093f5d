"""Toxicity scores from two Kneser-Ney models, one of toxic and one of ordinary documents.

The models are over letters: texts are lower-cased bytes, with digits as one sign and anything
else as one space. The highest order counts runs of five signs, the lower orders count the
distinct signs before a run, each interpolated with the next lower one; both models end in one
shared distribution, the continuation counts of both classes together, so an expression rare
in one class is smoothed by what all documents say about it.

A document's evidence is the difference of the log-likelihoods per sign, over the whole text
and over its strongest window of ``WINDOW`` signs (an insult in a long text). A logistic curve
over the two, fitted on documents the models have not seen, gives the score.

Counts are taken of all labelled documents of the training folds but those the curve is fitted
on. What the models know of every run is kept under the run itself, in a hash table that grows
with the distinct runs and is broadcast: a run never seen backs off. The curve is fitted on at most ``curve_rows`` documents, those with the smallest hashes.

Defined cases: null and empty texts have no evidence and get the score of the curve's foot;
a null id is in no fold and held out of training; repeated rows count each time; texts over
``SEGMENT`` bytes are worked on piece by piece, each with the signs and values before it, so that their
runs, windows and scores are those of the whole; labels with equal hashes are taken for the curve by
their id; a class without training documents gives even odds throughout; columns of the caller named like
the results are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.llm.common import filled, quoted
from tideload.session import staged

ORDER = 5
DISCOUNT = 0.75
WINDOW = 24
SEGMENT = 1 << 20
THRESHOLD = 0.7
# Labels that may be broadcast to the scan of the texts; more are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
SPACE = 32


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(quoted(id_col).cast("string").cast("binary")) % 3


def _signs() -> np.ndarray:
    table = np.full(256, SPACE, dtype=np.uint8)
    table[ord("0") : ord("9") + 1] = ord("0")
    for lower in range(ord("a"), ord("z") + 1):
        table[lower] = table[lower - 32] = lower
    table[128:] = np.arange(128, 256)
    return table


def _packed(padded: np.ndarray) -> np.ndarray:
    """The run of ORDER signs that ends at each sign, packed in an integer."""
    run = np.zeros(len(padded), dtype=np.uint64)
    for back in range(ORDER):
        run[back:] |= padded[: len(padded) - back] << np.uint64(8 * back)
    return run


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The run of ORDER signs that ends at each sign, and the text each belongs to."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    signs = _signs()[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(texts)), sizes)
    if not len(signs):
        return np.zeros(0, dtype=np.uint64), owner
    starts = np.r_[True, owner[1:] != owner[:-1]]
    before = np.r_[np.uint8(SPACE), signs[:-1]]
    before[starts] = SPACE
    keep = (signs != SPACE) | (before != SPACE)
    signs, owner = signs[keep], owner[keep]
    pad = ORDER - 1
    place = np.arange(len(signs)) + (owner + 1) * pad
    padded = np.full(len(signs) + pad * len(texts), SPACE, dtype=np.uint64)
    padded[place] = signs
    return _packed(padded)[place], owner


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`runs_of`; for one text over SEGMENT bytes in pieces, each run with the signs before its piece."""
    if len(texts) != 1 or len(texts[0]) <= SEGMENT:
        yield runs_of(texts)
        return
    carry, last = np.full(ORDER - 1, SPACE, dtype=np.uint64), np.uint8(SPACE)
    for at in range(0, len(texts[0]), SEGMENT):
        signs = _signs()[np.frombuffer(texts[0][at : at + SEGMENT], dtype=np.uint8)]
        before = np.r_[last, signs[:-1]]
        last = signs[-1]
        padded = np.concatenate([carry, signs[(signs != SPACE) | (before != SPACE)].astype(np.uint64)])
        carry = padded[len(padded) - (ORDER - 1) :]
        run = _packed(padded)[ORDER - 1 :]
        yield run, np.zeros(len(run), dtype=np.int64)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Rows of a batch, about SEGMENT bytes at a time; a longer text is alone."""
    rows, texts, held = [], [], 0
    for i, text in enumerate(batch.column(column)):
        content = text.as_py().encode("utf-8", "surrogatepass")
        if len(content) > SEGMENT:
            yield np.array([i]), [content]
            continue
        rows.append(i), texts.append(content)
        held += len(content)
        if held >= SEGMENT:
            yield np.array(rows), texts
            rows, texts, held = [], [], 0
    if rows:
        yield np.array(rows), texts


def count_runs(labelled: DataFrame) -> DataFrame:
    """``run, toxic, ordinary``: how often each run of signs occurs in each class (``text, toxic`` rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            key, count = merged()
            toxic = key & np.uint64(1) == 1
            for at in range(0, len(key), 500_000):
                cut = slice(at, at + 500_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((key[cut] >> np.uint64(1)).astype(np.int64)),
                        pa.array(np.where(toxic[cut], count[cut], 0)),
                        pa.array(np.where(toxic[cut], 0, count[cut])),
                    ],
                    names=["run", "toxic", "ordinary"],
                )

        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for rows, texts in _slices(batch, 0):
                for found, owner in _pieces(texts):
                    key, count = np.unique(found << np.uint64(1) | toxic[rows][owner].astype(np.uint64), return_counts=True)
                    keys.append(key), counts.append(count)
                    held += len(key)
            if held > 4_000_000:
                key, count = merged()
                keys, counts, held = [key], [count], len(key)
                if held > 3_000_000:  # hardly anything repeats: hand it on
                    yield from out()
                    keys, counts, held = [], [], 0
        if keys:
            yield from out()

    counted = labelled.select("text", "toxic").mapInArrow(run, "run long, toxic long, ordinary long")
    return counted.groupBy("run").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def keys_of(order: int, run: np.ndarray) -> np.ndarray:
    """Order and run in one number, never 0."""
    return np.uint64(order << 40) + run


def _first_slot(key: np.ndarray, size: int) -> np.ndarray:
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def hash_table(key: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (0: empty) and ratios by slot; a key whose slot is taken is in the next free one."""
    size = 1 << max(4, (3 * len(key) // 2).bit_length())
    keys, ratios = np.zeros(size, dtype=np.uint64), np.full(size, np.nan, dtype=np.float32)
    left, slot = np.arange(len(key)), _first_slot(key, size)
    while len(left):
        free = keys[slot] == 0
        keys[slot[free]] = key[left[free]]  # of several keys one stays
        stored = keys[slot] == key[left]
        ratios[slot[stored]] = ratio[left[stored]]
        left, slot = left[~stored], (slot[~stored] + 1) % size
    return keys, ratios


def log_ratios(counts: DataFrame) -> DataFrame:
    """``order, run, ratio``: for every run seen, log p(toxic) - log p(ordinary) of its last sign.

    ``back`` rows (order 10 and up) hold what a context adds where its continuation is unseen.
    """
    d = DISCOUNT
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        above = levels[order + 1]
        suffix = F.col("run").bitwiseAND((1 << 8 * order) - 1)
        levels[order] = above.groupBy(suffix.alias("run")).agg(
            *[F.sum((F.col(c) > 0).cast("long")).alias(c) for c in ("toxic", "ordinary")]
        )
    # 256 signs at most: the shared end of both models.
    shared = levels[1].withColumn("both", F.col("toxic") + F.col("ordinary"))
    total = shared.agg(F.sum("both")).scalar()
    low = shared.select("run", ((F.col("both") + 1.0) / (total + 256.0)).alias("p_toxic"))
    low = low.withColumn("p_ordinary", F.col("p_toxic"))
    found = None
    for order in range(1, ORDER + 1):
        grams = levels[order].withColumn("context", F.shiftright("run", 8))
        stats = grams.groupBy("context").agg(
            *[F.sum(c).alias(f"n_{c}") for c in ("toxic", "ordinary")],
            *[F.sum((F.col(c) > 0).cast("long")).alias(f"t_{c}") for c in ("toxic", "ordinary")],
        )
        lower = low.withColumnRenamed("run", "suffix")
        suffix = F.col("run").bitwiseAND((1 << 8 * max(1, order - 1)) - 1)
        joined = grams.withColumn("suffix", suffix).join(stats, "context").join(lower, "suffix")
        p = {
            c: F.when(
                F.col(f"n_{c}") > 0,
                (F.greatest(F.col(c) - d, F.lit(0.0)) + d * F.col(f"t_{c}") * F.col(f"p_{c}")) / F.col(f"n_{c}"),
            ).otherwise(F.col(f"p_{c}"))
            for c in ("toxic", "ordinary")
        }
        low = joined.select(
            "run", p["toxic"].alias("p_toxic"), p["ordinary"].alias("p_ordinary")
        )
        if order < ORDER:
            low = staged(low, f"order-{order}")
        ratio = F.log("p_toxic") - F.log("p_ordinary")
        seen = low.select(F.lit(order).alias("order"), "run", ratio.alias("ratio"))
        share = {
            c: F.when(F.col(f"n_{c}") > 0, d * F.col(f"t_{c}") / F.col(f"n_{c}")).otherwise(1.0) for c in ("toxic", "ordinary")
        }
        backed = stats.select(
            F.lit(order + 10).alias("order"),
            F.col("context").alias("run"),
            (F.log(share["toxic"]) - F.log(share["ordinary"])).alias("ratio"),
        )
        rows = seen.unionByName(backed)
        found = rows if found is None else found.unionByName(rows)
    return found


@dataclass
class Model:
    """Log ratios in a :func:`hash_table` and the coefficients of the curve."""

    keys: np.ndarray
    ratios: np.ndarray
    curve: np.ndarray

    def ratio(self, order: int, run: np.ndarray) -> np.ndarray:
        """The log ratio of each run, not a number where it was never seen."""
        key = keys_of(order, run)
        slot = _first_slot(key, len(self.keys))
        held = self.keys[slot]
        value = np.where(held == key, self.ratios[slot], np.float32(np.nan))
        open_at = np.flatnonzero((held != key) & (held != 0))
        while len(open_at):
            slot[open_at] = (slot[open_at] + 1) % len(self.keys)
            held = self.keys[slot[open_at]]
            hit = held == key[open_at]
            value[open_at[hit]] = self.ratios[slot[open_at[hit]]]
            open_at = open_at[~hit & (held != 0)]
        return value

    def evidence(self, run: np.ndarray) -> np.ndarray:
        """Log p(toxic) - log p(ordinary) of each run's last sign."""
        value = self.ratio(ORDER, run)
        open_at = np.flatnonzero(np.isnan(value))
        if len(open_at):
            value[open_at] = 0
            rest = run[open_at]
            for order in range(ORDER, 1, -1):
                back = self.ratio(order + 10, rest >> np.uint64(8))
                value[open_at] += np.nan_to_num(back)
                rest = rest & np.uint64((1 << 8 * (order - 1)) - 1)
                lower = self.ratio(order - 1, rest)
                seen = ~np.isnan(lower)
                value[open_at[seen]] += lower[seen]
                open_at, rest = open_at[~seen], rest[~seen]
                if not len(open_at):
                    break
            # Signs no training text has: both models end in the same share.
            value[open_at] += np.nan_to_num(self.ratio(11, np.zeros(1, dtype=np.uint64)))[0]
        return value

    def features(self, batch: pa.RecordBatch, column: int) -> np.ndarray:
        """Evidence per sign of each row's whole text and of its strongest window."""
        total, signs = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        best = np.full(batch.num_rows, -np.inf)
        for rows, texts in _slices(batch, column):
            # The last values of the piece before, if a long text goes on.
            tail = np.zeros(0)
            for run, owner in _pieces(texts):
                if not len(run):
                    continue
                value = self.evidence(run).astype(np.float64)
                summed = np.concatenate([[0.0], np.cumsum(np.concatenate([tail, value]))])
                own = len(tail)
                ends = own + np.cumsum(np.bincount(owner, minlength=len(texts)))
                starts = np.concatenate([[own], ends[:-1]])
                np.add.at(total, rows, summed[ends] - summed[starts])
                np.add.at(signs, rows, ends - starts)
                begun = np.where(starts == own, 0, starts)
                left = np.maximum(np.arange(own + 1, own + len(run) + 1) - WINDOW, begun[owner])
                window = (summed[own + 1 :] - summed[left]) / WINDOW
                some = ends > starts
                np.maximum.at(best, rows[some], np.maximum.reduceat(window, starts[some] - own))
                tail = value[-WINDOW:] if not own else np.concatenate([tail, value])[-WINDOW:]
        return np.column_stack([total / np.maximum(signs, 1), np.where(np.isfinite(best), best, 0.0)])

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(self.curve[0] + features @ self.curve[1:], -30, 30)
        return 1 / (1 + np.exp(-z))


def fit_curve(features: np.ndarray, label: np.ndarray, penalty: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Coefficients (the constant first) of a logistic curve, by Newton's method."""
    x = np.column_stack([np.ones(len(features)), features])
    w = np.zeros(x.shape[1])
    if not len(label) or label.min() == label.max():
        return w
    keep = np.diag([0.0, *[penalty] * features.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - label) + keep @ w
        bend = (x * (p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -10, 10)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _with_labels(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``text, toxic`` of the documents that ``labels`` (``id, toxic``) has."""
    rows = docs.select(quoted(id_col).alias("id"), filled(quoted(text_col)).alias("text"))
    if labels.count() <= BROADCAST_LABELS:
        labels = F.broadcast(labels)
    return rows.join(labels, "id").select("text", "toxic")


def _feature_rows(shared, rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            found = model.features(batch, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1]), batch.column(1)], names=["mean", "window", "toxic"]
            )

    return rows.mapInArrow(run, "mean double, window double, toxic int")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    curve_rows: int = 20_000,
) -> Model:
    """Learn from the labels of folds 0 and 2: the curve from ``curve_rows`` documents of fold 2 at most, the models from all others.

    Labels of fold 1 are not read. A document with several labels counts as toxic if one says so.
    """
    spark = docs.sparkSession
    known = labels.where(quoted(id_col).isNotNull() & quoted(label_col).isNotNull() & (fold(id_col) != 1))
    known = known.groupBy(quoted(id_col).alias("id"), fold(id_col).alias("fold")).agg(
        F.max((quoted(label_col) > 0).cast("int")).alias("toxic")
    )
    known = staged(known, "labels")
    # Written: the models must not see the documents of the curve.
    second = staged(known.where("fold = 2").orderBy(F.xxhash64("id"), "id").limit(curve_rows).select("id", "toxic"), "curve-labels")
    first = known.join(second.select("id"), "id", "left_anti").select("id", "toxic")
    first = _with_labels(docs, first, id_col, text_col)
    counts = staged(count_runs(first), "runs")
    # One row per distinct run and context.
    known_runs = (
        log_ratios(counts)
        # The same key as keys_of() gives.
        .select((F.col("order").cast("long") * (1 << 40) + F.col("run")).alias("key"), F.col("ratio").cast("float"))
        .toArrow()
    )
    table = hash_table(known_runs.column("key").to_numpy().astype(np.uint64), known_runs.column("ratio").to_numpy())
    shared = spark.sparkContext.broadcast((*table, np.zeros(3)))
    rows = _feature_rows(shared, _with_labels(docs, second, id_col, text_col)).toArrow()
    features = np.column_stack([rows.column(c).to_numpy() for c in ("mean", "window")])
    shared.unpersist()
    return Model(*table, fit_curve(features, rows.column("toxic").to_numpy().astype(np.float64)))


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with ``score`` and ``predicted``; columns of the same names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast((model.keys, model.ratios, model.curve))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*[quoted(c) for c in kept])
    named = rows.withColumn("__llm_text", filled(quoted(text_col)))
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    schema = T.StructType([*rows.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            found = model.score(model.features(batch, batch.num_columns - 1))
            arrays = [*batch.columns[:-1], pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return named.mapInArrow(run, schema)
