"""Packing of documents into training sequences by dynamic programming over cut places.

Documents keep their stored order; each is its ids and one end id. The stream of ids is cut
into sequences of at most ``limit`` ids. A cut may fall on the end of a document, of a
sentence or line, or, inside longer stretches, on every 64th id. The chosen cuts minimise

    padding + sequence_cost per sequence + a penalty per cut inside a document.

A sequence of a power of two of ids needs no padding, any other is padded to ``limit``. With
p(j) the place of cut j and f(j) the least cost up to it, the padded transition is
min over i of f(i) + limit - (p(j) - p(i)), so f(i) + p(i) is kept in a monotone queue over
the last ``limit`` ids; the powers of two are ten more transitions from known places.

Each input partition is packed by itself in blocks of ``block`` ids, so memory is bounded and
at most one sequence per block and partition ends early. Sequence ids hold the partition
number in the bits above 33, and are the same when a task runs again.

Defined cases: a null or empty text is its end id alone; null ids and repeated rows are packed
like any row; one text of any length is cut as needed; an empty table gives an empty result. Of the
caller's columns only id and text are read, so any others may have the names of results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.llm.common import filled, quoted
from tideload.llm.encoding import encode, load_encoder, sentence_ends

END_ID = 0
SENTENCE_PENALTY = 4
INNER_PENALTY = 24
SEQUENCE_COST = 16
INNER_STEP = 64


def cut_candidates(doc_ends: np.ndarray, soft: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut may fall, from 0 to the end, and the penalty of each."""
    places = np.unique(np.concatenate([[0], doc_ends, soft]))
    gaps = np.diff(places)
    step = min(INNER_STEP, limit)
    wide = np.flatnonzero(gaps > min(2 * step, limit))
    inner = [np.arange(places[i] + step, places[i + 1], step) for i in wide]
    places = np.unique(np.concatenate([places, *inner]))
    penalty = np.full(len(places), INNER_PENALTY, dtype=np.int64)
    penalty[np.searchsorted(places, soft)] = SENTENCE_PENALTY
    penalty[np.searchsorted(places, doc_ends)] = 0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, limit: int, sequence_cost: int = SEQUENCE_COST) -> np.ndarray:
    """The cheapest cuts from ``places[0]`` to ``places[-1]``, both included; gaps are ``limit`` at most."""
    to, back = [], []
    width = 1
    while width < limit:
        at = np.searchsorted(places, places - width)
        hit = np.flatnonzero((places - width >= places[0]) & (places[np.minimum(at, len(places) - 1)] == places - width))
        to.append(hit), back.append(at[hit])
        width *= 2
    to_all = np.concatenate(to) if to else np.zeros(0, dtype=np.int64)
    order = np.argsort(to_all, kind="stable")
    hit_to = [*to_all[order].tolist(), -1]
    hit_from = np.concatenate(back)[order].tolist() if to else []
    place, fixed = places.tolist(), (penalty + sequence_cost).tolist()
    count = len(place)
    cost, source = [0] * count, [0] * count
    queue, worth = [0] * (count + 1), [0] * (count + 1)
    worth[0] = place[0]
    head, tail, h = 0, 1, 0
    for j in range(1, count):
        p = place[j]
        low = p - limit
        while place[queue[head]] < low:
            head += 1
        source_j = queue[head]
        best = worth[head] + limit - p
        while hit_to[h] == j:
            i = hit_from[h]
            if cost[i] < best:
                best, source_j = cost[i], i
            h += 1
        best += fixed[j]
        cost[j], source[j] = best, source_j
        value = best + p
        while tail > head and worth[tail - 1] >= value:
            tail -= 1
        queue[tail], worth[tail] = j, value
        tail += 1
    cuts, j = [count - 1], count - 1
    while j:
        j = source[j]
        cuts.append(j)
    return places[cuts[::-1]]


def pack_block(lengths: np.ndarray, soft: np.ndarray, limit: int) -> dict[str, np.ndarray]:
    """Pieces of the documents with these lengths: document, start, length, sequence, offset."""
    doc_ends = np.cumsum(lengths)
    doc_starts = doc_ends - lengths
    cuts = best_cuts(*cut_candidates(doc_ends, soft, limit), limit)
    at = np.union1d(doc_starts, cuts[:-1])
    size = np.diff(np.append(at, doc_ends[-1]))
    doc = np.searchsorted(doc_starts, at, side="right") - 1
    sequence = np.searchsorted(cuts, at, side="right") - 1
    return {
        "at": at, "doc": doc, "start": at - doc_starts[doc], "length": size, "sequence": sequence, "offset": at - cuts[sequence]
    }


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, block: int = 1 << 20
) -> DataFrame:
    """One row per piece of a document: ``id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``vocabulary``: path of the vocabulary file, on every executor. ``ids`` holds the piece's
    ids as little-endian unsigned 32-bit numbers.
    """
    rows = docs.select(quoted(id_col).alias("id"), filled(quoted(text_col)).alias("text"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType(
        [T.StructField("id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
         T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
         T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(vocabulary)
        ends = sentence_ends(encoder)
        next_id = TaskContext.get().partitionId() << 33
        ids, keys, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, ids, keys, held
            lengths = np.array([len(x) for x in ids], dtype=np.int64)
            stream = np.concatenate(ids)
            soft = np.flatnonzero(ends[stream[:-1]]) + 1
            found = pack_block(lengths, soft, limit)
            at, size, doc = found["at"], found["length"], found["doc"]
            buffers = [None, pa.py_buffer(np.append(at, len(stream)).astype(np.int32) * 4), pa.py_buffer(stream)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(keys).take(pa.array(doc)),
                    pa.array(found["start"]),
                    pa.array(size),
                    pa.Array.from_buffers(pa.binary(), len(at), buffers),
                    pa.array(lengths[doc]),
                    pa.array(found["sequence"] + next_id),
                    pa.array(found["offset"]),
                ],
                names=schema.names,
            )
            next_id += int(found["sequence"][-1]) + 1
            ids, keys, held = [], [], 0

        for batch in batches:
            begun = 0
            for i, text in enumerate(batch.column(1)):
                ids.append(np.append(encode(encoder, text.as_py()), np.uint32(END_ID)).astype("<u4"))
                held += len(ids[-1])
                if held >= block:
                    keys.append(batch.column(0).slice(begun, i + 1 - begun))
                    begun = i + 1
                    yield from flush()
            if begun < batch.num_rows:
                keys.append(batch.column(0).slice(begun))
        if ids:
            yield from flush()

    return rows.mapInArrow(run, schema)


def pieces(packed: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return packed.select(
        F.col("id").alias(id_name), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
