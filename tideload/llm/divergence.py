"""Audit of how the sources of a language differ in their words.

Words are found through pointers to their starts in the text buffers of a slice of rows. A multikey
sort brings equal words together: pointers are sorted by the next eight bytes of their words, and
only runs of longer words that are still equal are sorted by the eight bytes after. The sort is
stable, so that a run of equal words lists its documents in order and yields its document frequency
and its counts by source in one pass. Spark adds up the runs of all slices.

A word is a run of letters (A-Z, a-z and every sign beyond ASCII), only A-Z folded. A language keeps
the ``V`` terms found in at least ``min_docs`` of its documents. With ``count`` occurrences of a term in
a source and ``N`` of all kept terms, ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``. Sources are compared
pair by pair by the sum of ``|p - q|`` over all kept terms: kept terms are dealt to buckets, a bucket and
up to ``BLOCK`` sources are one table of ``p``, and its partial sums are added up. All numbers are whole.

Defined cases: null texts, languages and sources are empty text; repeated rows are documents of
their own; a source without kept terms has ``p`` from counts of 0, and differs by 0 where its language
keeps none; ties go by the item's bytes; texts beyond ``SLICE_BYTES`` are worked on piece by piece, cut
between words; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideload.llm.common import filled, quoted
from tideload.session import staged

MIN_DOCS = 30
TOP_TERMS = 50
SLICE_BYTES = 4 << 20
# Cells of one table of p, and its sources on one side.
CELLS = 1 << 16
BLOCK = 128

KEY_BYTES = 8
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

COUNT_FIELDS = "lang string, source string, term string, n long, docs long"


def word_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in a buffer of texts that begin at ``offsets`` (the last: its end)."""
    letter = _LETTER[data]
    begins, stops = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    stops[:-1] &= ~letter[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = letter[inner]
    stops[inner - 1] = letter[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _next_key(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of each word as one number, zeros beyond its end."""
    key = np.zeros(len(at), dtype=np.uint64)
    last = len(data) - 1
    for i in range(KEY_BYTES):
        byte = np.where(left > i, data[np.minimum(at + i, last)], 0).astype(np.uint64)
        key = (key << np.uint64(8)) | byte
    return key


def equal_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers with equal words side by side, in ascending order within a run; the place each run begins."""
    lengths = ends - starts
    words, run = np.arange(len(starts)), np.zeros(len(starts), dtype=np.int64)
    depth, parts, firsts, size = 0, [], [], 0

    def settle(found: np.ndarray, label: np.ndarray) -> None:
        nonlocal size
        if len(found):
            parts.append(found)
            firsts.append(size + np.flatnonzero(np.diff(label, prepend=-1)))
            size += len(found)

    while len(words):
        key = _next_key(data, starts[words] + depth, lengths[words] - depth)
        order = np.lexsort((key, run)) if depth else np.argsort(key, kind="stable")
        words, run, key = words[order], run[order], key[order]
        run = np.cumsum(np.concatenate([[False], (key[1:] != key[:-1]) | (run[1:] != run[:-1])]))
        depth += KEY_BYTES
        longer = lengths[words] > depth
        settle(words[~longer], run[~longer])
        words, run = words[longer], run[longer]
        alone = np.bincount(run)[run] == 1 if len(run) else np.zeros(0, dtype=bool)
        settle(words[alone], run[alone])
        words, run = words[~alone], run[~alone]
    return np.concatenate([*parts, np.zeros(0, dtype=np.int64)]), np.concatenate([*firsts, np.zeros(0, dtype=np.int64)])


def count_words(
    raw: np.ndarray, offsets: np.ndarray, groups: np.ndarray
) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a slice; and per term and group of documents: number of the term, group, occurrences, documents."""
    data = _LOWER[raw]
    starts, ends = word_pointers(data, offsets)
    order, firsts = equal_runs(data, starts, ends)
    doc = np.searchsorted(offsets, starts[order], "right") - 1
    term = np.zeros(len(order), dtype=np.int64)
    term[firsts[1:]] = 1
    term = np.cumsum(term)
    # Within a run the documents ascend: a document with a term is one stretch.
    stretch = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    times = np.diff(np.append(stretch, len(order)))
    width = int(groups.max()) + 1 if len(groups) else 1
    pairs, inverse = np.unique(term[stretch] * width + groups[doc[stretch]], return_inverse=True)
    occurrences = np.bincount(inverse, weights=times, minlength=len(pairs)).astype(np.int64)
    documents = np.bincount(inverse, minlength=len(pairs))
    content = data.tobytes()
    begin, end = starts[order[firsts]], ends[order[firsts]]
    terms = [content[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
    return terms, pairs // width, pairs % width, occurrences, documents


def _pieces(raw: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``limit`` bytes, cut where no word is."""
    at = 0
    while at < len(raw):
        end = min(at + limit, len(raw))
        while end < len(raw) and _LETTER[raw[end]]:
            step = ~_LETTER[raw[end : end + limit]]
            end += int(step.argmax()) if step.any() else len(step)
        yield raw[at:end]
        at = end


def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Occurrences and documents of each term by language and source; the empty term stands for the group itself."""
    rows = docs.select(
        filled(quoted(lang_col)).alias("lang"), filled(quoted(source_col)).alias("source"), filled(quoted(text_col)).alias("text")
    )

    def result(langs, sources, terms, term, group, n, documents) -> pa.RecordBatch:
        names = pa.array(terms, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs).take(pa.array(group)), pa.array(sources).take(pa.array(group)), names.take(pa.array(term)),
             pa.array(n), pa.array(documents)],
            names=["lang", "source", "term", "n", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            known = {pair: i for i, pair in enumerate(dict.fromkeys(zip(langs, sources, strict=True)))}
            if not known:
                continue
            groups = np.array([known[pair] for pair in zip(langs, sources, strict=True)])
            langs, sources = zip(*known, strict=True)
            count, none = len(known), np.zeros(len(known), dtype=np.int64)
            yield result(langs, sources, [b""], none, np.arange(count), none, none)
            text = batch.column(2)
            wide = pa.types.is_large_string(text.type)
            offsets = np.frombuffer(text.buffers()[1], dtype=np.int64 if wide else np.int32)
            offsets = offsets[text.offset : text.offset + len(text) + 1].astype(np.int64)
            content = text.buffers()[2]
            data = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, dtype=np.uint8)
            at = 0
            while at < len(text):
                after = max(at + 1, int(np.searchsorted(offsets, offsets[at] + slice_bytes, "right")) - 1)
                own = offsets[at : after + 1]
                if own[-1] - own[0] <= slice_bytes:
                    found = count_words(data[own[0] : own[-1]], own - own[0], groups[at:after])
                    if found[0]:
                        yield result(langs, sources, *found)
                else:
                    seen: set[bytes] = set()
                    for piece in _pieces(data[own[0] : own[-1]], slice_bytes):
                        found = count_words(piece, np.array([0, len(piece)]), groups[at:after])
                        if found[0]:
                            new = np.array([t not in seen for t in found[0]], dtype=np.int64)
                            seen.update(found[0])
                            yield result(langs, sources, *found[:4], new[found[1]])
                at = after

    found = rows.mapInArrow(run, COUNT_FIELDS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(count: str, total: str) -> F.Column:
    """``p`` of a count; whole numbers of up to 38 digits."""
    return F.expr(f"1 + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({count} + 5 AS DECIMAL(20,0))) div ({total} + 5 * v)")


def _partial_sums(table: pa.Table) -> pa.Table:
    """Sums of |p - q| over the terms of a bucket, for the sources of a block with every other source."""
    lang, block = table.column("lang")[0], table.column("block")[0].as_py()
    term = table.column("term").combine_chunks()
    base = term.is_null().to_numpy(zero_copy_only=False)
    names = table.column("source").combine_chunks()
    p = table.column("p").to_numpy()
    # The rows without a term give p of a count of 0.
    known = names.filter(pa.array(base))
    order = pa.compute.sort_indices(known)
    known = known.take(order)
    zero = p[base][order.to_numpy()]
    place = pa.compute.index_in(names, known).to_numpy(zero_copy_only=False)[~base]
    codes = term.filter(pa.array(~base)).dictionary_encode()
    cells = np.tile(zero, (len(codes.dictionary), 1))
    cells[codes.indices.to_numpy(), place] = p[~base]
    first, after = block * BLOCK, min(len(known), (block + 1) * BLOCK)
    sums = np.array([np.abs(cells - cells[:, a : a + 1]).sum(axis=0) for a in range(first, after)]).reshape(-1, len(known))
    ours, theirs = np.divmod(np.arange(sums.size), len(known))
    other = ours + first != theirs
    return pa.table(
        {"lang": pa.array([lang.as_py()] * int(other.sum()), pa.string()), "source": known.take(pa.array(ours[other] + first)),
         "item": known.take(pa.array(theirs[other])), "value": pa.array(sums.reshape(-1)[other])}
    )


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    cells: int = CELLS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: the other sources of the language, farthest first, and the terms a source overuses."""
    counts = staged(count_terms(docs, text_col, lang_col, source_col), "terms")
    kept = (
        counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    ).where(F.col("docs") >= min_docs)
    kept = staged(kept.drop("docs"), "kept-terms")
    used = staged(counts.join(kept, ["lang", "term"]).where("n > 0").drop("docs"), "used-terms")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = counts.where("term = ''").select("lang", "source")
    width = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("width"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(width, "lang").join(languages, "lang", "left")
    # One row per group.
    groups = staged(groups.fillna(0, ["total", "v", "lang_total"]), "groups")

    rows = used.join(groups, ["lang", "source"])
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (
        rows.select("lang", "source", F.col("term").alias("item"), (_p("n", "total") - _p("lang_n", "lang_total")).alias("value"))
        .where("value > 0")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top_terms)
    )

    buckets = F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("width") / cells)).cast("int")
    blocks = F.explode(F.sequence(F.lit(0), F.ceil(F.col("width") / BLOCK).cast("int") - 1))
    zero = F.when(F.col("v") > 0, F.expr("1 + CAST(5000000000 AS BIGINT) div (total + 5 * v)")).otherwise(0)
    base = groups.select(
        "lang", "source", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"), F.lit(None).cast("string").alias("term"),
        zero.alias("p"), "width",
    )
    dealt = rows.select(
        "lang", "source", F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "term", _p("n", "total").alias("p"), "width"
    )
    tables = base.unionByName(dealt).select("lang", "source", "bucket", "term", "p", blocks.alias("block"))
    sums = tables.groupBy("lang", "bucket", "block").applyInArrow(
        _partial_sums, "lang string, source string, item string, value long"
    )
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
