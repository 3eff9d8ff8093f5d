"""Substring deduplication by collinear chaining of shared k-mers.

Texts become words (lower-cased, cut at ASCII white space) and words become hashes. Of every
``WINNOW`` neighbouring k-mers of ``K`` words the one with the least hash is a seed, so any run
of ``K + WINNOW - 1`` equal words shares one; how many passages with scattered unequal words are
found so is measured by a test. Each seed has one holder first, the document with the
smallest id that has it. Every place of it in another document is linked to one place in the
holder, the first to the first, the second to the second and so on, and from the start again
if the holder has fewer: the links (anchors) are linear in a seed's places, however many there are.

Places near a shared seed that no passage so found covers are linked once more, by longer keys: runs and distant pairs
of seeds, each to the smallest document that has the key. Where several documents hold a part of a passage each, they
have its seeds first, but not the keys across the parts. Places with the same seeds around them count as one class,
with the smallest document for the rest (see ``further_anchors``). These links too are linear in the places.

The anchors of a document and a holder are chained: f(i) = K + the best of 0 and
f(j) - GAP_COST * (words skipped in both texts) over the anchors j before i in both, which a
Fenwick tree over the holder's places answers, and chains are cut at gaps over ``MAX_GAP``
words. The words of both sides of a chain are fetched and aligned between its anchors and
beyond its ends. A passage of at least ``min_words`` words on both sides and at least
``min_identity`` equal words is found, as a whole or, if the whole is too unlike, the parts
between long unequal stretches.

Defined cases: rows without an id take no part; null and empty texts and texts under ``K`` words
have no seeds; an id names one text, so repeated rows count once; repeats inside one document
are not looked for; an empty table gives an empty result. Ids are whole numbers. Only id and text are
read, so other columns may have the names of results; a text has fewer than 2**26 words.

A passage has its holders by key, not all it has; so one inside another may lack holders. Not found: passages with unequal
words all of whose keys some smaller documents with a part have; passages whose seeds that no first holder accounts
for span under ``FURTHER_SPAN`` words; passages that another document of its class does not have, for words between
the seeds; and nine in ten only from 55 words at 0.82 equal words, or 100 at 0.8, on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideload.files import remove_folder
from tideload.llm.common import filled, quoted
from tideload.session import fresh_dir, staged, without_old_shuffles

K = 5
WINNOW = 4
GAP_COST = 0.05
MAX_GAP = 40
MARGIN = 40
# Words that a chain spans at least: two seeds. With a margin it can hold a passage of MIN_WORDS.
LEAST_SPAN = 8
LONG_UNEQUAL = 8
MIN_WORDS = 45
# Words that a chain of further links spans at least: less is a short line that many texts have.
FURTHER_SPAN = 20
# Keys of the further links: runs of so many seeds, and pairs so many words apart.
RUNS = (4, 8, 16)
APART = (15, 30)
MIN_IDENTITY = 0.8
SLICE_BYTES = 2 << 20
PLACE_BITS = 26  # words a slice can have

_WORD_BASE = np.uint64(0x100000001B3)
_KMER_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, and the text each belongs to."""
    data = np.frombuffer(b"".join(t + b" " for t in texts), dtype=np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    space = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    low = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    ends = np.r_[starts[1:], len(data)]
    within = np.arange(starts[0], len(data)) - np.repeat(starts, ends - starts)
    power = np.cumprod(np.r_[np.uint64(1), np.full(int(within.max()), _WORD_BASE)], dtype=np.uint64)
    value = (low[starts[0] :].astype(np.uint64) + np.uint64(1)) * power[within]
    value[space[starts[0] :]] = 0
    hashed = _mixed(np.add.reduceat(value, starts - starts[0]))
    return hashed, np.searchsorted(text_ends, starts, side="right")


def seeds_of(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (of their first word) and hashes of the seeds of all texts."""
    count = len(words) - K + 1
    if count < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    kmer = np.zeros(count, dtype=np.uint64)
    for i in range(K):
        kmer = kmer * _KMER_BASE + words[i : i + count]
    kmer = _mixed(kmer)
    place_mask = np.uint64((1 << PLACE_BITS) - 1)
    whole = owner[:count] == owner[K - 1 :]
    ranked = (kmer & ~place_mask) | np.arange(count, dtype=np.uint64)
    ranked[~whole] = np.uint64(0xFFFFFFFFFFFFFFFF)
    # A text with fewer k-mers than a window has one window.
    at = np.flatnonzero(whole)
    if not len(at):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    first = np.flatnonzero(np.r_[True, owner[at][1:] != owner[at][:-1]])
    least = [np.minimum.reduceat(ranked[at], first)]
    if count >= WINNOW:
        window, size = ranked, 1
        while size < WINNOW:
            step = min(size, WINNOW - size)
            window, size = np.minimum(window[:-step], window[step:]), size + step
        same = owner[: len(window)] == owner[WINNOW - 1 + K - 1 : WINNOW - 1 + K - 1 + len(window)]
        least.append(window[same])
    place = np.unique(np.concatenate(least) & place_mask).astype(np.int64)
    return place, kmer[place]


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive whole texts of a batch, about SLICE_BYTES at a time, with the row of the first."""
    texts, held, begun = [], 0, 0
    for i, text in enumerate(batch.column(column)):
        texts.append(text.as_py().encode("utf-8", "surrogatepass"))
        held += len(texts[-1])
        if held >= SLICE_BYTES:
            yield begun, texts
            texts, held, begun = [], 0, i + 1
    if texts:
        yield begun, texts


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(quoted(id_col).cast("long").alias("doc"), filled(quoted(text_col)).alias("text"))
    return rows.where(F.col("doc").isNotNull())


def _occurrences(owner: np.ndarray, kmer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each seed, how many equal ones come before it in its text, and how many there are in all."""
    order = np.lexsort((kmer, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (kmer[order][1:] == kmer[order][:-1])
    first = np.flatnonzero(np.r_[True, ~same]) if len(order) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.r_[first, len(order)])
    nth, times = np.empty(len(order), dtype=np.int32), np.empty(len(order), dtype=np.int32)
    nth[order] = np.arange(len(order)) - np.repeat(first, sizes)
    times[order] = np.repeat(sizes, sizes)
    return nth, times


def seed_table(rows: DataFrame) -> DataFrame:
    """``seed, doc, at, nth, times`` of every seed: its how-manieth place in the document, of how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy()
            for begun, texts in _texts(batch, 1):
                words, owner = word_hashes(texts)
                place, kmer = seeds_of(words, owner)
                own = owner[place]
                first = np.searchsorted(owner, np.arange(len(texts)))
                nth, times = _occurrences(own, kmer)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kmer.view(np.int64)),
                        pa.array(doc[begun + own]),
                        pa.array((place - first[own]).astype(np.int32)),
                        pa.array(nth),
                        pa.array(times),
                    ],
                    names=["seed", "doc", "at", "nth", "times"],
                )

    return rows.select("doc", "text").mapInArrow(run, "seed long, doc long, at int, nth int, times int")


def _paired(high: str, low: str) -> Column:
    """Two whole numbers of 31 bits in a long, which hash aggregates and shuffles more cheaply than a struct."""
    return F.shiftleft(F.col(high).cast("long"), 32).bitwiseOR(F.col(low).cast("long"))


def _parted(pair: str, high: str, low: str) -> list[Column]:
    return [F.shiftright(pair, 32).cast("int").alias(high), F.col(pair).bitwiseAND((1 << 32) - 1).cast("int").alias(low)]


def shared_seeds(seeds: DataFrame) -> DataFrame:
    """``doc, at, seed, holder, holder_at, more``: every place of the seeds that several documents have.

    ``holder``: the smallest document with the seed (maybe this one), ``holder_at``: the place there that this one is
    linked to; ``more``: three documents or more have the seed.
    """
    first = (
        seeds.where("nth = 0")  # one row per document
        .groupBy("seed")
        .agg(
            F.min("doc").alias("holder"),
            F.max("doc").alias("last"),
            F.min_by(_paired("times", "at"), "doc").alias("first"),
            (F.count(F.lit(1)) > 2).alias("more"),
        )
        .where("holder < last")
        .select("seed", "holder", *_parted("first", "held", "holder_at"), "more")
    )
    # Written, so that both sides of the join are plain exchanges, whose hot partitions are split at run time.
    first = staged(first, "holders")
    # Few seeds repeat inside a text: all their places in the holder are looked up.
    several = first.where("held > 1").select("seed", F.col("holder").alias("doc"))
    theirs = seeds.where("times > 1").join(several, ["seed", "doc"]).groupBy("seed").agg(F.sort_array(F.collect_set(_paired("nth", "at"))).alias("all_at"))
    once = first.where("held = 1").withColumn("all_at", F.lit(None).cast("array<long>"))
    holders = once.unionByName(first.where("held > 1").join(theirs, "seed"))
    places = seeds.select("seed", "doc", _paired("nth", "at").alias("place"))
    nth = (F.shiftright("place", 32) % F.col("held")).cast("int")
    found = F.when(F.col("held") == 1, F.col("holder_at")).otherwise(F.get("all_at", nth).bitwiseAND((1 << 32) - 1).cast("int"))
    return places.join(holders, "seed").select("doc", _parted("place", "nth", "at")[1], "seed", "holder", found.alias("holder_at"), "more")


def by_document(shared: DataFrame) -> DataFrame:
    """One row per document: its shared places in order, as arrays."""
    kinds = dict(zip(SHARED, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, 1):
            doc, at = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            # Repeated rows give a place twice.
            own = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])])
            doc = doc[own]
            begun = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            ends = pa.array(np.r_[begun, len(own)].astype(np.int32))
            columns = [rows.column(i).to_numpy(zero_copy_only=False)[own] for i in range(1, len(SHARED))]
            lists = [pa.ListArray.from_arrays(ends, pa.array(c, k)) for c, k in zip(columns, list(kinds.values())[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(doc[begun]), *lists], names=SHARED)

    placed = shared.repartition("doc").sortWithinPartitions("doc", "at")
    return placed.mapInArrow(run, "doc long, at array<int>, seed array<long>, holder array<long>, holder_at array<int>, more array<boolean>")


SHARED = ["doc", "at", "seed", "holder", "holder_at", "more"]


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows in parts that hold all rows of an equal start of ``keys`` columns."""
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        last = np.logical_and.reduce([c == c[-1] for c in columns])
        split = int(np.argmax(last))  # the last group goes on to the end
        if not split and carry and all(carry[-1].column(i)[-1] == batch.column(i)[0] for i in range(keys)):
            carry.append(batch)
            continue
        if carry or split:
            yield pa.concat_batches([*carry, batch.slice(0, split)])
        carry = [batch.slice(split)]
    if carry:
        yield pa.concat_batches(carry)


def _few_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row holds a document's arrays: some hundreds at a time, to bound the memory of a worker."""
    for batch in batches:
        for at_row in range(0, batch.num_rows, 512):
            yield batch.slice(at_row, 512)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists of a column, and the row each belongs to."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def first_chains(shared: DataFrame, least: int) -> DataFrame:
    """The chains (see ``chains``) of the links of every shared place to the first holder of its seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_documents(batches):
            ids = batch.column(0).to_numpy()
            at, row = _flat(batch.column(1))
            holder, holder_at = _flat(batch.column(2))[0], _flat(batch.column(3))[0]
            doc = ids[row]
            order = np.flatnonzero(doc > holder)
            order = order[np.lexsort((holder_at[order], at[order], holder[order], row[order]))]
            if len(order):
                yield from _chained(doc[order], at[order], holder[order], holder_at[order], least)

    return shared.select("doc", "at", "holder", "holder_at").mapInArrow(run, CHAIN_FIELDS)


def _within(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which places lie in one of the stretches, ends included."""
    begun, end = np.searchsorted(at, low), np.searchsorted(at, high, side="right")
    some = begun < end
    change = np.bincount(begun[some], minlength=len(at) + 1) - np.bincount(end[some], minlength=len(at) + 1)
    return np.cumsum(change[:-1]) > 0


def _open_groups(at: np.ndarray, seed: np.ndarray, asks: np.ndarray, more: np.ndarray, start: np.ndarray, end: np.ndarray, exact: np.ndarray, reach: int):
    """Of shared places in order, where passages were found: their groups' first ones and contents, which places are open, and which are kept."""
    first = np.flatnonzero(np.r_[True, np.diff(at) > MAX_GAP])
    sizes = np.diff(np.r_[first, len(at)])
    last = first + sizes - 1
    bare = at[asks & more & ~_within(at, start, end - K)]
    near = np.searchsorted(bare, at + reach, side="right") > np.searchsorted(bare, at - reach)
    tokens = _mixed(seed.view(np.uint64) + (at - np.repeat(at[first], sizes)).astype(np.uint64) * _KMER_BASE)
    # A seed of two documents has had its one link; only with others around it can that become part of a longer chain.
    opened = near & asks & np.repeat(np.logical_or.reduceat(near & asks & more, first), sizes)
    # What lies well inside an equal passage, its smaller document has too.
    start, end = start[exact], end[exact]
    of = np.clip(np.searchsorted(at[first], start, side="right") - 1, 0, None), np.clip(np.searchsorted(at[first], end, side="right") - 1, 0, None)
    low = np.where(at[first[of[0]]] < start, start + reach, start)
    low = np.where((start > at[last[of[0]]]) | (at[first[of[0]]] >= start), start, low)
    high = np.where(at[last[of[1]]] + K > end, end - reach, end) - K
    return first, _mixed(np.add.reduceat(tokens, first)).view(np.int64), opened, near | ~_within(at, low, high)


def neighbourhoods(shared: DataFrame, found: DataFrame, min_words: int) -> DataFrame:
    """``doc, content, at, seed, open`` of the groups of shared places, in arrays; a group goes on up to gaps over ``MAX_GAP``.

    ``open``: the place is within ``min_words`` words of a shared one that no passage of ``found`` covers, and has
    smaller documents. ``content``: one number for all its seeds and their distances. Left out are groups that lie
    well inside passages that are equal word for word: the smaller document has them.
    """
    spans = found.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end", (F.col("identity") == 1).alias("exact")))).alias("spans"))
    spans = spans.select("doc", *[F.col(f"spans.{c}").alias(c) for c in ("start", "end", "exact")])
    packed = shared if dict(shared.dtypes)["at"] == "array<int>" else by_document(shared)
    joined = packed.join(spans, "doc", "left").select(*SHARED, "start", "end", "exact")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_documents(batches):
            ids = batch.column(0).to_numpy()
            at, row = _flat(batch.column(1))
            seed, holder, more = (_flat(batch.column(i))[0] for i in (2, 3, 5))
            (start, span_row), end, exact = _flat(batch.column(6)), _flat(batch.column(7))[0], _flat(batch.column(8))[0].astype(bool)
            # All documents on one line, further apart than anything reaches.
            length = np.zeros(len(ids), dtype=np.int64)
            np.maximum.at(length, row, at)
            np.maximum.at(length, span_row, end)
            begun = np.cumsum(length + 4 * (min_words + MAX_GAP)) - length
            line, low, high = at + begun[row], start + begun[span_row], end + begun[span_row]
            first, content, opened, kept = _open_groups(line, seed, ids[row] > holder, more, low, high, exact, min_words)
            sizes = np.diff(np.r_[first, len(at)])
            used = np.logical_or.reduceat(kept, first)
            take = np.repeat(used, sizes)
            ends = pa.array(np.r_[0, np.cumsum(sizes[used])].astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[take])) for x in (at, seed, opened)]
            columns = [pa.array(ids[row[first[used]]]), pa.array(content[used])]
            yield pa.RecordBatch.from_arrays([*columns, *lists], names=["doc", "content", "at", "seed", "open"])

    return joined.mapInArrow(run, "doc long, content long, at array<int>, seed array<long>, open array<boolean>")


def further_anchors(groups: DataFrame) -> DataFrame:
    """``doc, at, holder, holder_at``: links of the open places to smaller documents, linear in the places.

    Groups with the same seeds at the same distances are a class. The smallest document of a class stands for it: the
    rest of the class is linked to it, and it to others by its keys (see ``_keys``), each to the smallest
    document with the key, the first and the last place of a key to those there.
    """
    classes = groups.groupBy("content").agg(F.min("doc").alias("holder"))
    same, opened = F.col("doc") == F.col("holder"), F.array_contains("open", True)
    placed = staged(groups.join(staged(classes, "classes"), "content").where(same | opened), "groups")
    # A document may have a group twice.
    reps = placed.where(same).groupBy("content", "doc").agg(F.min(F.struct("at", "seed", "open")).alias("g"))
    reps = staged(reps.select("content", "doc", "g.*"), "representatives")
    theirs = reps.select("content", F.col("at").alias("holder_at"))
    members = placed.where(~same).join(theirs, "content").select("doc", "holder", F.inline(F.filter(F.arrays_zip("open", "at", "holder_at"), lambda x: x["open"])))
    each = reps.select("doc", "content", F.inline(F.arrays_zip("at", "seed", "open")))
    wanted = staged(each.where("open").select("seed").distinct(), "open-seeds")
    keys = staged(_keys(each.join(wanted, "seed", "left_semi")), "keys")
    first = keys.where("first").groupBy("key").agg(
        F.min("doc").alias("holder"), F.max("doc").alias("last"), F.min_by(_paired("at", "end"), "doc").alias("held"), F.max("open").alias("open"),
    )
    first = first.where("holder < last AND open").select("key", "holder", *_parted("held", "holder_at", "holder_end"))
    linked = keys.where("open").join(staged(first, "key-holders"), "key").where("doc > holder")
    ends = F.array(*[F.struct(F.col(a).alias("at"), F.col(b).alias("holder_at")) for a, b in (("at", "holder_at"), ("end", "holder_end"))])
    columns = ["doc", "at", "holder", "holder_at"]
    return members.select(*columns).unionByName(linked.select("doc", "holder", F.inline(ends)).select(*columns).distinct())


def _keys(places: DataFrame) -> DataFrame:
    """``key, doc, at, end, open, first`` of every place, within its group, and the last place of the key.

    Keys are all runs of ``RUNS`` seeds that follow each other, whatever words lie between, and pairs with the
    first seeds that are ``APART`` words away. A long run is in those documents only
    that have its words, a pair also where words between them differ. ``first``: the document's first place of the key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches, 1):
            doc, content, at = (batch.column(i).to_numpy() for i in range(3))
            seed, opened = batch.column(3).to_numpy().view(np.uint64), batch.column(4).to_numpy(zero_copy_only=False)
            n = len(at)
            begun = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (content[1:] != content[:-1]) | (np.diff(at) > MAX_GAP + max(APART))])
            sizes = np.diff(np.r_[begun, n])
            stop = np.repeat(begun + sizes, sizes)
            # All groups on one line.
            length = at[begun + sizes - 1] - at[begun] + 2 * max(APART)
            line = at + np.repeat(np.cumsum(length) - length - at[begun], sizes)
            parts = []
            runs, size = _mixed(seed), 1
            while 2 * size <= max(RUNS):
                i = np.arange(max(0, n - 2 * size + 1))
                runs = _mixed(runs[i] * _KMER_BASE + runs[i + size])
                size *= 2
                if size in RUNS:
                    whole = i[i + size <= stop[i]]
                    parts.append((size, runs[whole], whole, whole + size - 1))
            for apart in APART:
                j = np.searchsorted(line, line + apart)
                i = np.flatnonzero(j < stop)
                parts.append((100 + apart, seed[i] * _KMER_BASE + _mixed(seed[j[i]]), i, j[i]))
            key = np.concatenate([_mixed(k + np.uint64(kind) * _WORD_BASE) for kind, k, _, _ in parts])
            i, j = (np.concatenate([part[at_part] for part in parts]) for at_part in (2, 3))
            order = np.lexsort((i, doc[i], key))
            first = np.zeros(len(key), dtype=bool)
            new = (key[order][1:] != key[order][:-1]) | (doc[i[order]][1:] != doc[i[order]][:-1])
            first[order[np.flatnonzero(np.r_[len(key) > 0, new])]] = True
            columns = [key.view(np.int64), doc[i], at[i], at[j], opened[i] | opened[j], first]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "doc", "at", "end", "open", "first"])

    placed = places.repartition("doc").sortWithinPartitions("doc", "at").select("doc", "content", "at", "seed", "open")
    return placed.mapInArrow(run, "key long, doc long, at int, end int, open boolean, first boolean")


def chain(b: np.ndarray, a: np.ndarray) -> list[np.ndarray]:
    """Collinear chains of anchors (in the order of ``b``, then ``a``), best first, as lists of places."""
    n = len(b)
    db, da = np.diff(b), np.diff(a)
    if n == 1 or ((db > 0) & (da > 0) & (db <= MAX_GAP) & (da <= MAX_GAP)).all():
        return [np.arange(n)]  # already one chain: every step gains more than its gap costs
    ranks = np.searchsorted(np.unique(a), a) + 1
    size = int(ranks.max())
    tree = [(-1e18, -1)] * (size + 1)
    best, source = [0.0] * n, [-1] * n
    b_list, a_list, rank_list = b.tolist(), a.tolist(), ranks.tolist()
    done = 0
    for i in range(n):
        # Anchors with a smaller place in the document enter the tree; equal ones can't precede.
        while b_list[done] < b_list[i]:
            value = best[done] + GAP_COST * (b_list[done] + a_list[done])
            at = rank_list[done]
            while at <= size:
                if tree[at][0] < value:
                    tree[at] = (value, done)
                at += at & -at
            done += 1
        top, j = -1e18, -1
        at = rank_list[i] - 1
        while at > 0:
            if tree[at][0] > top:
                top, j = tree[at]
            at -= at & -at
        gain = top - GAP_COST * (b_list[i] + a_list[i])
        if j >= 0 and gain > 0:
            best[i], source[i] = K + gain, j
        else:
            best[i] = K
    used = [False] * n
    chains = []
    for end in np.argsort(-np.array(best), kind="stable").tolist():
        members = []
        at = end
        while at >= 0 and not used[at]:
            used[at] = True
            members.append(at)
            at = source[at]
        if members:
            members = np.array(members[::-1])
            wide = (np.diff(b[members]) > MAX_GAP) | (np.diff(a[members]) > MAX_GAP)
            chains.extend(np.split(members, np.flatnonzero(wide) + 1))
    return chains


CHAIN_FIELDS = "doc long, holder long, start int, end int, holder_start int, holder_end int, at array<int>, holder_at array<int>"


def _chained(doc: np.ndarray, at: np.ndarray, holder: np.ndarray, holder_at: np.ndarray, least: int, gap: int | None = None) -> Iterator[pa.RecordBatch]:
    """The chains of sorted anchors; with ``gap``, of those between wider gaps each, in the texts and between diagonals."""
    names = [f.split()[0] for f in CHAIN_FIELDS.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.list_(pa.int32()), pa.list_(pa.int32())]
    apart = (doc[1:] != doc[:-1]) | (holder[1:] != holder[:-1])
    if gap is not None and len(doc):
        # A step of a chain skips ``gap`` words at most on either side, so it changes the diagonal by no more.
        group, diagonal = np.cumsum(np.r_[False, apart]), at.astype(np.int64) - holder_at
        order = np.lexsort((diagonal, group))
        group, diagonal = group[order], diagonal[order]
        band = np.empty(len(doc), dtype=np.int64)
        band[order] = np.cumsum(np.r_[False, (group[1:] != group[:-1]) | (np.diff(diagonal) > gap)])
        order = np.argsort(band, kind="stable")  # within a band still by place
        doc, at, holder, holder_at, band = (x[order] for x in (doc, at, holder, holder_at, band))
        apart = (band[1:] != band[:-1]) | (np.diff(at) > gap)
    change = np.flatnonzero(apart) + 1
    begins, ends = np.r_[0, change], np.r_[change, len(doc)]
    wide = at[ends - 1] + K - at[begins] >= least
    found = []
    for begun, end in zip(begins[wide], ends[wide], strict=True):
        b, a = at[begun:end], holder_at[begun:end]
        for members in chain(b, a):
            own, theirs = b[members], a[members]
            if own[-1] + K - own[0] >= least and theirs[-1] + K - theirs[0] >= least:
                found.append((doc[begun], holder[begun], own[0], own[-1] + K, theirs[0], theirs[-1] + K, own, theirs))
    for at_row in range(0, len(found), 5000):
        part = zip(*found[at_row : at_row + 5000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(part, kinds, strict=True)], names=names)


def chains(anchor_rows: DataFrame, least: int) -> DataFrame:
    """One row per chain that spans ``least`` words in both documents; ends are exclusive."""
    placed = anchor_rows.repartition("doc").sortWithinPartitions("doc", "holder", "at", "holder_at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, 2):
            doc, holder, at, holder_at = (c.to_numpy() for c in rows.columns)
            yield from _chained(doc, at, holder, holder_at, least, MAX_GAP)

    return placed.select("doc", "holder", "at", "holder_at").mapInArrow(run, CHAIN_FIELDS)


def segments(rows: DataFrame, chain_rows: DataFrame) -> DataFrame:
    """``doc, start, end, words``: the 32-bit word hashes of every stretch that a chain asks for, with margins."""
    asked = (
        chain_rows.select("doc", "start", "end")
        .unionByName(chain_rows.select(F.col("holder").alias("doc"), F.col("holder_start").alias("start"), F.col("holder_end").alias("end")))
        .distinct()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, words = None, None
        for batch in batches:
            cut = []
            for content, start, end in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                content = content.as_py()
                if content != text:
                    text, words = content, word_hashes([content.encode("utf-8", "surrogatepass")])[0].astype("<u4")
                cut.append(words[max(0, start.as_py() - MARGIN) : end.as_py() + MARGIN].tobytes())
            arrays = [batch.column(0), batch.column(2), batch.column(3), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "start", "end", "words"])

    # Repeated rows become one; the join needs no further exchange of the texts.
    once = rows.groupBy("doc").agg(F.min("text").alias("text"))
    joined = once.join(asked, "doc").select("doc", "text", "start", "end")
    return joined.mapInArrow(run, "doc long, start int, end int, words binary")


def _common(b: np.ndarray, a: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    if not len(b) or not len(a):
        return 0
    row = np.zeros(len(a) + 1, dtype=np.int64)
    for word in b:
        step = np.where(a == word, row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(np.maximum(step, row[1:]))
    return int(row[-1])


def _stretch(b: np.ndarray, a: np.ndarray) -> tuple[int, int]:
    """How far an ungapped alignment from the start of both pays, and its equal words."""
    n = min(len(b), len(a))
    if not n:
        return 0, 0
    same = b[:n] == a[:n]
    worth = np.cumsum(np.where(same, 1, -2))
    top = int(worth.argmax())
    return (top + 1, int(same[: top + 1].sum())) if worth[top] > 0 else (0, 0)


def align(
    b: np.ndarray, a: np.ndarray, at: np.ndarray, holder_at: np.ndarray, min_words: int, min_identity: float
) -> list[tuple[int, int, int, int, int]]:
    """Passages along a chain: start and end in ``b`` and ``a``, equal words.

    ``at``, ``holder_at``: places of the anchors, each ``K`` equal words, in ``b`` and ``a``.
    """
    # Blocks: (start, end, holder start, holder end, equal words), in order, without holes.
    blocks: list[tuple[int, int, int, int, int]] = []
    out, equal = _stretch(b[: at[0]][::-1], a[: holder_at[0]][::-1])
    if out:
        blocks.append((at[0] - out, at[0], holder_at[0] - out, holder_at[0], equal))
    db, da = np.diff(at), np.diff(holder_at)
    straight = db == da
    begun = 0
    while begun < len(at):
        end = begun
        while end < len(straight) and straight[end]:
            end += 1
        b0, b1, a0, a1 = int(at[begun]), int(at[end]) + K, int(holder_at[begun]), int(holder_at[end]) + K
        same = b[b0:b1] == a[a0:a1]
        unequal = np.flatnonzero(~same)
        # Long unequal stretches become blocks of their own.
        cuts = np.split(unequal, np.flatnonzero(np.diff(unequal) > 1) + 1) if len(unequal) else []
        done = 0
        for run in cuts:
            if len(run) >= LONG_UNEQUAL:
                if run[0] > done:
                    blocks.append((b0 + done, b0 + run[0], a0 + done, a0 + run[0], int(same[done : run[0]].sum())))
                blocks.append((b0 + run[0], b0 + run[-1] + 1, a0 + run[0], a0 + run[-1] + 1, 0))
                done = int(run[-1]) + 1
        blocks.append((b0 + done, b1, a0 + done, a1, int(same[done:].sum())))
        if end < len(straight):
            nb, na = int(at[end + 1]), int(holder_at[end + 1])
            if nb >= b1 and na >= a1:
                blocks.append((b1, nb, a1, na, _common(b[b1:nb], a[a1:na])))
            else:  # the next anchor overlaps this one on one side: give the overlap up
                over = max(b1 - nb, a1 - na)
                last = blocks[-1]
                blocks[-1] = (last[0], last[1] - over, last[2], last[3] - over, max(0, last[4] - over))
                blocks.append((b1 - over, nb, a1 - over, na, 0))
        begun = end + 1
    b_end, a_end = int(at[-1]) + K, int(holder_at[-1]) + K
    out, equal = _stretch(b[b_end:], a[a_end:])
    if out:
        blocks.append((b_end, b_end + out, a_end, a_end + out, equal))

    def passage(part: list[tuple[int, int, int, int, int]]) -> tuple[int, int, int, int, int] | None:
        b0, b1, a0, a1 = part[0][0], part[-1][1], part[0][2], part[-1][3]
        equal = sum(x[4] for x in part)
        if min(b1 - b0, a1 - a0) < min_words or equal < min_identity * max(b1 - b0, a1 - a0):
            return None
        return b0, b1, a0, a1, equal

    whole = passage(blocks)
    if whole:
        return [whole]
    parts, own = [], []
    for x in blocks:
        if max(x[1] - x[0], x[3] - x[2]) - x[4] >= LONG_UNEQUAL and 2 * x[4] < max(x[1] - x[0], x[3] - x[2]):
            parts.append(own)
            own = []
        else:
            own.append(x)
    parts.append(own)
    return [found for part in parts if part and (found := passage(part))]


PASSAGE_FIELDS = (
    "doc long, start int, end int, holder long, holder_start int, holder_end int, equal_words int, identity double"
)


def shared_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    min_identity: float = MIN_IDENTITY,
) -> DataFrame:
    """One row per passage of a document (by words, ends exclusive) and holder, a document with a smaller id that has it too."""
    rows = _rows(docs, id_col, text_col)
    spark = docs.sparkSession
    with without_old_shuffles(spark):  # each step is written, and its exchanges are needed no more
        folder = fresh_dir(spark, "seeds")
        seeds = staged(seed_table(rows), "seeds", folder)
        places = staged(shared_seeds(seeds), "shared-seeds", shared_folder := fresh_dir(spark, "shared-seeds"))
        remove_folder(spark, folder)  # most seeds are in one document only
        shared = staged(by_document(places), "documents")
        remove_folder(spark, shared_folder)
        chained = staged(first_chains(shared, max(K, min(LEAST_SPAN, min_words))), "chains")
        found = staged(_aligned(rows, chained, min_words, min_identity), "passages")
        # What the first holders do not account for is linked to the other documents that have its seeds.
        groups = staged(neighbourhoods(shared, found, min_words), "neighbourhoods")
        further = staged(chains(further_anchors(groups), max(K, min(FURTHER_SPAN, min_words))), "further-chains")
        more = staged(_aligned(rows, further, min_words, min_identity), "further-passages")
    before = found.alias("b")
    within = [F.col(f"m.{c}") == F.col(f"b.{c}") for c in ("doc", "holder")]
    within += [F.col(f"m.{c}") >= F.col(f"b.{c}") for c in ("start", "holder_start")]
    within += [F.col(f"m.{c}") <= F.col(f"b.{c}") for c in ("end", "holder_end")]
    return found.unionByName(more.alias("m").join(before, within, "left_anti"))


def _aligned(rows: DataFrame, chained: DataFrame, min_words: int, min_identity: float) -> DataFrame:
    """The passages along some chains."""
    fetched = staged(segments(rows, chained), "segments")
    theirs = fetched.select(
        F.col("doc").alias("holder"), F.col("start").alias("holder_start"), F.col("end").alias("holder_end"), F.col("words").alias("holder_words")
    )
    joined = chained.join(fetched, ["doc", "start", "end"]).join(theirs, ["holder", "holder_start", "holder_end"])
    joined = joined.select("doc", "holder", "start", "holder_start", "at", "holder_at", "words", "holder_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PASSAGE_FIELDS.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        for batch in batches:
            found = []
            for scalars in zip(*batch.columns, strict=True):
                doc, holder, start, holder_start = (x.as_py() for x in scalars[:4])
                at, holder_at = (x.values.to_numpy() for x in scalars[4:6])
                b, a = (np.frombuffer(x.as_py(), dtype="<u4") for x in scalars[6:])
                low, holder_low = max(0, start - MARGIN), max(0, holder_start - MARGIN)
                for b0, b1, a0, a1, equal in align(b, a, at - low, holder_at - holder_low, min_words, min_identity):
                    found.append(
                        (doc, b0 + low, b1 + low, holder, a0 + holder_low, a1 + holder_low, equal, equal / max(b1 - b0, a1 - a0))
                    )
            if found:
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return joined.mapInArrow(run, PASSAGE_FIELDS)
