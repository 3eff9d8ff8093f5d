"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints within three bits have a point of even parity that is at an even
distance (0 or 2) from an even one and at distance 1 from an odd one:

* even and odd, 1 or 3 bits apart: one step from the odd one, 0 or 2 from the even one;
* odd and odd, 2 bits apart: one step from each;
* even and even, 2 bits apart: one of the two itself.

So an even fingerprint emits itself and all its variants at distance 2, an odd one all its
variants at distance 1, and fingerprints meet at a shared variant. All members of a variant
that has an odd member (or is a fingerprint itself) lie within three bits of that member, so
each is linked to it alone: the links are linear in a group's size, and imply every other link.

The shuffle is on the first bits of a variant only: a row goes to each prefix its variants
can have, and the variants of the rest are made where they meet. Prefixes with many rows are
given further prefix bits, and a task works off its variants in passes of bounded size.

Defined cases: a null or empty text, or one without words, has fingerprint zero, linked like
any other; a text of fewer words than a shingle is one shingle; repeated rows have the same
class; a row with a null id gets a fingerprint and no class; an empty table an empty result. Texts
are worked on whole, whatever their length; columns of the caller may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideload.llm.common import OWN, quoted
from tideload.llm.components import components
from tideload.session import staged

SEED = 42
RADIUS = 3
# Variants a task holds at once.
PASS_VARIANTS = 8_000_000
# Rows a prefix may have before it is given more bits, and how many it gets.
PREFIX_ROWS = 250_000
FIRST_BITS = 8
MORE_BITS = 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """``id, fp`` for every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def _masks(bits: int, most: int) -> list[int]:
    """All masks of ``bits`` bits with up to ``most`` ones."""
    out = [0]
    if most >= 1:
        out += [1 << i for i in range(bits)]
    if most >= 2:
        out += [(1 << i) | (1 << j) for i in range(bits) for j in range(i)]
    return out


def _spread(rows: DataFrame, taken: int, bits: int, name: str) -> DataFrame:
    """Send each row to the values the bits after the first ``taken`` can have in its variants.

    ``used`` counts the bits flipped so far; an even fingerprint has two in all, an odd one one.
    """
    masks = F.explode(F.array(*[F.lit(m).cast("long") for m in _masks(bits, 2)]))
    own = F.shiftrightunsigned("fp", 64 - taken - bits).bitwiseAND((1 << bits) - 1)
    left = F.when(F.bit_count("fp") % 2 == 0, 2).otherwise(1) - F.col("used")
    spread = rows.withColumn("mask", masks).where(F.bit_count("mask") <= left)
    return spread.withColumn(name, own.bitwiseXOR(F.col("mask"))).withColumn(
        "used", F.col("used") + F.bit_count("mask")
    ).drop("mask")


def _pairs_of(count: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.uint64(1) << np.arange(count, dtype=np.uint64)
    i, j = np.triu_indices(count, 1)
    return one, one[i] | one[j]


def _roots(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The smallest member of each place's component under the links ``a``-``b``."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(before, root):
            return root


def _met(fps: np.ndarray, used: np.ndarray, low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (places in ``fps``) among the rows of one prefix, as a forest."""
    even = np.bitwise_count(fps) % 2 == 0
    low = fps & np.uint64((1 << low_bits) - 1)
    one, two = _pairs_of(low_bits)
    none = np.zeros(1, dtype=np.uint64)
    kinds = [
        # rows, masks of the rest, rank of the row in a variant: the linking members first
        (np.flatnonzero(~even & (used == 0)), one, 0),
        (np.flatnonzero(~even & (used == 1)), none, 0),
        (np.flatnonzero(even & (used == 0)), none, 1),
        (np.flatnonzero(even & (used == 0)), two, 2),
        (np.flatnonzero(even & (used == 1)), one, 2),
        (np.flatnonzero(even & (used == 2)), none, 2),
    ]
    total = sum(len(rows) * len(masks) for rows, masks, _ in kinds)
    passes = np.uint64(-(-total // PASS_VARIANTS) or 1)
    mix = np.uint64(0x9E3779B97F4A7C15)
    links_a, links_b = [], []

    def variants(rows: np.ndarray, masks: np.ndarray, which: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, 500_000 // len(masks))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            x = (low[part][:, None] ^ masks[None, :]).ravel()
            owner = np.repeat(part, len(masks))
            if passes > 1:
                keep = ((x * mix) >> np.uint64(40)) % passes == which
                x, owner = x[keep], owner[keep]
            yield x, owner

    for which in range(int(passes)):
        which = np.uint64(which)
        xs, owners, ranks = [], [], []
        for rows, masks, rank in kinds[:3]:
            for x, owner in variants(rows, masks, which):
                xs.append(x), owners.append(owner), ranks.append(np.full(len(x), rank, dtype=np.int8))
        centres = np.concatenate(xs) if xs else none[:0]
        if not len(centres):
            continue
        # A variant at distance 2 only counts where a linking member is; most are sifted out by a bit map.
        width = np.uint64(max(10, int(len(centres) * 16).bit_length()))
        place = lambda x, w=width: (x * mix) >> (np.uint64(64) - w)
        here = np.zeros(1 << int(width), dtype=bool)
        here[place(centres)] = True
        for rows, masks, rank in kinds[3:]:
            for x, owner in variants(rows, masks, which):
                keep = here[place(x)]
                if keep.any():
                    xs.append(x[keep]), owners.append(owner[keep])
                    ranks.append(np.full(int(keep.sum()), rank, dtype=np.int8))
        x, owner, rank = np.concatenate(xs), np.concatenate(owners), np.concatenate(ranks)
        order = np.lexsort((owner, rank, x))
        x, owner, rank = x[order], owner[order], rank[order]
        first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        head = np.repeat(first, np.diff(np.r_[first, len(x)]))
        linked = (rank[head] < 2) & (owner[head] != owner)
        links_a.append(owner[head][linked])
        links_b.append(owner[linked])
    if not links_a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b = np.concatenate(links_a), np.concatenate(links_b)
    near = np.bitwise_count(fps[a] ^ fps[b]) <= RADIUS  # every colliding pair is verified
    root = _roots(a[near], b[near], len(fps))
    member = np.flatnonzero(root != np.arange(len(fps)))
    return member, root[member]


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """``u, v`` links of nodes (``node`` number, distinct ``fp``) that imply all pairs within three bits."""
    rows = _spread(nodes.select("node", "fp", F.lit(0).alias("used")), 0, FIRST_BITS, "prefix")
    # One row per prefix: at most 2**FIRST_BITS.
    hot = [r[0] for r in rows.groupBy("prefix").count().where(F.col("count") > PREFIX_ROWS).select("prefix").collect()]
    is_hot = F.col("prefix").isin(hot) if hot else F.lit(False)
    plain = rows.where(~is_hot).withColumn("further", F.lit(-1).cast("long"))
    if hot:
        plain = plain.unionByName(_spread(rows.where(is_hot), FIRST_BITS, MORE_BITS, "further"))

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        node = table.column("node").to_numpy()
        bits = FIRST_BITS + (MORE_BITS if table.column("further")[0].as_py() >= 0 else 0)
        member, root = _met(fps, table.column("used").to_numpy(), 64 - bits)
        return pa.table({"u": pa.array(node[member], pa.int64()), "v": pa.array(node[root], pa.int64())})

    return plain.groupBy("prefix", "further").applyInArrow(run, "u long, v long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, fp, component`` for every row of ``docs``; the (whole-number) smallest id names a component."""
    marked = staged(fingerprints(docs, id_col, text_col, shingle).withColumn("id", F.col("id").cast("long")), "fingerprints")
    nodes = staged(marked.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("node")), "nodes")
    found = components(fingerprint_links(nodes))
    classes = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    joined = marked.join(classes, "fp", "left")
    return joined.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The document with the smallest id of each component, and every row without an id; the columns of ``docs``.

    Of repeated rows with that id one stays.
    """
    kept = simhash_components(docs, id_col, text_col, shingle).where("id = component").select(F.col("id").alias(f"{OWN}id"))
    kept = kept.distinct()
    with_id = docs.where(quoted(id_col).isNotNull())
    once = with_id.join(kept, quoted(id_col).cast("long") == F.col(f"{OWN}id"), "left_semi").dropDuplicates([id_col])
    return once.unionByName(docs.where(quoted(id_col).isNull()))
