"""Trie of the prefixes that conversations share, built from sorted neighbours.

A turn is known by 128 bits of its role and text, a prefix by its depth and the exclusive or of 128
bits per turn and place: two scans over sorted rows, whose results are put right where a
conversation goes on in the next partition. A conversation of any length is dealt to many tasks.

Nodes with one way on are chains; what is left of a conversation are the branching nodes on its way,
at most about sqrt(2 N) of N rows. Conversations are sorted by these keys over ranges. In each range
the longest common prefixes (LCP) of neighbours are edges, taken in descending depth by a union-find:
every merge creates a branching node or adds to the one it meets. A forest is then contracted to
one row per node, with those on the way of its first and last conversation that go beyond the range; rows of one node
from several ranges are merged. What a node needs is a sum over its members: a conversation carries
the bytes saved on the stretch of its way on which it is the smallest member, and whether a leaf is its own.

Defined cases: null role or text is empty; a null turn comes first; ties of turn go by role and text, and repeated
rows are turns of their own; rows without a conversation id belong to none; ids are whole numbers;
an empty table has no conversation, and no root. Other columns are not read, texts only once, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.llm.common import filled, quoted
from tideload.session import staged

# The rule by which conversations are rebuilt.
FAMILY = 5
HEADS = 9

NODE = ["depth", "x", "y"]
PARTIAL_FIELDS = "depth long, x long, y long, n long, owner long, charge long, leaves long"
# Ids joined into one row of the way to a digest.
CHUNK_IDS = 1 << 16


def _scanned(sorted_rows: DataFrame, xors: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add ``at``, the place in the conversation, and turn columns into running values, within each partition.

    ``sorted_rows`` are in order of ``conv`` within and over the partitions.
    """
    numbered = sorted_rows.withColumn("part", F.spark_partition_id().cast("long")).withColumn("at", F.lit(1).cast("long"))
    names = numbered.columns
    running = {**dict.fromkeys(xors, np.bitwise_xor), **dict.fromkeys(["at", *sums], np.add)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(names.index("conv")).to_numpy()
            new = np.concatenate([[True], conv[1:] != conv[:-1]])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            arrays = list(batch.columns)
            for name, add in running.items():
                values = batch.column(names.index(name)).to_numpy()
                total = add.accumulate(values)
                before = np.where(first > 0, total[first - 1], 0)
                values = total ^ before if add is np.bitwise_xor else total - before
                if conv[0] == last:
                    values = np.where(first == 0, add(values, carry[name]), values)
                carry[name] = values[-1]
                arrays[names.index(name)] = pa.array(values)
            last = conv[-1]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return numbered.mapInArrow(run, numbered.schema)


def _running(sorted_rows: DataFrame, label: str, xors: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """``at`` and running values over whole conversations, whatever partitions they lie in."""
    rows = staged(_scanned(sorted_rows, xors, sums), label)
    edge = rows.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"))
    values = ["at", *xors, *sums]
    # At most two rows per partition.
    totals = (
        rows.join(F.broadcast(edge), "part")
        .where("conv = first OR conv = last")
        .groupBy("part", "conv", "first")
        .agg(F.max(F.struct(*values)).alias("total"))
        .orderBy("part", "conv")
        .collect()
    )
    missing, open_conv, carry = [], None, None
    for r in totals:
        goes_on = r.conv == open_conv and r.conv == r.first
        if goes_on:
            missing.append((r.part, r.conv, *carry))
        total = [r.total[v] for v in values]
        carry = [a ^ b if v in xors else a + b for v, a, b in zip(values, carry, total, strict=True)] if goes_on else total
        open_conv = r.conv
    rows_schema = ", ".join(["part long", "conv long", *[f"__{v} long" for v in values]])
    if not missing:
        return rows.drop("part")
    fix = F.broadcast(rows.sparkSession.createDataFrame(missing, rows_schema))
    added = {
        v: F.col(v).bitwiseXOR(F.coalesce(f"__{v}", F.lit(0))) if v in xors else F.col(v) + F.coalesce(f"__{v}", F.lit(0))
        for v in values
    }
    return rows.join(fix, ["part", "conv"], "left").withColumns(added).select(*[c for c in rows.columns if c != "part"])


def _placed_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, a, b, size, at``: each turn's hashes, bytes of its text, and place from 1."""
    rows = turns.select(
        quoted(conv_col).cast("long").alias("conv"),
        quoted(turn_col).alias("turn"),
        filled(quoted(role_col)).alias("role"),
        filled(quoted(text_col)).alias("text"),
        # Equal rows may be told apart at will, so that many of them are dealt to many tasks.
        F.monotonically_increasing_id().alias("row"),
    ).where("conv IS NOT NULL")
    order = ["conv", "turn", "role", "text", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(
        "conv",
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit(1), "role", "text").alias("b"),
        F.octet_length("text").cast("long").alias("size"),
    )
    return _running(rows, "turns")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations ``conv, depth, total, a, b, size``; and ``conv, total``, the turns of each."""
    lengths = turns.groupBy("conv").agg(F.max("at").alias("length"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    convs = lengths.select("conv", "length", head.alias("head"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    bases = lengths.select(F.col("conv").alias("base"), F.col("length").alias("base_length"))
    taken = F.least("head", F.coalesce("base_length", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    convs = convs.withColumn("total", F.col("taken") + F.greatest(F.col("length") - F.col("head"), F.lit(0)))
    # One row per conversation.
    convs = staged(convs.select("conv", "base", "head", "taken", "total"), "conversations")
    own = turns.join(convs, "conv").where("at > head").withColumn("depth", F.col("at") - F.col("head") + F.col("taken"))
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("at") < HEADS)).withColumnRenamed("conv", "base")
    heads = convs.where("taken > 0").join(heads, "base").where("at <= taken").withColumn("depth", F.col("at"))
    columns = ["conv", "depth", "total", "a", "b", "size"]
    return own.select(columns).unionByName(heads.select(columns)), convs.select("conv", "total")


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """``conv, depth, x, y, step_x, step_y, total, size, bytes``: the prefix that ends with each turn, and its bytes."""
    step_x, step_y = F.xxhash64("a", "b", "depth"), F.xxhash64("b", "depth", "a")
    rows = rebuilt.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth")
    rows = rows.select(
        "conv", "depth", "total", "size", step_x.alias("step_x"), step_y.alias("step_y"),
        step_x.alias("x"), step_y.alias("y"), F.col("size").alias("bytes"),
    )
    return _running(rows, "prefixes", xors=["x", "y"], sums=["bytes"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The branching nodes of one range of sorted conversations, contracted to a row each."""
    ways: list[list[tuple]] = []
    sums: list[tuple[int, int, int, int]] = []
    for batch in batches:
        ids, keys, charge, leaves = (batch.column(c) for c in ("conv", "keys", "charge", "leaf"))
        ways += [[(k["depth"], k["x"], k["y"]) for k in row] for row in keys.to_pylist()]
        sums += zip([1] * len(ids), ids.to_pylist(), charge.to_pylist(), leaves.to_pylist(), strict=True)
    if not ways:
        return

    def add(one: tuple, other: tuple) -> tuple:
        return one[0] + other[0], min(one[1], other[1]), one[2] + other[2], one[3] + other[3]

    # Edges: how many branching nodes two neighbours share.
    shared = []
    for left, right in zip(ways, ways[1:], strict=False):
        level = 0
        while level < len(left) and level < len(right) and left[level] == right[level]:
            level += 1
        shared.append(level)
    nodes: dict[tuple, tuple] = {}
    parent, held = list(range(len(ways))), list(sums)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    depth_of = [ways[i][level - 1][0] if level else 0 for i, level in enumerate(shared)]
    for i in sorted(range(len(shared)), key=lambda i: -depth_of[i]):
        left, right = find(i), find(i + 1)
        held[left] = add(held[left], held[right])
        parent[right] = left
        if shared[i]:
            # A later merge at the same depth meets the same node, with more members.
            nodes[ways[i][shared[i] - 1]] = held[left]
    nodes[0, 0, 0] = held[find(0)]
    # Nodes on the way of the first and last conversation may go beyond the range, whether they branch here or not.
    for end, step in ((0, 1), (len(ways) - 1, -1)):
        at, total = end, sums[end]
        for level in range(len(ways[end]), 0, -1):
            while 0 <= at + step < len(ways) and shared[min(at, at + step)] >= level:
                at += step
                total = add(total, sums[at])
            nodes[ways[end][level - 1]] = total
    columns = zip(*[(*key, *total) for key, total in nodes.items()], strict=True)
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in PARTIAL_FIELDS.split(", ")])


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of sorted ids of one node as text."""
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in NODE])
        conv = batch.column("conv").to_numpy()
        new = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        new[:: CHUNK_IDS] = True
        firsts = np.flatnonzero(new)
        texts = [",".join(map(str, part.tolist())) for part in np.split(conv, firsts[1:])]
        arrays = [*[pa.array(k[firsts]) for k in keys], pa.array(conv[firsts]), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*NODE, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its stretches, which follow each other."""
    key, sha = None, None
    for batch in batches:
        done = []
        for *node, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if node == key:
                sha.update(b"," + ids.encode())
                continue
            if key:
                done.append((*key, sha.hexdigest()))
            key, sha = node, hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*NODE, "ends_sha256"])
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, sha.hexdigest())], names=[*NODE, "ends_sha256"])


def _end_digests(ended: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at each node (``depth, x, y, conv``)."""
    order = [*NODE, "conv"]
    chunks = ended.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = chunks.mapInArrow(_joined_ids, "depth long, x long, y long, first long, ids string")
    whole = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return whole.mapInArrow(_digests, "depth long, x long, y long, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: the nodes of the trie.

    A node is known by its smallest member and its depth. Conversations are those that :func:`_rebuilt` makes.
    """
    rebuilt, convs = _rebuilt(_placed_turns(turns, conv_col, turn_col, role_col, text_col))
    prefixes = _prefixes(rebuilt)
    nodes = prefixes.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("members"),
        F.min("conv").alias("owner"),
        F.sum((F.col("depth") == F.col("total")).cast("long")).alias("ends"),
        # Equal in all rows of a node.
        *[F.max(c).alias(c) for c in ("size", "bytes", "step_x", "step_y")],
    )
    nodes = staged(nodes, "nodes")
    up = [
        (F.col("depth") - 1).alias("depth"),
        F.col("x").bitwiseXOR(F.col("step_x")).alias("x"),
        F.col("y").bitwiseXOR(F.col("step_y")).alias("y"),
    ]
    children = staged(nodes.select(*up).groupBy(*NODE).agg(F.count(F.lit(1)).alias("children")), "children")
    branching = nodes.where("members > 1").join(children, NODE, "left").fillna(0, ["children"])
    branching = staged(branching.where("children <> 1 OR ends > 0").select(*NODE, "members", "owner", "bytes", "children"), "branching")

    # The branching nodes on the way of each conversation, and what it brings to the sums of its nodes.
    way = prefixes.select("conv", *NODE).join(branching, NODE)
    way = way.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct(*NODE, "members", "owner", "bytes", "children"))).alias("way")
    )
    convs = convs.join(way, "conv", "left")
    convs = convs.withColumn("way", F.expr("coalesce(way, filter(array(struct(0L AS depth, 0L AS x, 0L AS y, 0L AS members, "
                                           "0L AS owner, 0L AS bytes, 0L AS children)), e -> false))"))  # fmt: skip
    charge = F.expr(
        "aggregate(transform(way, (e, i) -> if(e.owner = conv, (e.members - 1) * (e.bytes - coalesce(get(way, i - 1).bytes, 0)), 0)),"
        " 0L, (a, b) -> a + b)"
    )
    convs = convs.withColumn("charge", charge).withColumn("last", F.expr("get(way, size(way) - 1)"))
    shared_end = F.coalesce(F.col("last.depth") == F.col("total"), F.lit(False))
    leaf = F.when(F.col("total") == 0, False).when(
        shared_end, (F.col("last.owner") == F.col("conv")) & (F.col("last.children") == 0)
    ).otherwise(True)
    convs = staged(convs.withColumn("leaf", leaf.cast("long")).withColumn("shared_end", shared_end).drop("last"), "ways")

    keys = F.expr("transform(way, e -> struct(e.depth, e.x, e.y))").alias("keys")
    ordered = convs.select("conv", keys, "charge", "leaf")
    ordered = ordered.repartitionByRange("keys", "conv").sortWithinPartitions("keys", "conv")
    merged = ordered.mapInArrow(_forest, PARTIAL_FIELDS).groupBy(*NODE).agg(
        F.sum("n").alias("n"), F.min("owner").alias("owner"), F.sum("charge").alias("charge"), F.sum("leaves").alias("leaves")
    )
    end = F.expr("get(way, size(way) - 1)")
    root_end = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    ended = convs.where("shared_end OR total = 0").select(
        "conv", F.when(F.col("total") == 0, root_end).otherwise(F.struct(*[end[c].alias(c) for c in NODE])).alias("node")
    )
    digests = _end_digests(ended.select("node.*", "conv"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    merged = merged.join(branching.select(*NODE, "bytes"), NODE, "left").join(children, NODE, "left").join(digests, NODE, "left")
    merged = staged(merged.fillna(0, ["children", "bytes"]).fillna(hashlib.sha256(b"").hexdigest(), ["ends_sha256"]), "merged")

    root = merged.where("depth = 0").select(
        F.col("owner").alias("conv_id"), "depth", F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.greatest("leaves", F.lit(1)).alias("n_leaves"),
        F.col("charge").alias("saved_tokens"), "ends_sha256",
    )
    owned = merged.where("depth > 0").groupBy("owner").agg(
        F.array_sort(F.collect_list(F.struct("depth", "n", "charge", "leaves", "bytes", "children", "ends_sha256"))).alias("owned")
    )
    # Above its own stretch, a conversation's way leads through nodes of smaller ones.
    foreign = F.expr("get(filter(way, e -> e.owner <> conv), size(filter(way, e -> e.owner <> conv)) - 1)")
    owners = convs.withColumn("above", foreign).select(
        F.col("conv").alias("owner"),
        F.coalesce(F.col("above.depth"), F.lit(0)).alias("above_depth"),
        F.coalesce(F.col("above.owner"), merged.where("depth = 0").select("owner").scalar()).alias("above_owner"),
        F.col("charge").alias("own_charge"),
    )
    owners = owners.join(owned, "owner", "left")
    found = nodes.join(owners, "owner").withColumn("below", F.expr("filter(owned, e -> e.depth >= depth)"))
    found = found.withColumn("node", F.expr("get(below, 0)"))
    exact = F.col("node.depth") == F.col("depth")
    kept_charge = F.expr(
        "aggregate(transform(below, (e, i) -> (e.n - 1) * (e.bytes - coalesce(get(below, i - 1).bytes, bytes - size))),"
        " 0L, (a, b) -> a + b)"
    )
    alone = F.col("members") == 1
    inner = found.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == F.col("above_depth") + 1, F.col("above_owner")).otherwise(F.col("owner")).alias("parent_conv_id"),
        F.when(alone, F.col("members")).otherwise(F.col("node.n")).alias("n_convs"),
        F.when(alone, 1 - F.col("ends")).when(exact, F.col("node.children")).otherwise(1).alias("n_children"),
        F.when(alone, 1).otherwise(F.col("node.leaves")).alias("n_leaves"),
        F.when(alone, 0).otherwise(F.col("node.charge") - F.col("own_charge") + kept_charge).alias("saved_tokens"),
        F.when(alone & (F.col("ends") > 0), F.sha2(F.col("owner").cast("string"), 256))
        .when(~alone & exact, F.col("node.ends_sha256"))
        .otherwise(nothing)
        .alias("ends_sha256"),
    )
    return root.unionByName(inner)
