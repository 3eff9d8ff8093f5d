"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table. The shards
take turns, each claiming its most preferred free slot, until the table is full, so all get
nearly the same number of slots, and the loss of a shard moves few rows of the others. A row
goes to the slot its key hashes to: one lookup in a broadcast table whose size is fixed by
``size``, whatever the data.

Defined cases: a row whose key columns are all null is placed by a hash of the whole row, so
such rows are spread; repeated rows go to the same shard; an empty table gives an empty result. Columns
of the caller named ``slot`` or like an entry of the tables are replaced; texts may have any length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideload.llm.common import OWN, quoted

SIZE = 65537
# The table is held by every task; beyond this it would no longer be small.
LARGEST = 4_000_000


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = SIZE, turns: Mapping[str, int] | None = None) -> list[int]:
    """The shard (place in ``shards``) that owns each slot.

    ``turns``: claims a shard makes in a round, 1 by default; a shard with 2 gets twice the
    slots. The table depends on the set of names, not on their order.
    """
    if not _is_prime(size) or size > LARGEST:
        raise ValueError(f"size must be a prime number up to {LARGEST}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > size:
        raise ValueError("give between 1 and size distinct shards")
    digest = xxhash.xxh64_intdigest
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    at = [digest(shards[i].encode(), 1) % size for i in order]
    step = [digest(shards[i].encode(), 2) % (size - 1) + 1 for i in order]
    claims = [(turns or {}).get(shards[i], 1) for i in order]
    if min(claims) < 1:
        raise ValueError("every shard needs a turn")
    table, free = [-1] * size, size
    while free:
        for k, shard in enumerate(order):
            for _ in range(claims[k]):
                if not free:
                    break
                while table[at[k]] >= 0:
                    at[k] = (at[k] + step[k]) % size
                table[at[k]] = shard
                free -= 1
    return table


def place(df: DataFrame, key_cols: Sequence[str], tables: Mapping[str, tuple[Sequence[str], Sequence[int]]]) -> DataFrame:
    """Add ``slot`` and, for each entry of ``tables``, the shard by that table under the entry's name.

    An entry is ``(shards, table)`` as given to and by :func:`fill_table`; all tables have one size.
    """
    sizes = {len(table) for _, table in tables.values()}
    if len(sizes) != 1:
        raise ValueError("the tables must have one size")
    size = sizes.pop()
    names = list(tables)
    rows = [(slot, *(tables[n][0][tables[n][1][slot]] for n in names)) for slot in range(size)]
    own = [f"{OWN}shard{i}" for i in range(len(names))]
    lookup = df.sparkSession.createDataFrame(rows, ", ".join([f"{OWN}slot int", *(f"{c} string" for c in own)]))
    keys = [quoted(c) for c in key_cols]
    all_null = F.coalesce(*[k.cast("string") for k in keys]).isNull()
    hashed = F.when(all_null, F.xxhash64(*[quoted(c) for c in df.columns])).otherwise(F.xxhash64(*keys))
    slotted = df.withColumn("slot", F.pmod(hashed, F.lit(size)).cast("int"))
    # The lookup table has ``size`` rows, never more.
    joined = slotted.join(F.broadcast(lookup), F.col("slot") == F.col(f"{OWN}slot"))
    return joined.withColumns({n: F.col(c) for n, c in zip(names, own, strict=True)}).drop(f"{OWN}slot", *own)


def write_shards(df: DataFrame, shard_col: str, key_cols: Sequence[str], path: str, tasks_per_shard: int = 8) -> None:
    """Write one folder per shard; a shard is written by several tasks, so a large one is not one task's work."""
    salt = F.pmod(F.xxhash64(*[quoted(c) for c in key_cols]), F.lit(tasks_per_shard))
    df.repartition(quoted(shard_col), salt).write.partitionBy(shard_col).parquet(path)
