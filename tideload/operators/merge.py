"""Incremental merge of a change table into a keyed table.

A change table holds full rows. With operations, a row is an INSERT, UPDATE,
DELETE or BEFOREIMAGE; anything that is neither DELETE nor BEFOREIMAGE writes the
row. Without operations, the newest row of a key wins.

A base may hold a key more than once; only its first row by the merge's order counts.
``unique_base=True`` is the caller's word that it does not, and spares that step. Both merges
first reduce the changes to one row per key, and know three forms with the same result:

``window``
    Union, rank per key, keep the first.
``lookup``
    Take the beaten rows out of the base by an anti join and add the winning changes.
    The reduced changes are written once; where they are small enough to broadcast, a base
    with unique keys is scanned once and never shuffled.
``join``
    One full outer join of base and reduced changes, NULL keys included. With
    ``key_partitioned`` keys are compared plainly, so that a base bucketed by its key is not
    exchanged at all, and NULL keys are ranked beside the join.

``auto`` takes ``window`` unless the base is unique. For a unique base it goes by Catalyst's
size estimates: ``lookup`` for changes within the session's broadcast limit, ``join`` for
larger ones as long as the base is larger still, and ``window``, which sorts base rows before
their exchange, for the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideload.functions.dates import trunc_second
from tideload.operators.latest import latest_per_key
from tideload.session import broadcast_limit, plan_bytes, staged

OPERATION = "header__operation"
TIMESTAMP = "header__timestamp"

INSERT = "INSERT"
DELETE = "DELETE"
BEFORE_IMAGE = "BEFOREIMAGE"

# Fixed value: the age every stored row is given when operations are merged into it.
STORED_SINCE = "1900-01-01"

_FORMS = ("auto", "lookup", "join", "window")


def stored_since() -> Column:
    return F.lit(STORED_SINCE).cast("timestamp_ntz")


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """Key equality between two aliased inputs in which NULL equals NULL."""
    parts = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, parts)


def effective_changes(changes: DataFrame, op: str = OPERATION) -> DataFrame:
    """Changes that count: no before-images, and no rows without an operation."""
    return changes.where(F.col(op) != BEFORE_IMAGE)


def _newest_first(ts: str, tiebreak: Sequence[str], payload: Sequence[str]) -> list[Column]:
    order = [F.col("_age").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in tiebreak]
    order += [F.col("_change").desc(), F.col(ts).desc_nulls_last()]
    if not tiebreak:
        order.append(F.xxhash64(*payload).desc())
    return order


def _with_order(
    df: DataFrame, columns: Sequence[str], op: str | None, ts: Column, tiebreak: Sequence[str], change: int
) -> DataFrame:
    """The columns a merge works on: payload, operation, ordering.

    With operations the age counts to the second, without it is the full timestamp.
    """
    have = set(df.columns)
    extra = [t for t in tiebreak if t not in columns]
    return df.select(
        *columns,
        *([(F.col(op) if op in have else F.lit(INSERT)).alias("_op")] if op else []),
        ts.alias("_ts"),
        (trunc_second(ts) if op else ts).alias("_age"),
        *[(F.col(t) if t in have else F.lit(None)).alias(t) for t in extra],
        F.lit(change).alias("_change"),
    )


def _pick_form(form: str, base: DataFrame, changes: DataFrame, unique_base: bool) -> str:
    if form not in _FORMS:
        raise ValueError(f"form must be one of {_FORMS}")
    if form != "auto":
        return form
    if not unique_base:
        return "window"
    size = plan_bytes(changes)
    if size <= broadcast_limit(changes):
        return "lookup"
    return "join" if size < plan_bytes(base) else "window"


def _anti(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    return left.alias("l").join(right.alias("r"), condition, "left_anti")


def _one_per_key(
    stored: DataFrame, keys: Sequence[str], columns: Sequence[str], tiebreak: Sequence[str], unique_base: bool
) -> DataFrame:
    """The row of each stored key that counts."""
    return stored if unique_base else latest_per_key(stored, keys, _newest_first("_ts", tiebreak, columns))


def _full_join(
    stored: DataFrame, newest: DataFrame, matched: Column, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The winning row of each key by one full outer join, with its operation if there is one."""
    joined = stored.alias("l").join(newest.alias("r"), matched, "full")
    # A struct compares field by field with NULL lowest, like the ranking does.
    stored_newer = F.struct(*[f"l.{c}" for c in order]) > F.struct(*[f"r.{c}" for c in order])
    take = F.col("r._change").isNotNull() & (F.col("l._change").isNull() | ~stored_newer)
    return joined.select(*[F.when(take, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c) for c in columns])


def _newest_rows(
    stored: DataFrame,
    newest: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    tiebreak: Sequence[str],
    key_partitioned: bool,
) -> DataFrame:
    """The winning row of each key by one join, NULL keys included.

    NULL-safe equality does not keep the key's own hash partitioning. Where the base has it,
    whole keys are compared plainly and keys with a NULL part ranked beside the join; Parquet
    statistics let the scan for NULL keys skip files that have none.
    """
    order = ["_age", *tiebreak]
    if not key_partitioned:
        return _full_join(stored, newest, same_key("l", "r", keys), columns, order)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    equal = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])
    joined = _full_join(stored.where(whole), newest.where(whole), equal, columns, order)
    partial = stored.where(~whole).unionByName(newest.where(~whole))
    ranked = latest_per_key(partial, keys, _newest_first("_ts", tiebreak, columns))
    return joined.unionByName(ranked.select(*columns))


def compact_changes(
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    op: str | None = OPERATION,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The newest counting change per key with its operation and order columns."""
    if op:
        changes = effective_changes(changes, op)
    ordered = _with_order(changes, columns, op, F.col(ts), tiebreak, 1)
    return latest_per_key(ordered, keys, _newest_first("_ts", tiebreak, columns))


def merge_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    op: str = OPERATION,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
    form: str = "auto",
    unique_base: bool = False,
    key_partitioned: bool = False,
) -> DataFrame:
    """Apply a change table with operations; returns the key columns first, then the others.

    Timestamps count to the second. Within one second ``tiebreak`` columns decide,
    highest first; without any, the full timestamp does and then a hash of the row,
    so that a second run gives the same rows. Stored rows count as inserted at
    ``STORED_SINCE``; at that very second the tiebreak decides, and then the change wins.
    """
    columns = _key_first(base, keys, columns)
    form = _pick_form(form, base, changes, unique_base)
    stored = _with_order(base.select(*columns), columns, op, stored_since(), tiebreak, 0)
    if form == "window":
        incoming = _with_order(effective_changes(changes, op), columns, op, F.col(ts), tiebreak, 1)
        ranked = latest_per_key(stored.unionByName(incoming), keys, _newest_first("_ts", tiebreak, columns))
        # The delete filter stays above the ranking: a delete must hide older rows.
        return ranked.where(F.col("_op") != DELETE).select(*columns)

    stored = _one_per_key(stored, keys, columns, tiebreak, unique_base)
    newest = compact_changes(changes, keys, columns, op, ts, tiebreak)
    if form == "join":
        rows = _newest_rows(stored, newest, keys, [*columns, "_op"], tiebreak, key_partitioned)
        return rows.where(F.col("_op") != DELETE).select(*columns)

    # Written, since several branches read them and they are one small row per key.
    newest = staged(newest, "changes")
    matched = same_key("l", "r", keys)
    wins = F.coalesce(F.col("_age") > stored_since(), F.lit(False))
    weak = newest.where(~wins)
    winners = newest.where(wins)
    if not weak.isEmpty():
        # Changes from before STORED_SINCE, of that very second or undated: rare, and may lose.
        held = _held(stored, weak, keys, ["_age", *tiebreak])
        winners = winners.unionByName(_anti(weak, held, matched).select(*winners.columns))
    kept = _anti(stored, winners.select(*keys), matched).select(*columns)
    return kept.unionByName(winners.where(F.col("_op") != DELETE).select(*columns))


def _held(stored: DataFrame, newest: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys whose stored row is newer than the change."""
    narrow = [*keys, *[c for c in order if c not in keys]]
    stored_newer = F.struct(*[f"l.{c}" for c in order]) > F.struct(*[f"r.{c}" for c in order])
    matched = same_key("l", "r", keys) & stored_newer
    held = stored.select(*narrow).alias("l").join(newest.select(*narrow).alias("r"), matched, "left_semi")
    return held.select(*keys)


def merge_latest(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    ts: str = "lastmodifieddate",
    tiebreak: Sequence[str] = (),
    form: str = "auto",
    unique_base: bool = False,
    key_partitioned: bool = False,
) -> DataFrame:
    """Merge full rows without operations: the newest ``ts`` per key wins, nothing is deleted.

    At an equal time the tiebreak columns decide, then the change wins.
    """
    columns = _key_first(base, keys, columns)
    stored = _with_order(base, columns, None, F.col(ts), tiebreak, 0)
    form = _pick_form(form, base, changes, unique_base)
    if form == "window":
        incoming = _with_order(changes, columns, None, F.col(ts), tiebreak, 1)
        union = stored.unionByName(incoming)
        return latest_per_key(union, keys, _newest_first("_ts", tiebreak, columns)).select(*columns)

    stored = _one_per_key(stored, keys, columns, tiebreak, unique_base)
    newest = compact_changes(changes, keys, columns, None, ts, tiebreak)
    if form == "join":
        return _newest_rows(stored, newest, keys, columns, tiebreak, key_partitioned)

    newest = staged(newest, "changes")
    matched = same_key("l", "r", keys)
    winners = _anti(newest, _held(stored, newest, keys, ["_age", *tiebreak]), matched)
    kept = _anti(stored, winners.select(*keys), matched).select(*columns)
    return kept.unionByName(winners.select(*columns))


def _key_first(base: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    """The given columns, or all of ``base``, with the key columns in front."""
    names = list(columns) if columns is not None else base.columns
    return [*keys, *[c for c in names if c not in keys]]


def apply_deletes(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the rows whose key occurs in ``deletes``."""
    return _anti(target, deletes.select(*keys).distinct(), same_key("l", "r", keys)).select(*target.columns)


def apply_puts(target: DataFrame, puts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with every row of ``puts`` written over or added by key."""
    kept = apply_deletes(target, puts, keys)
    return kept.unionByName(puts.select(*target.columns))
