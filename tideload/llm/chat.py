r"""Chat formatting by columnar byte assembly.

A conversation becomes one text, a marked turn after the other:

    <turn ROLE>\nTEXT\n</turn>\n

Backslash, ``<`` and ``>`` inside a role or text get a backslash before them, so a bare ``<``
always opens a mark, and taking the backslashes away gives the text back. The texts of
``assistant`` turns are under the loss mask: byte spans of the formatted text.

The rows of a partition come sorted. For a batch of them the lengths of all segments, their
places in the output and the target of every byte are computed as arrays, and headers and
contents are copied into one buffer that becomes the column. A conversation longer than
``part_bytes`` continues in further rows, so no task holds more than that of it.

Defined cases: rows are ordered by turn, then role, then text, nulls first; a null role or text
is empty; rows without a conversation id form one conversation without id; repeated rows are
repeated turns; an empty table gives an empty result. Texts of any length are one turn; of the caller's
columns only those named in the call are read, so any others may have the names of results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideload.llm.common import filled, quoted

HEAD, MIDDLE, TAIL = b"<turn ", b">\n", b"\n</turn>\n"
ESCAPE = ord("\\")
CONTROL = b"\\<>"
TURN = re.compile(rb"<turn ((?:[^<>\\]++|\\.)*+)>\n((?:[^<>\\]++|\\.)*+)</turn>\n", re.DOTALL)
LEARNED_ROLE = "assistant"
PART_BYTES = 8 << 20
# Bytes whose target indices are held at once.
SCATTER_BYTES = 2 << 20


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start places (one more than rows) and bytes of a string column."""
    column = column.cast(pa.string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets.astype(np.int64), np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)


def _is_control(data: np.ndarray) -> np.ndarray:
    return (data == CONTROL[0]) | (data == CONTROL[1]) | (data == CONTROL[2])


def _escaped_lengths(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    control = offsets[0] + np.flatnonzero(_is_control(data[offsets[0] : offsets[-1]]))
    return np.diff(offsets) + np.diff(np.searchsorted(control, offsets))


def _scatter(out: np.ndarray, targets: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Copy each row's bytes to its place in ``out``, with a backslash before each control byte."""
    row = 0
    while row < len(targets):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SCATTER_BYTES)) - 1)
        end = min(end, len(targets))
        own = offsets[row : end + 1]
        part = data[own[0] : own[-1]]
        control = _is_control(part)
        added = np.cumsum(control)
        sizes = np.diff(own)
        first = own[:-1] - own[0]
        before = np.concatenate([[0], added])[first]
        index = np.arange(len(part)) + added + np.repeat(targets[row:end] - first - before, sizes)
        out[index] = part
        out[index[control] - 1] = ESCAPE
        row = end


def _put(out: np.ndarray, targets: np.ndarray, literal: bytes) -> None:
    out[targets[:, None] + np.arange(len(literal))] = np.frombuffer(literal, dtype=np.uint8)


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All formatted turns in one buffer: the buffer, turn starts (one more than turns), text starts, text ends."""
    role_at, role_data = _bytes_of(role)
    text_at, text_data = _bytes_of(text)
    role_size, text_size = _escaped_lengths(role_at, role_data), _escaped_lengths(text_at, text_data)
    sizes = len(HEAD) + role_size + len(MIDDLE) + text_size + len(TAIL)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(starts[-1]), dtype=np.uint8)
    role_to = starts[:-1] + len(HEAD)
    middle = role_to + role_size
    text_to = middle + len(MIDDLE)
    tail = text_to + text_size
    _put(out, starts[:-1], HEAD)
    _scatter(out, role_to, role_at, role_data)
    _put(out, middle, MIDDLE)
    _scatter(out, text_to, text_at, text_data)
    _put(out, tail, TAIL)
    return out, starts, text_to, tail


def _group_starts(keys: pa.Array) -> np.ndarray:
    codes = pc.fill_null(pc.cast(keys.dictionary_encode().indices, pa.int64()), -1).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])


def _formatted(rows: pa.RecordBatch, starts: np.ndarray, first_part: int, names: list[str]) -> pa.RecordBatch:
    """One output row for each group of rows; the first is part ``first_part`` of its conversation."""
    out, turn_at, text_to, text_end = assemble(rows.column(2), rows.column(3))
    bounds = np.append(starts, rows.num_rows)
    formatted = pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(turn_at[bounds].astype(np.int32)), pa.py_buffer(out)]
    )
    learned = np.flatnonzero(pc.equal(rows.column(2), LEARNED_ROLE).to_numpy(zero_copy_only=False))
    base = np.repeat(turn_at[starts], np.diff(bounds))[learned]
    spans = pa.StructArray.from_arrays(
        [pa.array(text_to[learned] - base), pa.array(text_end[learned] - base)], names=["start", "end"]
    )
    part = np.zeros(len(starts), dtype=np.int64)
    part[0] = first_part
    return pa.RecordBatch.from_arrays(
        [
            rows.column(0).take(pa.array(starts)),
            pa.array(part),
            pa.array(np.diff(bounds)),
            formatted,
            pa.ListArray.from_arrays(pa.array(np.searchsorted(learned, bounds).astype(np.int32)), spans),
        ],
        names=names,
    )


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``conv_id, part, n_turns, formatted, loss``: conversations as text, with the byte spans to learn from.

    The parts of a conversation follow each other, in order, within one partition; all but
    very long ones have part 0 alone. ``n_turns`` counts those of the part.
    """
    rows = turns.select(
        quoted(conv_col).alias("conv_id"),
        quoted(turn_col).alias("turn"),
        filled(quoted(role_col)).alias("role"),
        filled(quoted(text_col)).alias("text"),
    )
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("part", T.LongType()),
         T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType()),
         T.StructField("loss", T.ArrayType(span))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names
        carry, carry_part = None, 0

        def emit(table: pa.RecordBatch, starts: np.ndarray, first_part: int) -> Iterator[pa.RecordBatch]:
            sizes = pc.binary_length(table.column(3)).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(sizes)
            at = 0
            while at < len(starts):  # whole conversations, about part_bytes at a time
                used = total[starts[at] - 1] if starts[at] else 0
                after = max(at + 1, int(np.searchsorted(total[starts[at:] - 1], used + part_bytes)) + at)
                end = starts[after] if after < len(starts) else table.num_rows
                own = table.slice(starts[at], end - starts[at])
                yield _formatted(own, starts[at:after] - starts[at], first_part if at == 0 else 0, names)
                at = after

        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch if carry is None else pa.concat_batches([carry, batch])
            starts = _group_starts(table.column(0))
            if len(starts) > 1:
                yield from emit(table.slice(0, starts[-1]), starts[:-1], carry_part)
                carry, carry_part = table.slice(starts[-1]), 0
            else:
                carry = table
            if carry.num_rows > 1 and carry.nbytes > part_bytes:
                yield _formatted(carry.slice(0, carry.num_rows - 1), np.zeros(1, dtype=np.int64), carry_part, names)
                carry, carry_part = carry.slice(carry.num_rows - 1), carry_part + 1
        if carry is not None:
            yield from emit(carry, _group_starts(carry.column(0)), carry_part)

    return placed.mapInArrow(run, schema)


def unescape(content: bytes) -> bytes:
    return re.sub(rb"\\(.)", rb"\1", content, flags=re.DOTALL)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """The turns (role, text) of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at byte {at}")
        turns.append((unescape(found[1]), unescape(found[2][:-1])))  # the line break belongs to the mark
        at = found.end()
    return turns


def _code_points(content: bytes) -> int:
    return len(content) - len(re.findall(rb"[\x80-\xbf]", content)) if not content.isascii() else len(content)


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, parsed from the output of :func:`format_chats`."""
    schema = T.StructType(
        [T.StructField("conv_id", formatted.schema["conv_id"].dataType), T.StructField("n_turns", T.LongType()),
         T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
         T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        held: list | None = None

        def done(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], kind), *[pa.array(c) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        def close(state: list) -> tuple:
            key, turns, sha, loss, loss_sha, chars = state
            return key, turns, sha.hexdigest(), loss, loss_sha.hexdigest(), chars

        for batch in batches:
            kind = batch.schema.field(0).type
            rows = []
            for row in batch.to_pylist():
                if row["part"] == 0:
                    if held:
                        rows.append(close(held))
                    held = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                content = row["formatted"].encode()
                for role, text in parse(content):
                    held[1] += 1
                    held[2].update(role + b"\n" + text + b"\n")
                for span in row["loss"]:
                    learned = unescape(content[span["start"] : span["end"]])
                    held[3] += _code_points(learned)
                    held[4].update(learned)
                held[5] += len(row["formatted"])
            if rows:
                yield done(rows)
        if held:
            yield done([close(held)])

    return formatted.mapInArrow(run, schema)
