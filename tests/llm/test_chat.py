import hashlib
import random

import pyarrow as pa
import pytest

from tideload.llm.chat import assemble, format_chats, parse, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    found = {}
    for conv, turns in out.items():
        turns = [t[2:] for t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        escaped = sum(c in "\\<>" for r, t in turns for c in r + t)
        found[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
            sum(len(r) + len(t) + 17 for r, t in turns) + escaped,
        )
    return found


def rows():
    rng = random.Random(2)
    some = ["", "\\", "<", ">", "</turn>\n", "<turn user>\n", "\n", "é", "🙂", "\\<", "plain words", "\\\\>", "### Assistant:"]
    out = [
        (c, t, rng.choice(["user", "assistant", "system", "assi<stant", None]), "".join(rng.choices(some, k=rng.randrange(7))))
        for c in range(60)
        for t in range(rng.randrange(1, 9))
    ]
    out += [(100, t, "assistant", "long turn " * 50) for t in range(400)]  # one conversation with a large share of all turns
    out += [(101, 0, "user", "x<" * 100_000), (101, 1, "assistant", None), (None, 0, "user", "who"), (None, None, "assistant", "me")]
    return out + [(102, 0, "assistant", "tie"), (102, 0, "assistant", "tie"), (102, 0, "assistant", "sie")]


@pytest.mark.parametrize("part_bytes", [8 << 20, 3000])
def test_round_trip(spark, part_bytes):
    table = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    formatted = format_chats(table, part_bytes=part_bytes)
    got = {r[0]: tuple(r)[1:] for r in read_back(formatted).collect()}
    assert got == plain(rows())


def test_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        table = spark.createDataFrame(rows(), SCHEMA)
        formatted = format_chats(table, part_bytes=4000)
        assert {r[0]: tuple(r)[1:] for r in read_back(formatted).collect()} == plain(rows())
        assert max(r.part for r in formatted.collect()) > 1
    finally:
        spark.conf.set(key, before)


def test_loss_spans_and_clashing_columns(spark):
    table = spark.createDataFrame([(1, 0, "user", "a", 5), (1, 1, "assistant", "b<c", 6)], SCHEMA + ", formatted int")
    row = format_chats(table).collect()[0]
    spans = [row.formatted.encode()[s.start : s.end] for s in row.loss]
    assert [unescape(s) for s in spans] == [b"b<c"]
    assert row.formatted == "<turn user>\na\n</turn>\n<turn assistant>\nb\\<c\n</turn>\n"


def test_empty_table(spark):
    assert read_back(format_chats(spark.createDataFrame([], SCHEMA))).collect() == []


def test_assemble_of_slices():
    role = pa.array(["x", "user", "assistant", "y"]).slice(1, 2)
    text = pa.array(["no", "<é>", "", "no"]).slice(1, 2)
    out, starts, text_at, text_end = assemble(role, text)
    assert parse(bytes(out)) == [(b"user", "<é>".encode()), (b"assistant", b"")]
    assert [bytes(out[a:b]) for a, b in zip(text_at, text_end, strict=True)] == ["\\<é\\>".encode(), b""]
    with pytest.raises(ValueError, match="no turn"):
        parse(b"<turn user>\nunfinished")
