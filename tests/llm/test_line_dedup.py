import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_fixtures import docs_of  # noqa: F401

from tideload.llm.line_dedup import SPACE, dedup_lines


def brute(rows, min_chars=10):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    holder = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holder[key(line)] = min(i, holder.get(key(line), i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < min_chars or holder[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def test_defined_cases(docs_of):
    rows = [
        (3, "A common line here\nown\n  a COMMON line here\t"),
        (1, "\n\nA common line here\n"),
        (7, None), (8, ""), (None, "a common line here"), (9, "short\nshort"), (10, "short"),
        (5, "twice in one doc\nx\ntwice in one doc"), (5, "twice in one doc\nx\ntwice in one doc"), (5, "another text of five"),
        (6, "twice in one doc\nÉCOLE ÉCOLE ÉCOLE\nécole école école"),
        (11, "\n".join(f"line number {i % 700}" for i in range(3000))), (12, "\n".join(f"line number {i}" for i in range(900))),
    ]
    assert found(dedup_lines(docs_of(*rows))) == brute(rows)
    assert found(dedup_lines(docs_of(*rows), batches=1)) == brute(rows)
    assert found(dedup_lines(docs_of(*rows), batches=7, fanout=3)) == brute(rows)


def test_empty_table_and_clashing_columns(docs_of, spark):
    assert dedup_lines(docs_of()).collect() == []
    clash = spark.createDataFrame([(1, "x" * 12, 5, 6, 7)], "doc_id long, text string, n_lines int, value int, line int")
    row = dedup_lines(clash).collect()[0].asDict()
    assert row == {"doc_id": 1, "text": "x" * 12, "n_lines": 1, "value": 6, "line": 7, "n_dropped": 0}


LINES = st.lists(st.sampled_from(["abcdefghij", " ABCDEFGHIJ ", "klmnopqrstu", "short", "", "zzzzzzzzzz zz"]), max_size=6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LINES, min_size=1, max_size=12), st.integers(0, 1000))
def test_equals_brute_force(docs_of, texts, seed):
    ids = random.Random(seed).sample(range(100), len(texts))
    rows = [(i, "\n".join(lines)) for i, lines in zip(ids, texts, strict=True)]
    assert found(dedup_lines(docs_of(*rows))) == brute(rows)
