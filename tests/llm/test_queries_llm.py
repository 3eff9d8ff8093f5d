"""The registered queries and the pipeline, against SQL or brute force on the smallest tables."""

from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from check_queries import connect, rows_of
from test_line_dedup import brute as brute_lines
from test_simhash import classes, plain_fingerprint
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tideload.llm.queries import ORACLES, QUERIES
from tideload.session import staged

FOLDER = str(Path("/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def texts(table="documents", columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{table}.parquet'").fetchall()


def test_simhash_query(spark):
    rows = texts()
    fps = {i: plain_fingerprint(t) for i, t in rows}
    want = classes(sorted(fps), [fps[i] for i in sorted(fps)])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_near_dedup"](spark, FOLDER).collect()}
    assert got == {i: (f"{f:016x}", want[i]) for i, f in fps.items()}


def test_toxicity_query(spark):
    rows = QUERIES["op2_toxicity"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in texts())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_packing_query(spark):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(reference.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts()}
    got = QUERIES["op5_packing"](spark, FOLDER).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id: r["sum(length)"] for r in got} == {r.doc_id: r["max(doc_tokens)"] for r in got} == want


def test_sharding_query(spark):
    rows = QUERIES["op6_sharding"](spark, FOLDER).collect()
    assert len(rows) == len(texts())
    stayed = [r.shard == r.shard_after_loss for r in rows if r.shard != "shard-047"]
    assert sum(stayed) > 0.8 * len(stayed) and all(r.shard_after_loss != "shard-047" for r in rows)


def test_substring_query(spark):
    """Every run of 50 words that an earlier document has lies in a found passage."""
    words = {i: (t or "").encode().lower().split() for i, t in texts()}
    spans = {}
    for r in QUERIES["op8_substring_dedup"](spark, FOLDER).collect():
        assert r.identity >= 0.8 and min(r.end_word - r.start_word, r.source_end_word - r.source_start_word) >= 45
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    first = {}
    for i in sorted(words):
        for at in range(len(words[i]) - 49):
            run = tuple(words[i][at : at + 50])
            if first.setdefault(run, i) != i and len(set(run)) > 10:
                assert any(a <= at + 3 and at + 47 <= b for a, b in spans.get(i, [])), (i, at)


def test_pipeline_stage_by_stage(spark, con):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), name)
        outputs[name] = docs
        if name != "packing":
            assert docs.columns == columns
    rows = {n: {r.doc_id: r.text for r in df.collect()} for n, df in outputs.items() if n != "packing"}
    given = dict(texts())
    # Toxicity: documents go or stay as they are, and not many clean ones go.
    assert rows["toxicity"].items() <= given.items()
    clean = {i for i, in duckdb.sql(f"SELECT doc_id FROM '{FOLDER}/labels.parquet' WHERE toxic = 0").fetchall()}
    assert len(clean - rows["toxicity"].keys()) <= 0.02 * len(clean)
    # Line dedup, by brute force.
    want = {i: text for i, text, _, _ in brute_lines(list(rows["toxicity"].items()))}
    assert rows["line_dedup"] == want
    assert all(r.n_chars == len(r.text) for r in outputs["line_dedup"].collect())
    # Near copies, by brute force.
    ids = sorted(want)
    component = classes(ids, [plain_fingerprint(want[i]) for i in ids])
    assert rows["simhash_near_dedup"] == {i: want[i] for i in ids if component[i] == i}
    # Decontamination, by the query's SQL on the stage's input.
    own = connect(FOLDER)
    own.execute("DROP VIEW documents")
    own.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    own.executemany("INSERT INTO documents VALUES (?, ?)", list(rows["simhash_near_dedup"].items()))
    hit = {r[0] for r in own.execute(f"SELECT doc_id FROM ({ORACLES['op1_decontamination']})").fetchall()}
    assert hit and rows["decontamination"] == {i: t for i, t in rows["simhash_near_dedup"].items() if i not in hit}
    # Packing: every id once.
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in outputs["packing"].orderBy("doc_id", "start").collect():
        pieces.setdefault(r.doc_id, []).append(bytes(r.ids))
    got = {i: np.frombuffer(b"".join(p), dtype="<u4").tolist() for i, p in pieces.items()}
    assert got == {i: [*reference.encode(t, add_special_tokens=False).ids, 0] for i, t in rows["decontamination"].items()}


def test_run_is_the_stages(spark):
    sizes = corpus_pipeline.run(spark, FOLDER).groupBy("sequence_id").sum("length").collect()
    assert sizes and all(r["sum(length)"] <= 1024 for r in sizes)


def test_pipeline_of_odd_rows(spark):
    """Nulls in any column, repeated rows, empty and long texts, no rows at all."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    long = "a long text of words " * 20_000
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, long, "en", None, 1),
            (4, "some clean words of a document", "en", "s", 1), (4, "some clean words of a document", "en", "s", 1)]
    odd = spark.createDataFrame(rows, docs.schema)
    for table, most in ((odd, len(rows)), (odd.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            table = staged(stage(spark, table, FOLDER), name)
            if name != "packing":
                assert table.columns == docs.columns and table.count() <= most
        assert {r.doc_id for r in table.collect()} == ({None, 1, 3, 4} if most else set())
